"""Tables that cut a plan's lineage, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names; an own folder only where it is unset and all runs on one machine, as in tests."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no folder that the executors share")
        found = "file://" + tempfile.mkdtemp(prefix="goldpan-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/goldpan-{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_end_with_the_job(spark: SparkSession):
    """A written table needs no shuffle files any more, so they go when its job ends."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


#: Lists that tables written from now on are added to.
_watching: list[list[DataFrame]] = []


@contextmanager
def scratch_tables():
    """A list of the scratch tables that are written inside, so that they can be released when nothing reads them any more."""
    found: list[DataFrame] = []
    _watching.append(found)
    try:
        yield found
    finally:
        _watching.remove(found)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: later steps neither compute it again nor depend on one executor's disk."""
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_end_with_the_job(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.goldpan_path = path
    for found in _watching:
        found.append(out)
    return out


def release(df: DataFrame, spark: SparkSession | None = None) -> None:
    """Delete a table that ``written`` gave and that no later plan reads; one that is gone already is no error."""
    spark = spark or df.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df.goldpan_path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: Rows up to which a table that was written and counted may be broadcast.
BROADCAST_ROWS = 50_000


def lookup(small: DataFrame) -> DataFrame:
    """``small`` is a written table. Broadcast it if its counted rows are few; beyond that it joins by shuffle."""
    return F.broadcast(small) if small.count() <= BROADCAST_ROWS else small
