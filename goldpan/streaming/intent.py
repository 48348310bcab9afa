"""Intent signals as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from goldpan.operators.dedup import keep_last
from goldpan.scratch import release, written


def dedup_stream(found: DataFrame, keys: list[str], *, time: str = "observed_at", watermark: str = "1 day") -> DataFrame:
    """The first signal of each key within the watermark."""
    return found.withWatermark(time, watermark).dropDuplicatesWithinWatermark(keys)


def windowed_digest(found: DataFrame, *, size: str, slide: str | None = None, session_gap: str | None = None, time: str = "observed_at", watermark: str = "1 day", total: str | None = None) -> DataFrame:
    """target_slug, window_start, window_end, mean_score, signal_count in tumbling, sliding or session windows; works on batches too.

    With ``total``, a decimal type, total_score too: the sum of the scores as decimals, which is the same in any order of rows.
    """
    window = F.session_window(time, session_gap) if session_gap else F.window(time, size, slide) if slide else F.window(time, size)
    watched = found.withWatermark(time, watermark) if found.isStreaming else found
    totals = [F.sum(F.col("score").cast(total)).alias("total_score")] if total else []
    out = watched.groupBy(window.alias("w"), "target_slug").agg(F.avg("score").alias("mean_score"), F.count("*").alias("signal_count"), *totals)
    return out.select("target_slug", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "mean_score", "signal_count", *(["total_score"] if total else []))


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Drain what is there into Parquet files, exactly once across restarts."""
    query = df.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()
    return query


def run_to_snapshot(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Drain what is there; the whole result of the aggregation replaces the files after each batch, open windows included."""
    query = df.writeStream.outputMode("complete").foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


#: Partition columns of a store: rows have none of these names.
PART, VERSION = "store_part", "store_version"


def upsert_stream(df: DataFrame, path: str, checkpoint: str, keys: list[str], position: str, parts: int = 64) -> StreamingQuery:
    """Last wins across batches, in a store that is cut into ``parts`` by a hash of the keys: a batch reads and rewrites only the parts that its keys fall into.

    The store is read by ``read_store``. A part's rows lie in folders by part and version, the version being the batch that wrote them; of each part the
    newest version counts, and a batch deletes those that its own replaces but for the last one before it. So a batch that
    is run again after a failure reads what it read before, writes the same and leaves the other parts alone.
    """
    def merge(batch: DataFrame, number: int) -> None:
        new = written(keep_last(batch, keys, position).withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")), "store-batch")
        touched = [r[PART] for r in new.select(PART).distinct().collect()]  # at most ``parts``
        if touched:
            versions = {p: n for p, n in _versions(new, path, number).items() if p in touched}
            old = [f"{path}/{PART}={p}/{VERSION}={n}" for p, n in versions.items()]
            if old:
                before = batch.sparkSession.read.schema(new.drop(PART).schema).parquet(*old)
                kept = before.join(new.select(*keys), keys, "left_anti").withColumn(PART, F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
                rows = new.unionByName(kept)
            else:
                rows = new
            staged = written(rows, "store-parts")
            # The parts of a version are written side by side; the mode replaces those alone that this batch holds.
            staged.withColumn(VERSION, F.lit(number)).repartition(PART).write.partitionBy(PART, VERSION).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
            _forget(new, path, versions)
            release(staged)
        release(new)

    query = df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _folders(df: DataFrame, path: str) -> tuple:
    spark = df.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{PART}=*/{VERSION}=*")) if system.exists(where) else None
    return system, [x.getPath() for x in found or []]


def _numbers(folder) -> tuple[int, int]:
    return int(folder.getParent().getName().partition("=")[2]), int(folder.getName().partition("=")[2])


def _versions(df: DataFrame, path: str, below: int) -> dict[int, int]:
    """The newest version of each part that a batch before ``below`` wrote."""
    out: dict[int, int] = {}
    for folder in _folders(df, path)[1]:
        part, version = _numbers(folder)
        if version < below:
            out[part] = max(version, out.get(part, -1))
    return out


def _forget(df: DataFrame, path: str, newest: dict[int, int]) -> None:
    """Delete what is older than the version that the running batch has read."""
    system, folders = _folders(df, path)
    for folder in folders:
        part, version = _numbers(folder)
        if version < newest.get(part, -1):
            system.delete(folder, True)


def read_store(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of a store that ``upsert_stream`` keeps."""
    empty = spark.createDataFrame([], schema)
    newest = _versions(empty, path, 1 << 62)
    return spark.read.schema(empty.schema).parquet(*[f"{path}/{PART}={p}/{VERSION}={n}" for p, n in newest.items()]) if newest else empty


def split_late(df: DataFrame, on_time: str, late: str, maxima: str, checkpoint: str, *, time: str = "observed_at", watermark: str = "1 day") -> StreamingQuery:
    """Deal a stream to two tables: rows no older than the watermark, and late ones. Spark's own operators drop the latter unseen.

    The watermark of a batch is the greatest time of the batches before it less ``watermark``; each batch notes its own in
    ``maxima``. A batch that runs again replaces what it wrote.
    """
    def deal(batch: DataFrame, number: int) -> None:
        rows = written(batch, "stream-batch")
        spark = batch.sparkSession
        before = None
        if number:
            before = spark.read.schema("most timestamp, batch long").parquet(maxima).filter(F.col("batch") < number).agg(F.max("most")).first()[0]
        border = F.lit(before).cast("timestamp") - F.expr(f"interval {watermark}")
        behind = F.coalesce(F.col(time) < border, F.lit(False))
        for where, chosen in ((on_time, rows.filter(~behind)), (late, rows.filter(behind)), (maxima, rows.agg(F.max(time).alias("most")))):
            chosen.withColumn("batch", F.lit(number).cast("long")).write.partitionBy("batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(where)
        release(rows)

    query = df.writeStream.foreachBatch(deal).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
