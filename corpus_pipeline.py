"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token records.

Each stage takes (spark, docs, sf_dir), works on all that the one before it kept, and returns the columns of ``documents``; the last
returns the records as read back from its files. Stages are written as Parquet and read again in between: a stage begins by
deleting the scratch tables of the one before it, so its result must have been written by then.

Null and empty texts have no words and go in the first stage, as do texts of fewer than 50 words; null ids, sources and languages
are kept and treated as one id, source or language; rows that repeat an id are documents of their own, rows that repeat id and
text are one from the second stage on. Columns of any name pass through. Empty documents give no rows; without labels no
cutoff is certified, without benchmark items nothing is contaminated.
"""

from __future__ import annotations

from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from goldpan.llm import decontaminate, jaccard_join, mixing, quality_rules, token_records
from goldpan.llm.common import read_table
from goldpan.llm.queries import tokenizer_path
from goldpan.scratch import release, scratch_tables, written

#: Scratch tables of the last stage that ran: of a ``run``, or of the thread where stages are called one by one.
_scratch: ContextVar[list[DataFrame]] = ContextVar("scratch")


def _clear(spark: SparkSession) -> list[DataFrame]:
    tables = _scratch.get(None)
    if tables is None:
        _scratch.set(tables := [])
    while tables:
        release(tables.pop(), spark)
    return tables


def _stage(function):
    """``function``, after the scratch tables of the stage before it are gone."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tables = _clear(spark)
        with scratch_tables() as found:
            out = function(spark, docs, sf_dir)
        tables.extend(found)
        return out

    return run_stage


@_stage
def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, read_table(spark, sf_dir, "labels"))


@_stage
def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by five-word shingles at a similarity of 0.8 the one with the smallest id stays."""
    return jaccard_join.keep_one(docs, n=5, num=80, den=100)


@_stage
def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter item, go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


@_stage
def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents come as often as the mix takes them, which may be never."""
    return mixing.mixed_documents(docs)


@_stage
def token_records_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each record, read back from the written files."""
    return token_records.encode_and_read(docs, tokenizer_path=tokenizer_path())


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_records", token_records_stage),
]

#: Certified cutoffs, random rounding and tokenizers are beyond SQL; tests hold every stage against plain Python on its own input.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Tables of a run are its own; all but the result are deleted when nothing reads them any more."""
    token = _scratch.set([])
    try:
        docs, before = read_table(spark, sf_dir, "documents"), None
        for name, stage in STAGES:
            docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
            if before is not None:
                release(before, spark)
            before = docs
        _clear(spark)
        return docs
    finally:
        _scratch.reset(token)
