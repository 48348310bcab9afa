"""Helpers shared by the operators: inputs with fixed names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only what the text operators need, under fixed names; a null text counts as empty."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def text_bytes(docs: DataFrame) -> int:
    """Bytes of all texts: one scan and one row."""
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
