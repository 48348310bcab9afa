"""Writing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.operators.linkage import pairs_stood_for


def flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON, for formats without them."""
    return df.select(*[F.to_json(F.col(f"`{c}`")).alias(c) if t.startswith(("array", "map", "struct")) else F.col(f"`{c}`") for c, t in df.dtypes])


def write_as(df: DataFrame, path: str, kind: str | None = None, mode: str = "overwrite", compression: str | None = None) -> str:
    """csv, parquet, orc or json, by the end of the name if no kind is given."""
    kind = kind or path.rsplit(".", 1)[-1].lower()
    writer = (flat(df) if kind == "csv" else df).write.mode(mode).format({"ndjson": "json"}.get(kind, kind))
    if kind == "csv":
        writer = writer.option("header", True)
    (writer.option("compression", compression) if compression else writer).save(path)
    return path


def export(df: DataFrame, base: str, kinds: list[str]) -> dict[str, str]:
    return {k: write_as(df, f"{base}.{k}", k) for k in kinds}


def publish(refined: DataFrame, folder: str, output: str) -> str:
    """A snapshot, then the table in order of names."""
    write_as(refined, f"{folder}/refined.parquet")
    return write_as(refined.orderBy("organization_name"), output)


def write_linkage(scored: DataFrame, folder: str) -> DataFrame:
    """Scored pairs of ``link_by_rules``, those under review, and by class the pairs of rows they stand for; pairs are scored once and read back."""
    write_as(scored, f"{folder}/matches.parquet")
    kept = scored.sparkSession.read.schema(scored.schema).parquet(f"{folder}/matches.parquet")
    write_as(kept.filter("classification = 'review'"), f"{folder}/review.parquet")
    counts = kept.groupBy("classification").agg(F.sum(pairs_stood_for()).cast("long").alias("n"))
    write_as(counts, f"{folder}/metadata.json")
    return counts


def append_ledger(records: DataFrame, path: str, terms: str, at: Column) -> None:
    """Provenance of collected records, with the hash of the terms they were collected under; only ever appended."""
    meta = F.to_json(F.col("metadata")) if "metadata" in records.columns else F.lit(None).cast("string")
    records.select("record_id", "source", "license", F.sha2(F.lit(terms), 256).alias("policy_hash"), meta.alias("metadata"), at.alias("recorded_at")).write.mode("append").json(path)


def query_table(df: DataFrame, name: str, sql: str, args: list | None = None) -> DataFrame:
    """SQL with positional parameters over ``df`` under a name."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.sql(sql, args=args or [])
