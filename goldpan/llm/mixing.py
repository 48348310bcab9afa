"""Mixing sources to target weights by pivotal dependent rounding.

Each document of a source gets the same expected number of copies. The whole part is taken for sure; the fractional
parts are rounded in pairs: mass (copies times size) moves at random from one document to the other until one of them is
integral, which keeps every expectation and keeps the source's total exactly. What each bucket leaves over meets the
leftovers of other buckets in a reduction tree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldpan.scratch import lookup, written

WEIGHTS = (3.0, 1.0, 2.0)
_SCHEMA = "r long, doc_id long, text_hash long, row_hash long, source string, size long, source_size long, target double, whole int, p double, bucket long, done boolean"
_M = (1 << 64) - 1
#: Stands for a null doc_id inside tasks, where a null would turn ids into floats.
_NULL_ID = -(1 << 63)


def _unit(*keys: int) -> float:
    """A number in [0, 1) that depends on the keys only."""
    x = 0x243F6A8885A308D3
    for k in keys:
        x = ((x ^ (k & _M)) * 0xBF58476D1CE4E5B9 + 0x9E3779B97F4A7C15) & _M
        x ^= x >> 31
        x = (x * 0x94D049BB133111EB) & _M
        x ^= x >> 29
    return (x >> 11) / (1 << 53)


def pivot(sizes: list[int], probs: list[float], keys: list[int], seed: int) -> list[float]:
    """Round ``probs`` to 0 or 1, but for one at most; the sum of size times probability stays."""
    p, open_ = list(probs), -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if open_ < 0:
            open_ = j
            continue
        i = open_
        up_i, down_j = (1 - p[i]) * sizes[i], p[j] * sizes[j]
        down_i, up_j = p[i] * sizes[i], (1 - p[j]) * sizes[j]
        a, b = min(up_i, down_j), min(down_i, up_j)
        if _unit(seed, keys[i], keys[j]) * (a + b) < b:
            i_full, j_empty = up_i <= down_j, down_j <= up_i
            p[i] = 1.0 if i_full else p[i] + a / sizes[i]
            p[j] = 0.0 if j_empty else p[j] - a / sizes[j]
        else:
            i_empty, j_full = down_i <= up_j, up_j <= down_i
            p[i] = 0.0 if i_empty else p[i] - b / sizes[i]
            p[j] = 1.0 if j_full else p[j] + b / sizes[j]
        open_ = i if 0.0 < p[i] < 1.0 else j if 0.0 < p[j] < 1.0 else -1
    return p


def _rounder(seed: int, level: int, fan_in: int):
    def round_bucket(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "text_hash", "row_hash"], kind="stable").reset_index(drop=True)
        keys = (rows["doc_id"] ^ rows["text_hash"]).tolist()
        p = np.array(pivot(rows["size"].tolist(), rows["p"].tolist(), keys, seed + level))
        rows["p"], rows["done"], rows["bucket"] = p, (p <= 0.0) | (p >= 1.0), rows["bucket"] // fan_in
        return rows

    return round_bucket


def targets(sizes: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, n_docs, target from rows of source and size: one row for each source.

    Sources in code point order, null last, have ``weights``, repeating, and share ``share`` times all sizes. No target
    exceeds ``most`` times its source; the excess is shared again by weight. That is a water level: target =
    min(most * source_size, level * weight). The windows run over one row a source, never over documents.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    one = Window.partitionBy(F.lit(1))
    named = by_source.withColumn("_i", F.row_number().over(one.orderBy(F.col("source").asc_nulls_last())))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((F.col("_i") - 1) % len(weights) + 1).cast("int"))
    ranked = named.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    order = one.orderBy("_ratio", "_i")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(one) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_n", "_level"))).over(one)["_level"]
    out = ranked.withColumn("_level", level).withColumn("_n", F.row_number().over(order)).withColumn("_at", first)
    return out.select("source", "source_size", "n_docs", F.least(F.col("_cap"), F.coalesce(F.col("_at") * F.col("_w"), F.col("_cap"))).alias("target"))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, carry: bool) -> DataFrame:
    """A written table: r (a number of the row), doc_id, text_hash, row_hash, source, size and, with ``carry``, row (struct of all columns)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{source_col}`").cast("string").alias("source"), text.alias("t"), F.xxhash64(row).alias("row_hash"), *[row.alias("row")] * carry)
    size = F.regexp_count("t", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("size")
    return written(named.select(F.monotonically_increasing_id().alias("r"), "doc_id", F.xxhash64("t").alias("text_hash"), "row_hash", "source", size, *["row"] * carry), "mix-sizes")


def _plan(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float, seed: int, bucket_rows: int, fan_in: int) -> DataFrame:
    """The columns of ``mix``, and r, for each row of ``sizes``."""
    aims = written(targets(sizes, weights=weights, share=share, most=most), "mix-targets")
    t = aims.select(F.col("source").alias("t_source"), "source_size", "n_docs", "target")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sizes.join(lookup(t), F.col("source").eqNullSafe(F.col("t_source"))).withColumn("rate", rate)
    rows = rows.select(
        "r", F.coalesce("doc_id", F.lit(_NULL_ID)).alias("doc_id"), "text_hash", "row_hash", "source", "size", "source_size", "target", F.floor("rate").cast("int").alias("whole"),
        F.when(F.col("size") > 0, F.col("rate") - F.floor("rate")).otherwise(0.0).alias("p"),
        F.pmod(F.xxhash64("doc_id", "text_hash", "row_hash"), F.ceil(F.col("n_docs") / bucket_rows)).cast("long").alias("bucket"), F.lit(False).alias("done"),
    )
    most_rows = aims.agg(F.max("n_docs")).first()[0] or 0
    buckets, level = math.ceil(most_rows / bucket_rows), 0
    round_ = lambda df: df.groupBy("source", "bucket").applyInPandas(_rounder(seed, level, fan_in), _SCHEMA)
    done = []
    while True:
        rows = written(round_(rows), f"mix-level{level}")
        if buckets <= 1:
            break
        done.append(rows.filter("done"))
        rows, buckets, level = rows.filter("not done"), math.ceil(buckets / fan_in), level + 1
    out = rows
    for d in done:
        out = out.unionByName(d)
    last = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30) < F.col("p")  # one open document a source at most
    copies = F.when(F.col("size") > 0, F.col("whole") + F.when(F.col("p") >= 1.0, 1).when(F.col("p") <= 0.0, 0).otherwise(last.cast("int"))).otherwise(0)
    real = F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")).alias("doc_id")
    return out.select("r", real, "text_hash", "source", "size", "source_size", "target", copies.alias("copies")).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 1, bucket_rows: int = 2_000, fan_in: int = 1_000) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies (0 to ceil(most)), taken; one row for each input row.

    size: words between white space (null or empty text: 0, never copied). A source's taken words differ from its target by
    less than one document. Reruns give the same rows; repeated rows are rounded on their own. Null sources are one
    source, null ids are allowed; no rows give no rows.

    Buckets hold about ``bucket_rows`` documents of one source by hash, so a hot source is spread. A bucket leaves at most
    one open document; ``fan_in`` leftovers meet in a task of the next level, until each source has one bucket.
    """
    return _plan(_sizes(docs, id_col, text_col, source_col, False), weights, share, most, seed, bucket_rows, fan_in).drop("r")


def mixed_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0, seed: int = 1, bucket_rows: int = 2_000, fan_in: int = 1_000) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as ``mix`` takes it, with its columns, whatever their names. Rows are numbered once they are written, so each has its own copies, rows alike included."""
    rows = _sizes(docs, id_col, text_col, source_col, True)
    plan = _plan(rows.drop("row"), weights, share, most, seed, bucket_rows, fan_in).filter("copies > 0").select("r", "copies")
    return rows.select("r", "row").join(plan, "r").select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
