"""Line dedup with DataFrame functions only: explode, hash, count documents, drop, reassemble by position."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.scratch import lookup, written

from .common import id_text

#: White space that is stripped from both ends of a line.
BLANKS = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    """The line without blanks at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> DataFrame:
    """Drop lines that many documents hold, except in the largest id that holds them.

    Returns doc_id, n_lines, n_dropped, kept_text, one row for each input row.

    A line's key has at least ``min_chars`` code points and stands in at least ``min_docs`` distinct documents. A null
    or empty text is one empty line. Rows that repeat a doc_id count as one document and are each rewritten; a null
    doc_id is one document that is smaller than all others. No rows in, no rows out; other columns are ignored.

    Plan: the keys are shuffled as two 64-bit hashes, first by (key, document), so that a line that a third of all
    documents hold is spread, then as partial counts by key. The join back to the lines has one row for each hot key,
    and is broadcast if these are counted to be few; else AQE can split its skew. Texts move once, to meet their dropped positions.
    """
    lines = id_text(docs, id_col, text_col).select(
        "doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n", -1).alias("lines")
    )
    keys = (
        lines.select("doc_id", "text_hash", F.posexplode("lines").alias("pos", "line"))
        .filter(F.length("line") >= min_chars)
        .withColumn("key", line_key(F.col("line")))
        .filter(F.length("key") >= min_chars)
        .select("doc_id", "text_hash", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))
    )
    hot = written(
        keys.groupBy("h1", "h2", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id"))
        .filter(F.col("n_docs") >= min_docs).select("h1", "h2", "last_id"), "hot-lines"
    )
    dropped = (
        keys.join(lookup(hot), ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("last_id")))
        .groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("dropped"))
        .select(F.col("doc_id").alias("d_id"), F.col("text_hash").alias("d_hash"), "dropped")
    )
    joined = lines.join(dropped, lines.doc_id.eqNullSafe(dropped.d_id) & (lines.text_hash == dropped.d_hash), "left")
    n, gone = F.size("lines"), F.coalesce(F.size("dropped"), F.lit(0))
    kept_at = F.array_except(F.sequence(F.lit(0), n - 1), F.col("dropped"))
    kept = F.when(F.col("dropped").isNull(), F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(kept_at, lambda i: F.get(F.col("lines"), i)), "\n"))
    return joined.select("doc_id", n.cast("long").alias("n_lines"), F.when(F.col("dropped").isNull(), 0).otherwise(gone).cast("long").alias("n_dropped"), kept.alias("kept_text"))
