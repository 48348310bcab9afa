"""Unions, first-wins and last-wins dedup, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldpan.functions.text import slugify_ascii
from goldpan.scratch import lookup, written


def with_position(df: DataFrame, column: str = "pos") -> DataFrame:
    """A stable position for rules on source order: the input partition, then the row in it.

    Rows are written with their partition first, as a plan that is run twice may be cut in two ways. The offsets have one row a
    partition; the rows themselves are neither shuffled nor sorted.
    """
    marked = written(df.withColumn("_m", F.monotonically_increasing_id()), "positions").withColumn("_p", F.shiftright("_m", 33))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy("_p").agg(F.count("*").alias("_c")).select("_p", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    return marked.join(F.broadcast(offsets), "_p").withColumn(column, F.col("_o") + F.col("_m").bitwiseAND((1 << 33) - 1)).drop("_m", "_p", "_o")


def numbered(df: DataFrame, order: str, column: str, rows: int = 1_000_000) -> DataFrame:
    """Adds 1, 2, 3 and so on in the order of a numeric column: rows are dealt to ranges of about ``rows`` and counted there; each range starts behind those before it.

    ``df`` is read twice and should be a written table.
    """
    parts = min(1024, -(-df.count() // rows))
    edges = df.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 10 * parts).alias("e")).first()["e"] if parts > 1 else []
    part = F.size(F.filter(F.array(*map(F.lit, sorted(set(edges)))), lambda e: e < F.col(order))) if edges else F.lit(0)
    marked = df.withColumn("_part", part)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = marked.groupBy("_part").agg(F.count("*").alias("_c")).select("_part", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_o"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return marked.withColumn("_i", inside).join(F.broadcast(offsets), "_part").withColumn(column, F.col("_o") + F.col("_i")).drop("_part", "_i", "_o")


def ranked_within(rows: DataFrame, part: str, *order: Column, name: str = "pos") -> DataFrame:
    """``rows`` with their place, from 0, in their ``part`` by ``order``, and n, the number of rows of the part. ``part`` is never null.

    Rows are sorted in ranges, so that a hot part is spread; a range's first place comes from the counts of those before
    it, one row for each part and range.
    """
    by = [F.col(part).asc(), *order]
    ranges = written(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()), "ranges")
    counts = ranges.groupBy(F.col(part).alias("_part"), F.shiftright("_at", 33).alias("_range")).agg(F.min("_at").alias("first"), F.count("*").alias("c"))
    of = Window.partitionBy("_part")
    before = F.sum("c").over(of.orderBy("_range")) - F.col("c")
    firsts = written(counts.select("_part", "_range", (before - F.col("first")).alias("_shift"), F.sum("c").over(of).alias("n")), "range-offsets")
    joined = ranges.join(lookup(firsts), (F.col(part) == F.col("_part")) & (F.shiftright("_at", 33) == F.col("_range")))
    return joined.withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_range", "_shift")


def union_sources(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; nulls are a key too."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def keep_last(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return keep_first(df, keys, [F.col(position).desc()])


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows, and the old ones whose key no new row has."""
    return new.unionByName(old.join(new.select(*keys).distinct(), keys, "left_anti"), allowMissingColumns=True)


def slug_key(name: Column, slug: Column, province: Column, address: Column, position: Column) -> Column:
    """The slug, or that of the name, of name, province and address, or one of the row alone."""
    return F.coalesce(F.nullif(slug, F.lit("")), slugify_ascii(name), slugify_ascii(F.concat_ws(" ", name, province, address)), F.concat(F.lit("entity-"), position))
