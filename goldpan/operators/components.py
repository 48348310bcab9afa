"""Connected components of an edge table by alternating large-star and small-star rounds (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.scratch import release, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller end here."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """node, component (its smallest member) for each node that an edge names; edges in any order, repeats and loops allowed.

    Each round is a few joins and partial aggregations; a hub's edges are split by AQE, as the other side has one row a
    node. Each round is written to the shared folder, so a lost executor costs one round at most.
    """
    ends = F.col(left), F.col(right)
    start = now = written(edges.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b")).distinct(), "edges")
    print_ = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    loops, now = start.filter("a = b"), start.filter("a <> b")
    before, old = print_(now), None
    while before[0]:
        now = new = written(_small_star(_large_star(now).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()), "edges")
        after = print_(new)
        if old is not None:
            release(old)
        old = new
        if after == before:
            break
        before = after
    found = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
    return found.unionByName(loops.select(F.col("a").alias("node"), F.col("a").alias("component")).join(found.select("node"), "node", "left_anti"))
