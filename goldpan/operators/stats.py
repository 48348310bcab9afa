"""Counts, summaries and rankings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))


def column_stats(df: DataFrame, column: str) -> DataFrame:
    """mean, min, max; zeros when there is nothing."""
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    return df.agg(zero(F.avg(column)).alias("mean"), zero(F.min(column).cast("double")).alias("min"), zero(F.max(column).cast("double")).alias("max"))


def duplicate_groups(df: DataFrame, normal: Column, name: str, position: str) -> DataFrame:
    """Rows of groups of several with one normal name, with ``duplicate_group``: that name and the first row's own."""
    by = Window.partitionBy("_n")
    out = df.withColumn("_n", normal).filter(F.col("_n") != "")
    first = F.min_by(name, position).over(by)
    return out.withColumns({"_c": F.count("*").over(by), "duplicate_group": F.concat(F.col("_n"), F.lit(" ("), first, F.lit(")"))}).filter("_c > 1").drop("_c", "_n")


def provenance_summary(entries: DataFrame) -> DataFrame:
    """dimension (source, strategy or network_status), value, n."""
    pairs = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).alias("value")) for c in ("source", "strategy", "network_status")])
    return entries.select(F.explode(pairs).alias("p")).groupBy("p.dimension", "p.value").agg(F.count("*").alias("n"))


def provenance_totals(entries: DataFrame) -> DataFrame:
    """source, strategy, network_status, level, n, mean_confidence: each combination, each dimension alone, and the total, in one aggregation over grouping sets.

    level: detail, source, strategy, network_status or total; a dimension that a level sums over is null there, as is one
    without value, so it is ``level`` that tells them apart.
    """
    dims = ["source", "strategy", "network_status"]
    named = entries.select(*dims, "confidence")
    sets = [[F.col(d) for d in dims], *[[F.col(d)] for d in dims], []]
    which = F.grouping_id(*dims)
    level = F.when(which == 0, "detail").when(which == 0b011, "source").when(which == 0b101, "strategy").when(which == 0b110, "network_status").otherwise("total")
    return named.groupingSets(sets, *dims).agg(level.alias("level"), F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"))


def run_kpis(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """runs, successes, success_rate, and mean, min and max of seconds and records; runs: success, seconds, records."""
    ok = F.count_if("success")
    figures = [F.count("*").alias("runs"), ok.alias("successes"), (ok / F.count("*")).alias("success_rate")]
    figures += [f(c).alias(f"{n}_{c}") for c in ("seconds", "records") for n, f in (("mean", F.avg), ("min", F.min), ("max", F.max))]
    return runs.groupBy(*(by or [])).agg(*figures)


def run_totals(runs: DataFrame, by: str) -> DataFrame:
    """``run_kpis`` of each value of ``by`` and, with ``is_total``, of all runs, in one aggregation."""
    ok = F.count_if("success")
    figures = [F.count("*").alias("runs"), ok.alias("successes"), (ok / F.count("*")).alias("success_rate"), F.sum("records").alias("records"), F.sum("seconds").alias("seconds")]
    return runs.rollup(by).agg((F.grouping_id() == 1).alias("is_total"), *figures)


def gate_history(entries: DataFrame, last: int | None = None) -> DataFrame:
    """total, passed, failed, pass_rate and the latest entry's time and verdict, of all entries or the ``last`` ones by time; entries: at, passed."""
    if last is not None:
        entries = entries.orderBy(F.col("at").desc(), F.col("passed")).limit(last)
    return entries.agg(
        F.count("*").alias("total"), F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"),
        F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(0.0)).alias("pass_rate"), F.max("at").alias("latest_at"), F.max_by("passed", "at").alias("latest_passed"),
    )


def frameworks_due(runs: DataFrame, frameworks: DataFrame, now: Column, days: int = 90) -> DataFrame:
    """framework, last_run, due: whether there is no run in the last ``days``."""
    last = runs.groupBy(F.lower("framework").alias("framework")).agg(F.max("run_at").alias("last_run"))
    return frameworks.select(F.lower("framework").alias("framework")).distinct().join(last, "framework", "left").withColumn("due", F.coalesce(F.col("last_run") < now - F.expr(f"interval {days} days"), F.lit(True)))


def error_summary(errors: DataFrame) -> DataFrame:
    """category, n, errors, warnings, critical, recoverable."""
    level = lambda x: F.count_if(F.lower("severity") == x)
    return errors.groupBy("category").agg(F.count("*").alias("n"), level("error").alias("errors"), level("warning").alias("warnings"), level("critical").alias("critical"), F.count_if("recoverable").alias("recoverable"))


def best_provenance(rows: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """Rows with the entry of highest confidence; without one: original, 1.0, none."""
    best = entries.groupBy(key).agg(F.max_by(F.struct("source", "confidence", "strategy"), F.struct("confidence", -F.col("seq"))).alias("b"))
    return rows.join(best, key, "left").withColumns({
        "provenance_source": F.coalesce("b.source", F.lit("original")), "provenance_confidence": F.coalesce("b.confidence", F.lit(1.0)), "provenance_strategy": F.coalesce("b.strategy", F.lit("none")),
    }).drop("b")


def confidence_range(entries: DataFrame, key: str) -> DataFrame:
    return entries.groupBy(key).agg(F.min("confidence").alias("min_confidence"), F.max("confidence").alias("max_confidence"), F.max_by("source", F.struct("confidence", -F.col("seq"))).alias("primary_source"))


def ranked_list(df: DataFrame, key: str, score: str, n: int = 50, ties: str | None = None) -> DataFrame:
    """The best row of each key, by score, and of these the first ``n``: the daily list."""
    order = [F.col(score).desc_nulls_last(), F.col(ties or key)]
    best = df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter("_n = 1").drop("_n")
    return best.orderBy(*order).limit(n)


def first_per_key(df: DataFrame, key: str, value: str, position: str, n: int = 5) -> DataFrame:
    """key and its first ``n`` values in order; ranked before they are gathered, so that no list is longer."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(position))).filter(F.col("_n") <= n)
    return ranked.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_n", value))), lambda x: x[value]).alias(f"first_{value}s"))
