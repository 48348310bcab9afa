"""Intent signals: scores of time-stamped events, dedup, cache and digest. The expressions serve batches and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions import text as T
from goldpan.functions.dates import event_timestamp
from goldpan.operators.dedup import keep_first

#: What a stage of technology adoption adds to a score.
STAGE_BONUS = {"trial": 0.15, "pilot": 0.25, "production": 0.4, "rollout": 0.35}


def signal_score(kind: Column, intent: Column, detail: Column, stage: Column | None = None) -> Column:
    """Score of an event by its type, within 0 and 1. ``detail``: sentiment, seniority or magnitude."""
    base = F.coalesce(intent, F.lit(0.0))
    above = lambda c: F.greatest(c, F.lit(0.0))
    seniority = F.coalesce(F.nullif(detail, F.lit(0.0)), F.lit(0.6))
    bonus = F.lit(0.2)
    if stage is not None:
        for name, b in STAGE_BONUS.items():
            bonus = F.when(F.lower(stage) == name, b).otherwise(bonus)
    score = (
        F.when(kind == "news", base + 0.25 * above(F.coalesce(detail, F.lit(0.0)))).when(kind == "hiring", base + 0.2 * above(seniority))
        .when(kind == "traffic", base + 0.1 * above(F.coalesce(detail, F.lit(0.0)))).when(kind == "tech", base + bonus).otherwise(base)
    )
    return T.clamp(score)


def filled_metadata(metadata: Column) -> Column:
    """A map without empty values."""
    return F.map_filter(metadata, lambda k, v: v.isNotNull() & ~v.isin("", "[]", "{}"))


def insight(metadata: Column) -> Column:
    return F.coalesce(*[T.tidy(metadata[k]) for k in ("headline", "role", "source")])


def signals(events: DataFrame, issued_at: Column) -> DataFrame:
    """target_key, signal_type, score, observed_at, metadata, insight; events: target, type, intent, detail, stage, timestamp, metadata."""
    return events.select(
        F.lower("target").alias("target_key"), F.col("type").alias("signal_type"), signal_score(F.col("type"), F.col("intent"), F.col("detail"), F.col("stage")).alias("score"),
        event_timestamp("timestamp", issued_at).alias("observed_at"), filled_metadata(F.col("metadata")).alias("metadata"), insight(F.col("metadata")).alias("insight"),
    )


def target_keys(targets: DataFrame) -> DataFrame:
    """target_slug, key, choice: the names under which a target is looked up, best first. targets: identifier, slug."""
    names = F.array(F.lower("slug"), T.slugify_ascii("identifier"), F.lower("identifier"))
    return targets.select(F.coalesce("slug", T.slugify_ascii("identifier")).alias("target_slug"), F.posexplode(F.array_distinct(F.filter(names, lambda x: x.isNotNull()))).alias("choice", "key"))


def match_targets(found: DataFrame, targets: DataFrame) -> DataFrame:
    """Signals with target_slug, each once for a target whatever number of names it matches by."""
    keys = target_keys(targets).groupBy("key", "target_slug").agg(F.min("choice").alias("choice"))
    return found.join(keys.select("key", "target_slug"), F.col("target_key") == F.col("key")).drop("key")


def dedup_signals(found: DataFrame, position: str = "seq") -> DataFrame:
    """The last signal of each (target, type, time)."""
    return keep_first(found, ["target_slug", "signal_type", "observed_at"], [F.col(position).desc()])



def with_cache(fresh: DataFrame, store: DataFrame, now: Column, ttl_minutes: int = 180) -> DataFrame:
    """Stored signals of a (target, type) that are young enough take the place of fresh ones."""
    live = store.filter(F.col("retrieved_at") >= now - F.make_dt_interval(mins=F.lit(ttl_minutes)))
    return live.unionByName(fresh.join(live.select("target_slug", "signal_type").distinct(), ["target_slug", "signal_type"], "left_anti"), allowMissingColumns=True)


def since(df: DataFrame, column: str, start: Column) -> DataFrame:
    return df.filter(F.col(column) >= start)


def digest(found: DataFrame, targets: DataFrame | None = None, *, position: str = "seq", insights: int = 5) -> DataFrame:
    """target_slug, score, signal_count, signal_types, last_observed_at, top_insights.

    score: weighted mean (column ``weight``, 1 by default) on the logistic scale. Targets without signals are kept. Insights are ranked
    before they are gathered, so a target with very many signals gathers ``insights`` of them at most.
    """
    w = F.col("weight") if "weight" in found.columns else F.lit(1.0)
    main = found.groupBy("target_slug").agg(
        T.logistic_scale(F.sum(F.col("score") * w) / F.sum(w)).alias("score"), F.count("*").alias("signal_count"), F.array_sort(F.collect_set("signal_type")).alias("signal_types"), F.max("observed_at").alias("last_observed_at"),
    )
    from goldpan.operators.stats import first_per_key

    top = first_per_key(found.filter("insight is not null"), "target_slug", "insight", position, insights).withColumnRenamed("first_insights", "top_insights")
    out = main.join(top, "target_slug", "left")
    if targets is not None:
        out = targets.select("target_slug").distinct().join(out, "target_slug", "left").withColumns({"score": F.coalesce("score", F.lit(0.0)), "signal_count": F.coalesce("signal_count", F.lit(0))})
    return out


def resolve_digest(entities: DataFrame, found: DataFrame) -> DataFrame:
    """Entities with a digest by slug, else by the slug of the name, else by the name: the first that has one."""
    side = lambda p: found.select(F.lower("target_slug").alias(f"_{p}k"), F.struct("score", "signal_count").alias(f"_{p}"))
    keys = {"a": F.lower("organization_slug"), "b": T.slugify_ascii("organization_name"), "c": F.lower("organization_name")}
    out = entities
    for p, key in keys.items():
        out = out.join(side(p), key == F.col(f"_{p}k"), "left")
    return out.withColumn("intent", F.coalesce("_a", "_b", "_c")).drop("_a", "_b", "_c", "_ak", "_bk", "_ck")


def backfill_runs(spark, start: str, end: str, versions: list[str], pattern: str = "{dataset}/{version}/{date}", dataset: str = "refined") -> DataFrame:
    """run_date, version, path for each day and version of a window."""
    days = spark.sql("SELECT explode(sequence(date(:a), date(:b), interval 1 day)) AS run_date", args={"a": start, "b": end})
    path = F.lit(pattern)
    for k, v in (("{dataset}", F.lit(dataset)), ("{version}", F.col("version")), ("{date}", F.date_format("run_date", "yyyy-MM-dd"))):
        path = F.replace(path, F.lit(k), v)
    return days.withColumn("version", F.explode(F.array(*map(F.lit, versions)))).withColumn("path", path)
