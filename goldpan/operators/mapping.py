"""Schema mapping, profiling and row filters."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType
from pyspark.sql.window import Window

#: The canonical columns of a source, and which of them are lists.
SOURCE_COLUMNS = (
    "organization_name", "source_dataset", "source_record_id", "province", "area", "address", "category", "organization_type",
    "status", "website", "planes", "description", "notes", "last_interaction_date", "priority",
    "contact_names", "contact_roles", "contact_emails", "contact_phones",
)
LIST_COLUMNS = ("contact_names", "contact_roles", "contact_emails", "contact_phones")


def canonical(df: DataFrame) -> DataFrame:
    """The canonical columns first, null where missing, then all others."""
    have = set(df.columns)
    typed = lambda c: "array<string>" if c in LIST_COLUMNS else "string"
    own = [F.col(c).cast(typed(c)) if c in have else F.lit(None).cast(typed(c)).alias(c) for c in SOURCE_COLUMNS]
    return df.select(*own, *[F.col(f"`{c}`") for c in df.columns if c not in SOURCE_COLUMNS])


def distinct_names(df: DataFrame) -> DataFrame:
    """A name that comes again gets __dup1, __dup2 and so on."""
    seen: dict[str, int] = {}
    names = []
    for c in df.columns:
        names.append(f"{c}__dup{seen[c]}" if c in seen else c)
        seen[c] = seen.get(c, 0) + 1
    return df.toDF(*names)


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)], dtype=float)


def header_key(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def match_headers(headers: DataFrame, synonyms: DataFrame, *, sure: float = 0.7, likely: float = 0.5) -> DataFrame:
    """header, target, score, outcome (mapped, suggested or unmapped); the best target of each header.

    headers: header; synonyms: target, synonym (a target is its own synonym). Synonyms are a catalogue; it is
    counted, and broadcast up to 10,000 rows; equal keys score 1, and only the rest are compared letter by letter.
    """
    keys = synonyms.select("target", header_key(F.col("synonym")).alias("s")).unionByName(synonyms.select("target", header_key(F.col("target")).alias("s"))).distinct()
    own = headers.select("header").distinct().withColumn("h", header_key(F.col("header")))
    equal = own.join(keys, F.col("h") == F.col("s")).groupBy("header").agg(F.min("target").alias("target")).withColumn("score", F.lit(1.0))
    rest = own.join(equal.select("header"), "header", "left_anti").crossJoin(F.broadcast(keys) if keys.count() <= 10_000 else keys)
    near = rest.withColumn("score", _ratio("h", "s")).groupBy("header").agg(F.max(F.struct("score", F.col("target"))).alias("m")).select("header", "m.target", "m.score")
    found = equal.unionByName(near)
    outcome = F.when(F.col("score") >= sure, "mapped").when(F.col("score") >= likely, "suggested").otherwise("unmapped")
    return found.withColumn("outcome", outcome)


def rename_mapped(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def filled_samples(df: DataFrame, position: str | None = None, n: int = 100) -> DataFrame:
    """column_name, at (from 1), value: the first ``n`` non-null values of each column, as text, by ``position`` or in the order of the files.

    Each column is read on its own, and every task keeps the first ``n`` values it meets in a heap: none is sorted or shuffled
    beyond these, so a task holds ``n`` values of a column, however many rows it reads.
    """
    names = [c for c in df.columns if c != position]
    placed = df.withColumn("_at", F.col(f"`{position}`") if position else F.monotonically_increasing_id())
    one = lambda c: placed.select("_at", F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")).filter("value is not null").orderBy("_at", "value").limit(n)
    first = reduce(DataFrame.unionByName, map(one, names))
    return first.select("column_name", F.row_number().over(Window.partitionBy("column_name").orderBy("_at", "value")).alias("at"), "value")


def semantic_types(df: DataFrame, sample_rows: int = 100, position: str | None = None) -> DataFrame:
    """column_name, semantic_type from the first ``sample_rows`` filled values of each column, wherever in the table they stand.

    Tests, in order, each above 70 % of the values: email, phone, url, date, numeric; then categorical (few distinct values), text;
    a column without values is empty.
    """
    names = [c for c in df.columns if c != position]
    value = F.col("value")
    share = lambda p: F.avg(value.rlike(p).cast("double"))
    found = filled_samples(df, position, sample_rows).groupBy("column_name").agg(
        F.count("*").alias("n"), share(r"^[^@\s]+@[^@\s]+\.[^@\s]+$").alias("email"),
        share(r"^(?![0-9]{4}-[0-9]{2}-[0-9]{2}$)\+?[0-9()\s-]{7,}$").alias("phone"), share(r"^(https?://|www\.)").alias("url"),
        F.avg(F.to_date(F.try_to_timestamp(F.substring(value, 1, 10), F.lit("yyyy-MM-dd"))).isNotNull().cast("double")).alias("date"),
        F.avg(value.try_cast("double").isNotNull().cast("double")).alias("numeric"), (F.count_distinct("value") / F.count("*")).alias("distinct"),
    )
    all_ = df.sparkSession.createDataFrame([(c,) for c in names], "column_name string").join(found, "column_name", "left")
    kind = F.when(F.col("n").isNull(), "empty")
    for name in ("email", "phone", "url", "date", "numeric"):
        kind = kind.when(F.col(name) > 0.7, name)
    return all_.select("column_name", kind.when(F.col("distinct") < 0.1, "categorical").otherwise("text").alias("semantic_type"))


def full_profile(df: DataFrame, position: str | None = None, samples: int = 3) -> DataFrame:
    """``profile`` of each column with its semantic_type and the first ``samples`` filled values."""
    kept = filled_samples(df, position, samples).groupBy("column_name").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("samples"))
    own = df.drop(position) if position else df
    out = profile(own).join(semantic_types(df, position=position), "column_name").join(kept, "column_name", "left")
    return out.withColumn("samples", F.coalesce("samples", F.array().cast("array<string>")))


def profile(df: DataFrame) -> DataFrame:
    """column_name, n_rows, n_missing, pct_missing, n_distinct, pct_distinct: one pass over the table."""
    n = F.count(F.lit(1))
    each = [F.struct(F.lit(c).alias("column_name"), n.alias("n_rows"), (n - F.count(f"`{c}`")).alias("n_missing"), F.count_distinct(F.col(f"`{c}`")).alias("n_distinct")) for c in df.columns]
    out = df.agg(F.array(*each).alias("x")).select(F.explode("x").alias("x")).select("x.*")
    share = lambda c: F.round(F.when(F.col("n_rows") > 0, 100 * F.col(c) / F.col("n_rows")).otherwise(0.0), 2)
    return out.withColumns({"pct_missing": share("n_missing"), "pct_distinct": share("n_distinct")})


def duplicate_rows(df: DataFrame) -> DataFrame:
    """n_rows and n_duplicates (rows beyond the first of each), by hash so that whole rows aren't shuffled twice."""
    return df.groupBy(F.xxhash64(*df.columns).alias("a"), F.xxhash64(F.lit(1), *df.columns).alias("b")).agg(F.count("*").alias("n")).agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_duplicates"))


def completeness(df: DataFrame) -> DataFrame:
    """field, pct_filled: share of non-null, non-blank values of each column, in percent."""
    each = [F.struct(F.lit(c).alias("field"), F.round(100 * F.avg((F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) != "").cast("double")), 2).alias("pct_filled")) for c in df.columns]
    return df.agg(F.array(*each).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def policy_split(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that may be used, and warnings (with reasons) for those whose robots or terms flags are false."""
    robots, terms = (F.coalesce(~F.col(c), F.lit(False)) for c in ("robots_allowed", "tos_accepted"))
    reasons = F.filter(F.array(F.when(robots, "robots_disallowed"), F.when(terms, "tos_not_accepted")), lambda x: x.isNotNull())
    marked = df.withColumn("reasons", reasons)
    return marked.filter(F.size("reasons") == 0).drop("reasons"), marked.filter(F.size("reasons") > 0)


def allowed(df: DataFrame, policy: DataFrame, column: str = "provider", *, strict: bool = True) -> DataFrame:
    """Rows whose provider the policy names, in any case; with ``strict`` a provider that it doesn't name is an error."""
    names = policy.select(F.lower(F.col(column)).alias("_p")).distinct()
    if strict and (bad := df.join(names, F.lower(df[column]) == F.col("_p"), "left_anti").select(column).first()):
        raise ValueError(f"provider {bad[0]!r} is not in the policy")
    return df.join(names, F.lower(df[column]) == F.col("_p"), "left_semi")


def robots_filter(urls: DataFrame, rules: DataFrame, agent: str) -> DataFrame:
    """Adds ``robots_ok`` to urls (url, host, path): the longest matching prefix decides, and no rule allows.

    rules: host, agent (* for all), prefix, allow. The standard library's parser takes the first match instead.
    """
    own = rules.filter(F.col("agent").isin(agent, "*")).select("host", "prefix", "allow")
    keyed = urls.withColumn("_k", F.xxhash64(*urls.columns))
    verdict = keyed.join(own, "host").filter(F.col("path").startswith(F.col("prefix"))).groupBy("_k").agg(F.max_by("allow", F.struct(F.length("prefix"), F.col("allow"))).alias("_ok"))
    return keyed.join(verdict, "_k", "left").withColumn("robots_ok", F.coalesce("_ok", F.lit(True))).drop("_k", "_ok")


def search_lookup(queries: DataFrame, results: DataFrame, known: DataFrame) -> DataFrame:
    """New targets (identifier, domain) that results hold for any case of a query and that aren't known yet."""
    found = queries.select(F.lower("query").alias("q")).distinct().join(results.withColumn("q", F.lower("query")).drop("query"), "q").select("identifier", "domain").distinct()
    return found.join(known.select("identifier", "domain"), ["identifier", "domain"], "left_anti")


def row_diff(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key, field, old, new for each value that changed; two nulls are equal."""
    long = lambda df, name: df.select(F.col(key), F.explode(F.map_from_entries(F.array(*[F.struct(F.lit(c), F.col(f"`{c}`").cast("string")) for c in df.columns if c != key]))).alias("field", name))
    return long(before, "old").join(long(after, "new"), [key, "field"], "full").filter(~F.col("old").eqNullSafe(F.col("new")))


def backfill_plan(df: DataFrame, fields: list[str]) -> DataFrame:
    """Adds ``backfill``: which of the fields are null or blank."""
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    return df.withColumn("backfill", F.filter(F.array(*[F.when(blank(f), F.lit(f)) for f in fields]), lambda x: x.isNotNull()))


def provenance_of(df: DataFrame, key: str, value) -> DataFrame:
    """One row's provenance columns."""
    columns = [c for c in df.columns if c == key or c.startswith("provenance_") or c in ("selection_provenance", "source_datasets", "source_record_ids")]
    return df.filter(F.col(key) == value).select(*columns)
