"""Enrichment from stored tables: lookups, registries, pages, providers, caches."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions import text as T
from goldpan.functions.dates import registry_date
from goldpan.operators.dedup import keep_first


def lookup_first(df: DataFrame, table: DataFrame, name: Column, table_name: Column, order: list[Column], fields: list[str], prefix: str) -> DataFrame:
    """Left join on names in lower case; of several rows of the table the first by ``order``. Fields come as prefix + field."""
    keyed = table.withColumn("_k", F.lower(F.trim(table_name))).filter("_k is not null")
    one = keep_first(keyed, ["_k"], order).select("_k", *[F.col(f).alias(f"{prefix}{f}") for f in fields])
    return df.withColumn("_j", F.lower(F.trim(name))).join(one, F.col("_j") == F.col("_k"), "left").drop("_j", "_k")


@dataclass(frozen=True)
class Source:
    """One step of a cascade: ``data`` is a struct column with the fields it offers, null where it knows nothing."""

    name: str
    confidence: float
    data: Column
    network: bool = False


def cascade(df: DataFrame, sources: list[Source], fields: list[str], *, threshold: float = 0.7, allow_network: bool = False) -> DataFrame:
    """Fill empty fields from the first source at or above the threshold, else from the one of highest confidence.

    Adds provenance_source, provenance_confidence, provenance_strategy, provenance_network_status and ``attempts`` (array
    of source, confidence, succeeded, status). Steps behind the one that was taken aren't attempts.
    """
    used = [s for s in sources if allow_network or not s.network]
    picks = F.filter(F.array(*[F.when(s.data.isNotNull(), F.struct(F.lit(i).alias("i"), F.lit(s.confidence).alias("confidence"), F.lit(s.name).alias("name"))) for i, s in enumerate(used)]), lambda x: x.isNotNull())
    sure = F.get(F.filter(picks, lambda x: x["confidence"] >= threshold), F.lit(0))
    best = F.get(F.sort_array(F.transform(picks, lambda x: F.struct(x["confidence"].alias("confidence"), (-x["i"]).alias("order"), x["i"].alias("i"))), asc=False), F.lit(0))
    at = F.coalesce(sure["i"], best["i"])
    out = df.withColumn("_picks", picks).withColumn("_at", F.when(F.size("_picks") > 0, at))
    fill = {}
    for f in fields:
        value = F.lit(None).cast("string")
        for i, s in reversed(list(enumerate(used))):
            value = F.when(F.col("_at") == i, s.data[f]).otherwise(value)
        fill[f] = F.coalesce(T.tidy(f), value)
    tried = F.array(*[F.when(F.col("_at").isNull() | (F.col("_at") >= i), F.struct(F.lit(s.name).alias("source"), F.lit(s.confidence).alias("confidence"), s.data.isNotNull().alias("succeeded"), F.lit("enabled" if allow_network else "disabled").alias("status"))) for i, s in enumerate(used)])
    skipped = F.array(*[F.struct(F.lit(s.name).alias("source"), F.lit(0.0).alias("confidence"), F.lit(False).alias("succeeded"), F.lit("skipped: network disabled").alias("status")) for s in sources if s not in used])
    attempts = F.filter(tried, lambda x: x.isNotNull()) if len(used) == len(sources) else F.concat(F.filter(tried, lambda x: x.isNotNull()), skipped)

    def pick(values: list, default) -> Column:
        value = F.lit(default)
        for i, v in enumerate(values):
            value = F.when(F.col("_at") == i, v).otherwise(value)
        return value

    return out.withColumns({
        "attempts": attempts, "provenance_source": pick([s.name for s in used], "original"), "provenance_confidence": pick([s.confidence for s in used], 1.0),
        "provenance_strategy": F.when(F.col("_at").isNotNull(), "deterministic").otherwise("none"), "provenance_network_status": F.lit("enabled" if allow_network else "disabled"), **fill,
    }).drop("_picks", "_at")


def provenance_entries(enriched: DataFrame, key: str) -> DataFrame:
    """key, seq, source, confidence, strategy, network_status: a row for each attempt."""
    rows = enriched.select(key, "provenance_strategy", F.posexplode("attempts").alias("seq", "a"))
    return rows.select(key, "seq", "a.source", "a.confidence", F.when(F.col("a.succeeded"), "deterministic").otherwise("none").alias("strategy"), F.col("a.status").alias("network_status"))


def page_columns(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds page_title, page_description, page_text_length, page_enriched from raw HTML."""
    h = F.coalesce(F.col(html), F.lit(""))
    pick = lambda p: F.nullif(F.trim(F.regexp_replace(F.regexp_extract(h, p, 1), r"\s+", " ")), F.lit(""))
    return pages.withColumns({
        "page_title": pick(r"(?is)<title[^>]*>(.*?)</title>"), "page_description": pick(r"""(?is)<meta[^>]+name=["']description["'][^>]*content=["']([^"']*)["']"""),
        "page_text_length": F.length(page_text(F.col(html))), "page_enriched": F.length(page_text(F.col(html))) > 0,
    })


def page_text(html: Column) -> Column:
    """Text without scripts, styles and tags, white space collapsed."""
    body = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(body, r"(?s)<[^>]*>", " "), r"\s+", " "))


def first_email_in(text: Column) -> Column:
    """The first word with an @ and a full stop."""
    return F.get(F.filter(F.split(text, r"\s+"), lambda w: w.contains("@") & w.contains(".")), F.lit(0))


REGISTRY = (
    "struct<enterprise_name:string,company_name:string,name:string,enterprise_number:string,registration_number:string,certificate_number:string,"
    "status:string,enterprise_status:string,enterprise_type:string,company_type:string,operator_type:string,registration_date:string,issued:string,"
    "registered_address:struct<line1:string,line2:string,city:string,province:string,postal_code:string,country:string>,"
    "directors:array<struct<name:string,full_name:string,role:string,designation:string,appointment_date:string>>,"
    "officers:array<struct<name:string,full_name:string,role:string,designation:string,appointment_date:string>>>"
)


def registry_entry(payload: Column) -> Column:
    """Registry JSON of either kind as one struct: name, number, status, type, date, address, officers."""
    e = F.from_json(payload, REGISTRY)
    a = e["registered_address"]
    officers = F.transform(F.coalesce(e["directors"], e["officers"]), lambda o: F.struct(F.coalesce(o["name"], o["full_name"]).alias("name"), F.coalesce(o["role"], o["designation"]).alias("role"), registry_date(o["appointment_date"]).alias("since")))
    return F.struct(
        F.coalesce(e["enterprise_name"], e["company_name"], e["name"]).alias("name"), F.coalesce(e["enterprise_number"], e["registration_number"], e["certificate_number"]).alias("number"),
        F.coalesce(e["enterprise_status"], e["status"]).alias("status"), F.coalesce(e["enterprise_type"], e["company_type"], e["operator_type"]).alias("type"), registry_date(F.coalesce(e["registration_date"], e["issued"])).alias("date"),
        T.join_filled([a[f] for f in ("line1", "line2", "city", "province", "postal_code", "country")], ", ").alias("address"), officers.alias("officers"),
    )


def registry_columns(df: DataFrame, responses: DataFrame, name: str) -> DataFrame:
    """Adds registry_type, registry_status, registry_number, registry_enriched; responses: query, payload, registry."""
    one = keep_first(responses, ["query"], [F.col("registry"), F.col("payload")]).select(F.lower("query").alias("_q"), "registry", registry_entry(F.col("payload")).alias("_e"))
    return df.join(one, F.lower(F.col(name)) == F.col("_q"), "left").withColumns({
        "registry_type": F.col("registry"), "registry_status": F.col("_e.status"), "registry_number": T.normalize_identifier("_e.number"), "registry_enriched": F.col("_e.name").isNotNull(),
    }).drop("_q", "_e", "registry")


def cache_get(cache: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    """The newest live entry of each key; cache: key, value, created_at, hits."""
    live = cache.filter(F.col("created_at") >= now - F.make_dt_interval(secs=F.lit(ttl_seconds)))
    return keep_first(live, ["key"], [F.col("created_at").desc(), F.col("value")])


def cache_stats(cache: DataFrame, now: Column, ttl_seconds: int) -> DataFrame:
    live = F.col("created_at") >= now - F.make_dt_interval(secs=F.lit(ttl_seconds))
    return cache.agg(F.count("*").alias("entries"), F.count_if(live).alias("live"), F.count_if(~live).alias("expired"), F.sum("hits").alias("hits"), F.avg("hits").alias("mean_hits"))


def cache_key(parts: dict[str, Column]) -> Column:
    """First 16 digits of the SHA-256 of sorted k:v pairs."""
    return F.substring(F.sha2(F.concat_ws("|", *[F.concat(F.lit(f"{k}:"), F.coalesce(parts[k].cast("string"), F.lit(""))) for k in sorted(parts)]), 256), 1, 16)


def provider_records(targets: DataFrame, provider: DataFrame, name: str) -> DataFrame:
    """Targets (identifier, domain) with a provider's record: by identifier, else by domain; a row for each contact.

    provider: identifier, domain, organization_name, contacts (array of name, role, email, phone).
    """
    by_id = targets.join(provider.drop("domain"), "identifier")
    by_domain = targets.join(provider.select("identifier"), "identifier", "left_anti").filter("domain is not null").join(provider.drop("identifier"), "domain")
    rows = by_id.unionByName(by_domain).select("identifier", "domain", "organization_name", F.posexplode_outer("contacts").alias("at", "c"))
    return rows.select(
        F.lit(name).alias("source_dataset"), F.concat_ws(":", F.lit(name), "identifier", "at").alias("source_record_id"), "organization_name", "domain", F.col("c.name").alias("contact_name"),
        F.col("c.role").alias("contact_role"), T.normalize_email("c.email").alias("contact_email"), T.normalize_phone("c.phone").alias("contact_phone"),
    )


def crawl_pages(targets: DataFrame, pages: DataFrame) -> DataFrame:
    """Targets with their page by identifier, else by domain, and its contacts as arrays without nulls."""
    side = lambda key, p: pages.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_{p}k")).agg(F.max(F.struct("url", "contacts")).alias(f"_{p}"))
    out = targets.join(side("identifier", "i"), F.col("identifier") == F.col("_ik"), "left").join(side("domain", "d"), F.col("domain") == F.col("_dk"), "left").withColumn("_page", F.coalesce("_i", "_d"))
    some = lambda f: F.filter(F.transform("_page.contacts", f), lambda x: x.isNotNull())
    return out.select("identifier", "domain", F.col("_page.url").alias("url"), some(lambda c: T.normalize_email(c["email"])).alias("contact_emails"), some(lambda c: T.tidy(c["name"])).alias("contact_names"))


def authority_hits(entities: DataFrame, sources: DataFrame, snapshots: DataFrame) -> DataFrame:
    """slug, source, url for each configured source that has the entity; sources: source, cache_key."""
    stored = snapshots.groupBy("cache_key", "slug").agg(F.min("url").alias("url")).join(entities.select("slug").distinct(), "slug", "left_semi")
    return stored.join(sources.select("source", "cache_key"), "cache_key").select("slug", "source", "url")


def acquire(targets: DataFrame, providers: dict[str, DataFrame], policies: DataFrame | None = None) -> DataFrame:
    """Canonical records of all providers, one for each (dataset, record id); providers whose policy forbids use are left out."""
    out = None
    for name, table in providers.items():
        rows = provider_records(targets, table, name)
        out = rows if out is None else out.unionByName(rows)
    if policies is not None:
        bad = policies.filter(F.col("robots_allowed").eqNullSafe(F.lit(False)) | F.col("tos_accepted").eqNullSafe(F.lit(False))).select(F.lower("provider").alias("_p"))
        out = out.join(bad, F.lower("source_dataset") == F.col("_p"), "left_anti")
    return keep_first(out, ["source_dataset", "source_record_id"], [F.col("organization_name"), F.col("contact_email")])


def research_plan(df: DataFrame, fields: list[str]) -> DataFrame:
    """entity, slug, urls (distinct, with protocol), backfill (empty fields), steps (name to planned or skipped)."""
    urls = F.array_distinct(F.filter(F.array(T.normalize_website("website"), T.website_of_email("contact_primary_email")), lambda x: x.isNotNull()))
    backfill = F.filter(F.array(*[F.when(T.tidy(f).isNull(), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    plan = df.select(F.col("organization_name").alias("entity"), F.coalesce(T.tidy("organization_slug"), T.slugify_ascii("organization_name")).alias("slug"), urls.alias("urls"), backfill.alias("backfill"))
    step = lambda on: F.when(on, "planned").otherwise("skipped")
    return plan.withColumn("steps", F.create_map(F.lit("local"), F.lit("planned"), F.lit("crawl"), step(F.size("urls") > 0), F.lit("backfill"), step(F.size("backfill") > 0)))


class Registry:
    """Named steps DataFrame -> DataFrame, run in the order in which they were added, each if it is enabled."""

    def __init__(self) -> None:
        self.steps: dict[str, tuple[Callable[[DataFrame], DataFrame], Callable[[], bool]]] = {}

    def add(self, name: str, step: Callable[[DataFrame], DataFrame], enabled: Callable[[], bool] = lambda: True) -> "Registry":
        if name in self.steps:
            raise ValueError(f"{name} is taken")
        self.steps[name] = (step, enabled)
        return self

    def __call__(self, df: DataFrame) -> DataFrame:
        for step, enabled in self.steps.values():
            if enabled():
                df = df.transform(step)
        return df


def recent(df: DataFrame, by: str, n: int = 20) -> DataFrame:
    return df.orderBy(F.col(by).desc()).limit(n)
