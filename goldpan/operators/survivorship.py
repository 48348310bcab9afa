"""One record for each entity: the best value of each field, its provenance and its conflicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions import contact as C
from goldpan.functions.dates import flexible_timestamp
from goldpan.functions.text import tidy

#: Fields with one best value, fields whose distinct values are joined, and how they are named in the result.
BEST = {"province": "province", "area": "area", "address": "address_primary", "category": "organization_category", "organization_type": "organization_type", "status": "status", "website": "website", "priority": "priority"}
JOINED = ("planes", "description", "notes")
LISTS = {"contact_emails": "email", "contact_phones": "phone", "contact_names": "name", "contact_roles": "role"}
#: What fields are called in provenance, where not by their own name.
NAMES = {**BEST, "contact_emails": "contact_primary_email", "contact_phones": "contact_primary_phone", "contact_names": "contact_primary_name", "contact_roles": "contact_primary_role"}
#: Key of the one group of rows without a slug.
NO_SLUG = "\u0000"


def _priority(priorities: dict[str, int]) -> Column:
    if not priorities:
        return F.lit(0)
    table = F.create_map(*[F.lit(x) for kv in priorities.items() for x in kv])
    return F.coalesce(table[F.col("source_dataset")], F.lit(0))


def ranked(rows: DataFrame, priorities: dict[str, int], *, keep_null_slugs_apart: bool = False) -> DataFrame:
    """Canonical rows with slug, pos and: entity, source_priority, row_quality, seen_at and rank, by which rows of an entity are ordered.

    Order: priority, row quality and last interaction, each highest first, then the earlier row. A rank is a value of its own
    row, so nothing is sorted or shuffled for it and later aggregations combine on the map side, also those of a very large
    entity. Rows without a slug are one entity, or with ``keep_null_slugs_apart`` one each.
    """
    entity = F.coalesce(F.col("slug"), F.concat(F.lit(NO_SLUG), F.col("pos")) if keep_null_slugs_apart else F.lit(NO_SLUG))
    out = rows.withColumns({
        "entity": entity, "source_dataset": F.coalesce(tidy("source_dataset"), F.lit("Unknown")), "seen_at": flexible_timestamp("last_interaction_date"),
        "row_quality": C.row_quality(F.col("contact_emails"), F.col("contact_phones"), F.col("website"), F.col("province"), F.col("address")),
    }).withColumn("source_priority", _priority(priorities))
    unseen = F.lit((1 << 63) - 1)
    order = [-F.col("source_priority"), -F.col("row_quality"), F.coalesce(-F.unix_micros("seen_at"), unseen), F.col("pos"), F.coalesce("source_record_id", F.lit(""))]
    return out.withColumn("rank", F.struct(*[c.alias(n) for c, n in zip(order, ("priority", "quality", "seen", "pos", "record"))]))


def best(value: str, rank: str = "rank") -> Column:
    """The value of lowest rank that isn't null; combines on the map side."""
    v = tidy(value)
    return F.min_by(v, F.when(v.isNotNull(), F.col(rank)))


def long_values(rows: DataFrame) -> DataFrame:
    """entity, field, value, rank, at: every filled value of every field, list fields by position."""
    scalars = [F.struct(F.lit(f).alias("field"), F.array(tidy(f)).alias("values")) for f in ("organization_name", *BEST, *JOINED)]
    lists = [F.struct(F.lit(f).alias("field"), F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), lambda x: tidy(x)).alias("values")) for f in LISTS]
    each = rows.select("entity", "rank", "source_dataset", "source_record_id", "source_priority", "row_quality", "seen_at", F.explode(F.array(*scalars, *lists)).alias("f"))
    return each.select("*", F.col("f.field").alias("field"), F.posexplode("f.values").alias("at", "value")).drop("f").filter(F.col("value").isNotNull())


def distinct_values(rows: DataFrame) -> DataFrame:
    """One row for each (entity, field, value): where it ranks first. Only these are ever gathered into lists."""
    first = F.min(F.struct("rank", "at", "source_dataset", "source_record_id", "source_priority", "row_quality", "seen_at"))
    return long_values(rows).groupBy("entity", "field", "value").agg(first.alias("m")).select("entity", "field", "value", "m.*")


def value_lists(values: DataFrame) -> DataFrame:
    """entity, field, picks: the distinct values of a field in rank order, with their sources."""
    pick = F.struct("rank", "at", "value", "source_dataset", "source_record_id", "source_priority", "row_quality", F.date_format("seen_at", "yyyy-MM-dd").alias("last_interaction_date"))
    return values.groupBy("entity", "field").agg(F.sort_array(F.collect_list(pick)).alias("picks"))


def conflicts(lists: DataFrame) -> DataFrame:
    """entity, field, chosen_source, value, alternatives: fields for which sources don't agree."""
    others = F.transform(F.slice("picks", 2, F.greatest(F.size("picks") - 1, F.lit(1))), lambda p: F.struct(p["source_dataset"].alias("source"), p["value"].alias("value")))
    first = F.get("picks", F.lit(0))
    return lists.filter(F.size("picks") > 1).select("entity", "field", first["source_dataset"].alias("chosen_source"), first["value"].alias("value"), others.alias("alternatives"))


def provenance(lists: DataFrame) -> DataFrame:
    """entity, selection_provenance: JSON of each field's value, source, record, priority, quality, date and other contributors."""
    first = F.get("picks", F.lit(0))
    more = F.transform(F.slice("picks", 2, F.greatest(F.size("picks") - 1, F.lit(1))), lambda p: F.struct(p["source_dataset"].alias("source_dataset"), p["source_record_id"].alias("source_record_id"), p["value"].alias("value")))
    names = F.create_map(*[F.lit(x) for kv in NAMES.items() for x in kv])
    field = F.coalesce(names[F.col("field")], "field")
    entry = F.struct(
        field.alias("field"), first["value"].alias("value"), first["source_dataset"].alias("source_dataset"), first["source_record_id"].alias("source_record_id"),
        first["source_priority"].alias("source_priority"), first["row_quality"].alias("quality_score"), first["last_interaction_date"].alias("last_interaction_date"),
        F.when(F.size("picks") > 1, more).alias("contributors"),
    )
    return lists.groupBy("entity").agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct(field.alias("k"), entry.alias("v")))))).alias("selection_provenance"))


def labels(column: str) -> Column:
    return F.array_join(F.sort_array(F.collect_set(tidy(column))), "; ")


def source_breakdown(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("source_dataset").isNotNull()).groupBy("source_dataset").agg(F.count("*").alias("n"))


def refine(rows: DataFrame, priorities: dict[str, int], *, intent: DataFrame | None = None, country: str = "South Africa", region: str = "ZA", keep_null_slugs_apart: bool = False) -> DataFrame:
    """The refined table: one row for each entity, with contacts, scores, flags, provenance. ``intent``: a digest by target_slug.

    Two aggregations by entity: of rows, and of distinct values. Both combine on the map side; the second sees each
    (entity, field, value) once, so a huge entity's repeated values never meet in one task.
    """
    r = ranked(rows, priorities, keep_null_slugs_apart=keep_null_slugs_apart)
    base = r.groupBy("entity").agg(
        F.min_by(tidy("organization_name"), F.when(tidy("organization_name").isNotNull(), F.col("pos"))).alias("organization_name"), F.max("slug").alias("organization_slug"),
        *[best(f).alias(n) for f, n in BEST.items()], labels("source_dataset").alias("source_datasets"), labels("source_record_id").alias("source_record_ids"),
        F.date_format(F.max("seen_at"), "yyyy-MM-dd").alias("last_interaction_date"),
    )
    lists = value_lists(distinct_values(r))
    wide = lists.groupBy("entity").agg(*[F.max(F.when(F.col("field") == f, F.col("picks"))).alias(f"_{n}") for f, n in (*LISTS.items(), *((j, j) for j in JOINED))])
    values = lambda c: F.transform(F.col(c), lambda p: p["value"])
    head = lambda c: F.get(F.col(c), F.lit(0))
    at = F.coalesce(head("_email")["rank"], head("_phone")["rank"])
    from_row = lambda c: F.coalesce(F.get(F.filter(F.col(c), lambda p: p["rank"] == at), F.lit(0))["value"], head(c)["value"])
    out = base.join(wide, "entity", "left").join(provenance(lists), "entity", "left")
    out = out.withColumns({
        **{j: F.array_join(values(f"_{j}"), "; ") for j in JOINED},
        "contact_primary_email": head("_email")["value"], "contact_primary_phone": head("_phone")["value"], "contact_primary_name": from_row("_name"), "contact_primary_role": from_row("_role"),
        "contact_secondary_emails": F.coalesce(F.array_join(F.slice(values("_email"), F.lit(2), F.greatest(F.size("_email"), F.lit(1))), ";"), F.lit("")), "contact_secondary_phones": F.coalesce(F.array_join(F.slice(values("_phone"), F.lit(2), F.greatest(F.size("_phone"), F.lit(1))), ";"), F.lit("")),
        "_priority": F.coalesce(head("_email")["source_priority"], head("_phone")["source_priority"], head("_name")["source_priority"], F.lit(0)) / max([1, *priorities.values()]),
        "_e": C.validate_email(head("_email")["value"]), "_p": C.validate_phone(head("_phone")["value"], region),
    })
    if intent is not None:
        out = out.join(intent.select(F.col("target_slug").alias("organization_slug"), F.col("score").alias("intent_signal_score"), F.col("signal_count").alias("intent_signal_count"), F.array_join("signal_types", ";").alias("intent_signal_types"), F.col("last_observed_at").alias("intent_last_observed_at"), F.array_join("top_insights", "; ").alias("intent_top_insights")), "organization_slug", "left")
    else:
        out = out.withColumns({"intent_signal_score": F.lit(0.0), "intent_signal_count": F.lit(0).cast("long"), **{c: F.lit(None).cast("string") for c in ("intent_signal_types", "intent_last_observed_at", "intent_top_insights")}})
    filled = [F.col(f"contact_primary_{c}") for c in ("name", "email", "phone", "role")]
    completeness = sum((f.isNotNull().cast("int") for f in filled), F.lit(0)) / 4
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    lead = C.lead_score({"completeness": completeness, "email_confidence": zero(F.col("_e.confidence")), "phone_confidence": zero(F.col("_p.confidence")), "source_priority": F.col("_priority"), "intent": zero(F.col("intent_signal_score"))})
    score, flags = C.record_quality({"contact_email": F.col("contact_primary_email"), "contact_phone": F.col("contact_primary_phone"), "website": F.col("website"), "province": F.col("province"), "address": F.col("address_primary")})
    deliverable = C.deliverability(F.col("_e"), F.col("_p"))
    return out.withColumns({
        "country": F.lit(country), "contact_primary_email_confidence": F.col("_e.confidence"), "contact_primary_email_status": F.col("_e.status"),
        "contact_primary_phone_confidence": F.col("_p.confidence"), "contact_primary_phone_status": F.col("_p.status"),
        "contact_primary_lead_score": F.when(F.coalesce(*filled[:3]).isNotNull(), lead), "contact_email_confidence_avg": F.col("_e.confidence"), "contact_phone_confidence_avg": F.col("_p.confidence"),
        "contact_verification_score_avg": F.nullif(deliverable, F.lit(0.0)), "contact_lead_score_avg": F.nullif(lead, F.lit(0.0)),
        "intent_signal_score": F.round(zero(F.col("intent_signal_score")), 6), "intent_signal_count": F.coalesce("intent_signal_count", F.lit(0)),
        "contact_validation_flags": F.nullif(F.array_join(F.array_sort(F.array_distinct(C.validation_flags(F.col("_e.status"), F.col("_p.status")))), ";"), F.lit("")),
        "data_quality_score": score, "data_quality_flags": flags, "privacy_basis": F.lit("Legitimate Interest"),
    }).drop("entity", "_priority", "_e", "_p", *[f"_{n}" for n in (*LISTS.values(), *JOINED)])
