"""Parties, aliases, roles and contact methods from the refined table; versions and snapshots of datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions import contact as C
from goldpan.functions import text as T
from goldpan.operators.dedup import keep_first
from goldpan.operators.privacy import table_checksum

_ENTRY = "map<string,struct<field:string,value:string,source_dataset:string,source_record_id:string,source_priority:double,quality_score:double,last_interaction_date:string>>"


def provenance_map(raw: Column) -> Column:
    """Field to provenance; text that isn't JSON is an empty map."""
    return F.coalesce(F.from_json(raw, _ENTRY), F.create_map().cast(_ENTRY))


def party_id(kind: str, key: Column) -> Column:
    """A stable id in the form of a UUID, from the party's key."""
    h = F.sha2(F.concat(F.lit(f"{kind}:"), key), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def _prepared(refined: DataFrame, position: str) -> DataFrame:
    email, phone, name = (T.tidy(f"contact_primary_{c}") for c in ("email", "phone", "name"))
    person = F.coalesce(F.concat(F.lit("email:"), F.lower(email)), F.concat(F.lit("phone:"), phone), F.concat(F.lit("name:"), F.lower(name)))
    return refined.withColumns({
        "_slug": F.coalesce(T.tidy("organization_slug"), F.col(position).cast("string")), "_person": person, "_p": provenance_map(F.col("selection_provenance")), "_pos": F.col(position),
    }).withColumns({"_org_id": party_id("organisation", F.col("_slug")), "_person_id": party_id("person", F.col("_person"))})


def _confidence(field: str, default: float) -> Column:
    entry = F.col("_p")[field]
    return C.confidence(default, F.floor(entry["source_priority"]), entry["quality_score"])


def _source(*fields: str) -> list[Column]:
    entry = F.coalesce(*[F.col("_p")[f] for f in fields])
    return [entry["source_dataset"].alias("provenance_source"), entry["source_record_id"].alias("provenance_record_id")]


def party_tables(refined: DataFrame, *, now: Column, country: str | None = None, position: str = "pos") -> dict[str, DataFrame]:
    """parties, aliases, roles, contact_methods. Of rows with one key the first by position makes the party."""
    r = _prepared(refined, position)
    first_org = keep_first(r, ["_slug"], [F.col("_pos")])
    first_person = keep_first(r.filter("_person is not null"), ["_person"], [F.col("_pos")])
    org_name = F.coalesce(T.tidy("organization_name"), F.col("_slug"))
    person_name = F.coalesce(T.tidy("contact_primary_name"), T.tidy("contact_primary_email"), T.tidy("contact_primary_phone"))
    own_country = T.tidy("country") if "country" in refined.columns else F.lit(None).cast("string")
    party = lambda df, i, kind, name, normal, where, field: df.select(F.col(i).alias("party_id"), F.lit(kind).alias("kind"), name.alias("display_name"), normal.alias("normalized_name"), where.alias("country_code"), now.alias("created_at"), now.alias("updated_at"), *_source(field))
    parties = party(first_org, "_org_id", "organisation", org_name, T.slugify_ascii(org_name), F.coalesce(own_country, F.lit(country)), "organization_name").unionByName(
        party(first_person, "_person_id", "person", person_name, F.lower(T.tidy("contact_primary_name")), F.coalesce(F.lit(country), own_country), "contact_primary_name"))

    def alias(df: DataFrame, i: str, value: Column, kind: str, field: str, default: float) -> DataFrame:
        c = _confidence(field, default)
        return df.select(F.col(i).alias("party_id"), value.alias("alias"), F.lit(kind).alias("alias_type"), c.alias("confidence"), C.confidence_band(c).alias("confidence_band"), now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), *_source(field))

    sets = first_org.withColumn("_dataset", F.explode(T.split_multi("source_datasets")))
    aliases = (
        alias(first_org, "_org_id", org_name, "legal", "organization_name", 0.6).unionByName(alias(sets, "_org_id", F.col("_dataset"), "historic", "organization_name", 0.4))
        .unionByName(alias(first_person.filter(T.tidy("contact_primary_name").isNotNull()), "_person_id", T.tidy("contact_primary_name"), "legal", "contact_primary_name", 0.55))
    )
    with_person = r.filter("_person is not null")
    roles = with_person.select(
        F.col("_person_id").alias("subject_party_id"), F.col("_org_id").alias("object_party_id"), F.coalesce(T.tidy("contact_primary_role"), F.lit("Primary contact")).alias("role_name"), F.lit("primary_contact").alias("role_category"),
        F.lit(True).alias("is_primary"), F.coalesce(F.try_to_timestamp("last_interaction_date"), now).alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), *_source("contact_primary_role", "contact_primary_name", "organization_name"),
    )

    def method(df: DataFrame, i: str, kind: str, value: Column, primary: Column, confidence: Column, *fields: str) -> DataFrame:
        return df.withColumn("_v", value).filter("_v is not null").select(F.col(i).alias("party_id"), F.lit(kind).alias("method_type"), F.col("_v").alias("value"), primary.alias("is_primary"), confidence.alias("confidence"), now.alias("valid_from"), F.lit(None).cast("timestamp").alias("valid_to"), *_source(*fields))

    email, phone = T.tidy("contact_primary_email"), T.tidy("contact_primary_phone")
    methods = method(with_person, "_person_id", "email", email, F.lit(True), _confidence("contact_primary_email", 0.75), "contact_primary_email", "contact_primary_name")
    for part in (
        method(with_person, "_person_id", "phone", phone, email.isNull(), _confidence("contact_primary_phone", 0.65), "contact_primary_phone", "contact_primary_name"),
        method(with_person.withColumn("_m", F.explode(T.split_multi("contact_secondary_emails"))), "_person_id", "email", F.col("_m"), F.lit(False), F.lit(0.5), "contact_primary_name"),
        method(with_person.withColumn("_m", F.explode(T.split_multi("contact_secondary_phones"))), "_person_id", "phone", F.col("_m"), F.lit(False), F.lit(0.4), "contact_primary_name"),
        method(r, "_org_id", "website", T.tidy("website"), F.lit(True), _confidence("website", 0.6), "website", "organization_name"),
        method(r, "_org_id", "physical_address", T.tidy("address_primary"), F.lit(True), _confidence("address_primary", 0.55), "address_primary", "organization_name"),
    ):
        methods = methods.unionByName(part)
    return {"parties": parties, "aliases": aliases, "roles": roles, "contact_methods": methods}


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, party_id of rows that name a party that isn't there."""
    ids = tables["parties"].select("party_id")
    out = None
    for table, column in (("aliases", "party_id"), ("contact_methods", "party_id"), ("roles", "subject_party_id"), ("roles", "object_party_id")):
        lost = tables[table].select(F.lit(table).alias("table_name"), F.col(column).alias("party_id")).join(ids, "party_id", "left_anti").select("table_name", "party_id")
        out = lost if out is None else out.unionByName(lost)
    return out


def write_star(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def bump(version: Column, level: str) -> Column:
    """version: struct(major, minor, patch)."""
    ma, mi, pa = version["major"], version["minor"], version["patch"]
    parts = {"major": (ma + 1, F.lit(0), F.lit(0)), "minor": (ma, mi + 1, F.lit(0)), "patch": (ma, mi, pa + 1)}[level]
    return F.struct(*[p.cast("int").alias(n) for p, n in zip(parts, ("major", "minor", "patch"))])


def next_version(df: DataFrame, history: DataFrame, dataset: str, level: str, now: Column) -> DataFrame:
    """The version row that follows the latest one of the dataset (0.0.0 if there is none), with rows and checksum of ``df``."""
    latest = history.filter(F.col("dataset") == dataset).agg(F.max(F.struct("major", "minor", "patch")).alias("v"))
    zero = F.struct(*[F.lit(0).alias(n) for n in ("major", "minor", "patch")])
    return latest.select(bump(F.coalesce("v", zero), level).alias("v")).crossJoin(table_checksum(df)).select(F.lit(dataset).alias("dataset"), "v.*", "n_rows", "checksum", now.alias("created_at"))


def archive(df: DataFrame, path: str, stamp: str) -> DataFrame:
    """Write a snapshot under ``snapshot=stamp`` and return its files with their SHA-256: file, bytes, sha256."""
    target = f"{path}/snapshot={stamp}"
    df.write.mode("errorifexists").parquet(target)
    files = df.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(target)
    return files.select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
