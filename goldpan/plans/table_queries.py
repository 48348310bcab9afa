"""Queries of loaders, sinks, mapping, provenance and checks: each writes what it is about and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldpan.functions import similarity
from goldpan.functions import text as T
from goldpan.operators import dedup, linkage, mapping, party, privacy, quality, survivorship
from goldpan.plans.tables import PRIORITIES, organisations, read
from goldpan.scratch import new_path, written
from goldpan.sources import readers, sinks

NOW = "2024-02-01 00:00:00"


def _staged(spark, folder, df, sheet):
    return readers.stage(df, folder, "book", sheet)


def sheets_two(spark, d):
    """Organisations and their contacts from two staged sheets"""
    s, c, k = read(spark, d, "supplier"), read(spark, d, "customer"), F.col("c_custkey")
    folder = new_path(spark, "sheets")
    j = F.col("s_suppkey")
    orgs = s.select(
        j.alias("ID"), F.when(j % 9 == 0, "  ").otherwise(F.concat(F.lit(" "), "s_name")).alias("Organisation Name"), F.concat(F.lit("area "), F.col("s_nationkey")).alias("Area"), F.when(j % 2 == 0, F.concat(j, F.lit(" Dock"))).alias("Address"),
        F.lit("Club").alias("Type"), F.concat(F.lit("https://s"), j, F.lit(".example")).alias("Website"), F.lit(None).cast("string").alias("Planes"), F.when(j % 3 == 0, "School").alias("Description Type"),
        F.when(j % 4 != 0, F.concat(F.lit("note "), j)).alias("Notes"), F.when(j % 5 == 0, "why?").alias("Open Questions"), F.lit("2024-01-05").alias("Reachout Date"), j.alias("pos"),
    )
    people = c.select(
        (F.col("c_nationkey") + 1).alias("ID"), F.when(k % 7 != 0, "Ann").alias("Firstname"), F.col("c_name").alias("Surname"), F.when(k % 3 == 0, " Owner ").alias("Position"),
        F.when(k % 2 == 0, F.concat(F.lit("082 "), F.lpad((k % 10_000_000).cast("string"), 7, "0"))).alias("Phone"), F.when(k % 2 == 1, F.concat(F.lit("083 "), F.lpad((k % 10_000_000).cast("string"), 7, "0"))).alias("WhatsApp"),
        F.when(k % 4 != 0, F.concat(F.lit("U"), k, F.lit("@Ex.example"))).alias("Email"), k.alias("pos"),
    )
    out = readers.organisation_source(_staged(spark, folder, orgs, "Organisation"), _staged(spark, folder, people, "Contact Info"))
    lists = [F.coalesce(F.array_join(c_, "|"), F.lit("")).alias(c_) for c_ in mapping.LIST_COLUMNS]
    return out.select("source_record_id", "organization_name", "area", "address", "description", "notes", "website", *lists)


def sheets_four(spark, d):
    """Companies, contacts, first filled addresses and last capture notes"""
    s, c, o, k, j = read(spark, d, "supplier"), read(spark, d, "customer"), read(spark, d, "orders"), F.col("c_custkey"), F.col("s_suppkey")
    none = F.lit(None).cast("string")
    companies = s.select(j.alias("C_ID"), F.col("s_name").alias("Company"), F.lit("Charter").alias("Category"), F.when(j % 2 == 0, "Open").alias("Status"), none.alias("Website"), F.lit("2").alias("Priority"), F.lit("2023-06-01").alias("Last_Order_Date"), j.alias("pos"))
    people = c.select((F.col("c_nationkey") + 1).alias("C_ID"), F.lit("Bo").alias("FirstName"), F.col("c_name").alias("Surname"), F.lit("Pilot").alias("Position"), none.alias("Cellnumber"), F.concat(F.lit("011 "), F.lpad((k % 10_000_000).cast("string"), 7, "0")).alias("Landline"), F.concat(F.lit("b"), k, F.lit("@x.example")).alias("Email"), k.alias("pos"))
    places = c.select((F.col("c_nationkey") + 1).alias("C_ID"), F.when(k % 3 == 0, F.concat(F.lit("Field "), k)).alias("Airport"), F.when(k % 2 == 0, F.concat(F.lit("Hangar "), k % 10)).alias("Unnamed: 4"), k.alias("pos"))
    notes = o.select(F.upper(F.concat(F.lit("Supplier#"), F.lpad((F.col("o_custkey") % 50 + 1).cast("string"), 9, "0"))).alias("School"), F.concat(F.lit("call "), "o_orderkey").alias("Description"), F.col("o_orderpriority").alias("Type"), F.col("o_orderkey").alias("pos"))
    out = readers.company_source(companies, people, places, notes)
    return out.select("source_record_id", "organization_name", "address", "status", "notes", F.size("contact_emails").cast("long").alias("n_emails"), F.get("contact_phones", F.lit(0)).alias("first_phone"), F.get("contact_names", F.lit(0)).alias("first_name"))


def sheet_one(spark, d):
    """One contact a row"""
    j = F.col("s_suppkey")
    rows = read(spark, d, "supplier").select(
        F.when(j % 8 != 0, F.col("s_name")).alias("Name of Organisation"), F.when(j % 2 == 0, "KZN").otherwise("gauteng province").alias("Province"), F.when(j % 3 == 0, "Active").alias("Status"), F.concat(F.lit("https://s"), j, F.lit(".example")).alias("Website URL"),
        F.when(j % 5 != 0, F.concat(F.lit("Cy "), j)).alias("Contact Person"), F.concat(F.lit("082 "), F.lpad(j.cast("string"), 7, "0")).alias("Contact Number"), F.when(j % 4 == 0, F.concat(F.lit("a"), j, F.lit("@s.example; B"), j, F.lit("@s.example"))).alias("Contact Email Address"), j.alias("pos"),
    )
    out = readers.registry_source(rows)
    return out.select("source_record_id", "province", "area", "category", "status", "website", *[F.array_join(c, "|").alias(c) for c in ("contact_names", "contact_emails", "contact_phones")])


def _orders(spark, d):
    return read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


_ORDER_TYPES = "o_orderkey long, o_custkey long, o_totalprice double, o_orderpriority string"


def _sums(df, name):
    return df.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")).select(F.lit(name).alias("kind"), "*")


def formats_read(spark, d):
    """Json, ndjson, csv, orc and parquet by the end of the name"""
    folder, out = new_path(spark, "formats"), None
    for kind in ("ndjson", "csv", "orc", "parquet"):
        path = sinks.write_as(_orders(spark, d), f"{folder}/orders.{kind}")
        found = _sums(readers.read_any(spark, path, _ORDER_TYPES), kind)
        out = found if out is None else out.unionByName(found)
    return out


def lookups_read(spark, d):
    """A Parquet table before a CSV one of that name, CSV where there is no other, and the newest snapshot"""
    folder, o = new_path(spark, "lookups"), _orders(spark, d)
    sinks.write_as(o, f"{folder}/both.parquet")
    sinks.write_as(o.filter("o_orderkey < 0"), f"{folder}/both.csv")
    sinks.write_as(o, f"{folder}/plain.csv")
    sinks.write_as(o.filter("o_orderkey < 0").coalesce(1), f"{folder}/history/a.parquet")
    sinks.write_as(o.coalesce(1), f"{folder}/history/b.parquet")
    parts = [_sums(readers.read_lookup(spark, folder, t).withColumns({"o_totalprice": F.col("o_totalprice").cast("double")}), t) for t in ("both", "plain")]
    return parts[0].unionByName(parts[1]).unionByName(_sums(readers.read_newest(spark, f"{folder}/history/*/*.parquet"), "newest"))


def published(spark, d):
    """A snapshot, and the table in order of names; files don't overlap in names"""
    folder = new_path(spark, "published")
    rows = organisations(spark, d).select("organization_name", "source_record_id")
    sinks.publish(rows, folder, f"{folder}/out.parquet")
    files = spark.read.parquet(f"{folder}/out.parquet").select("*", F.col("_metadata.file_path").alias("f")).groupBy("f").agg(F.count("*").alias("n"), F.min("organization_name").alias("low"), F.max("organization_name").alias("high"))
    before = F.lag("high").over(Window.partitionBy(F.lit(1)).orderBy("f"))  # one row a file
    ordered = files.withColumn("wrong", F.coalesce(before > F.col("low"), F.lit(False))).agg(F.sum("n").alias("n"), F.count_if("wrong").alias("n_wrong"))
    return ordered.select(F.lit("output").alias("what"), "n", "n_wrong").unionByName(spark.read.parquet(f"{folder}/refined.parquet").agg(F.count("*").alias("n")).select(F.lit("snapshot").alias("what"), "n", F.lit(0).cast("long").alias("n_wrong")))


def exported(spark, d):
    """One table in several formats"""
    paths, out = sinks.export(_orders(spark, d), new_path(spark, "export") + "/orders", ["csv", "parquet", "json"]), None
    for kind, path in paths.items():
        reader = spark.read.schema(_ORDER_TYPES)
        df = reader.option("header", True).csv(path) if kind == "csv" else reader.format(kind).load(path)
        out = _sums(df, kind) if out is None else out.unionByName(_sums(df, kind))
    return out


def compressed(spark, d):
    """S10"""
    folder, out = new_path(spark, "codecs"), None
    for codec in ("uncompressed", "snappy", "gzip", "lz4", "zstd"):
        df = spark.read.schema(_ORDER_TYPES).parquet(sinks.write_as(_orders(spark, d), f"{folder}/{codec}", "parquet", compression=codec))
        out = _sums(df, codec) if out is None else out.unionByName(_sums(df, codec))
    return out


def digest_written(spark, d):
    """A digest as csv and json, nested columns as JSON text where the format has none"""
    folder, out = new_path(spark, "digest"), None
    digest = read(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("signal_count"), F.sort_array(F.collect_set("event_type")).alias("signal_types"))
    for kind in ("csv", "json"):
        path = sinks.write_as(digest, f"{folder}/digest.{kind}")
        types = F.from_json("signal_types", "array<string>") if kind == "csv" else F.col("signal_types")
        df = readers.read_any(spark, path, "user_id long, signal_count long, signal_types " + ("string" if kind == "csv" else "array<string>"))
        df = df.select(F.lit(kind).alias("kind"), "user_id", "signal_count", F.array_join(types, ";").alias("signal_types"))
        out = df if out is None else out.unionByName(df)
    return out


def ledger(spark, d):
    """Two appends"""
    path, e = new_path(spark, "ledger") + "/ledger.json", read(spark, d, "events")
    for half in (0, 1):
        records = e.filter(F.col("event_id") % 2 == half).select(F.col("event_id").cast("string").alias("record_id"), F.col("event_type").alias("source"), F.lit("CC-BY").alias("license"), F.create_map(F.lit("user"), F.col("user_id").cast("string")).alias("metadata"))
        sinks.append_ledger(records, path, f"terms {half}", F.lit(NOW).cast("timestamp"))
    rows = spark.read.schema("record_id string, source string, license string, policy_hash string, metadata string, recorded_at timestamp").json(path)
    return rows.groupBy("source", "license", "policy_hash").agg(F.count("*").alias("n"), F.sum(F.get_json_object("metadata", "$.user").cast("long")).alias("users"))


def table_sql(spark, d):
    """SQL with parameters over a registered table"""
    sql = "SELECT o_orderpriority, count(*) AS n FROM ledger_orders WHERE o_totalprice > ? AND o_custkey <> ? GROUP BY o_orderpriority"
    return sinks.query_table(_orders(spark, d), "ledger_orders", sql, [50000.0, 7])


def repeated_columns(spark, d):
    """P02"""
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("name"), F.col("c_nationkey").alias("name"))
    return mapping.distinct_names(c)


def header_matches(spark, d):
    """Equal keys, names with a letter more, and names that fit nothing"""
    n = read(spark, d, "nation")
    k = F.col("n_nationkey")
    header = F.when(k % 3 == 0, F.concat(F.lit("  "), F.initcap("n_name"), F.lit("?"))).when(k % 3 == 1, F.concat("n_name", F.lit("x"))).otherwise(F.concat(F.lit("#"), F.repeat(F.lit("z"), 4 + k.cast("int"))))
    synonyms = n.select(F.lower("n_name").alias("target"), F.concat(F.lit("the "), F.lower("n_name"), F.lit(" column")).alias("synonym"))
    return mapping.match_headers(n.select(header.alias("header")), synonyms).select("header", "target", F.round("score", 6).alias("score"), "outcome")


def mapped_columns(spark, d):
    """P04"""
    return mapping.rename_mapped(read(spark, d, "customer").select("c_custkey", "c_name"), {"c_name": "organization_name", "absent": "x"})


def semantic_types(spark, d):
    """P05"""
    k = F.col("c_custkey")
    c = read(spark, d, "customer").select(
        F.concat(F.lit("u"), k, F.lit("@x.example")).alias("mail"), F.concat(F.lit("+27 82 "), F.lpad(k.cast("string"), 7, "0")).alias("cell"), F.concat(F.lit("https://x.example/"), k).alias("site"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), k.cast("int")), "yyyy-MM-dd").alias("day"),
        "c_acctbal", F.when(k % 2 == 0, "even").otherwise("odd").alias("kind"), "c_name", F.lit(None).cast("string").alias("nothing"),
    )
    return mapping.semantic_types(c)


def row_provenance(spark, d):
    """P14"""
    c = read(spark, d, "customer").select("c_custkey", "c_name", F.concat(F.lit("src"), "c_nationkey").alias("provenance_source"), F.lit(0.9).alias("provenance_confidence"), F.col("c_mktsegment").alias("source_datasets"))
    return mapping.provenance_of(c, "c_custkey", 5)


def cleaned_text(spark, d):
    """N01"""
    return read(spark, d, "documents").select("doc_id", T.clean_text("text").alias("t")).select("doc_id", F.length("t").cast("long").alias("n"), F.sha2("t", 256).alias("sha"))


def row_positions(spark, d):
    """W06"""
    return dedup.with_position(_orders(spark, d)).agg(F.count("*").alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"), F.count_distinct(F.col("pos")).alias("n_distinct"))


def reviewer_decisions(spark, d):
    """Read back from the JSON lines they are kept in"""
    given = F.struct(F.lit(0.8).alias("high"), F.lit(0.5).alias("review"))
    rows = read(spark, d, "orders").select(F.col("o_custkey").alias("l"), F.col("o_orderkey").alias("r"), F.when(F.col("o_orderstatus") == "O", "match").otherwise("reject").alias("decision"), F.when(F.col("o_orderkey") % 3 == 0, given).alias("thresholds"))
    path = sinks.write_as(linkage.reviewer_decisions(rows), new_path(spark, "decisions") + "/decisions.json")
    back = spark.read.schema("l long, r long, decision string, thresholds struct<high: double, review: double>").json(path)
    return back.select("l", "r", "decision", "thresholds.high", "thresholds.review")


def enriched_check(spark, d):
    """Q15"""
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select(F.when(k % 10 != 0, "lookup").alias("provenance_source"), (k % 12 / 10).alias("provenance_confidence"), F.when(k % 4 == 0, "enabled").when(k % 4 == 1, "offline").when(k % 4 == 2, "odd").alias("provenance_network_status"))
    return quality.run_suite(rows, quality.provenance_suite()).select("expectation", "n", "n_bad", F.round("share", 6).alias("share"), "success")


def consent_gate(spark, d):
    """What passes for the rows with consent and stops the rest"""
    k, out = F.col("c_custkey"), None
    rows = read(spark, d, "customer").select("c_custkey", F.when(k % 3 == 0, "denied").otherwise("Granted").alias("consent_status"), F.col("c_name").alias("contact_primary_name"))
    for name, part in (("granted", rows.filter(k % 3 != 0)), ("all", rows)):
        checks = privacy.consent_checks(part)
        try:
            privacy.enforce_consent(checks)
            said = "passed"
        except privacy.ConsentError as error:
            said = str(error)
        found = checks.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n", F.lit(said).alias("said"))
        out = found if out is None else out.unionByName(found)
    return out


def compliance_columns(spark, d):
    """C07"""
    k = F.col("c_custkey")
    rows = read(spark, d, "customer").select("c_custkey", F.when(k % 3 == 0, "granted").when(k % 3 == 1, " ").alias("consent_status"))
    out = privacy.with_compliance_columns(rows, "customers", F.lit(NOW).cast("timestamp"), 30)
    return out.select("c_custkey", "data_source", F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"), "consent_status", "consent_date", F.col("retention_until").cast("string").alias("retention_until"))


def audit_trail(spark, d):
    """An event over a table, its row count and a checksum that row order doesn't change"""
    o = _orders(spark, d)
    event = privacy.audit_events(o, "export", {"rows": F.count("*"), "customers": F.count_distinct(F.col("o_custkey"))}, F.lit(NOW).cast("timestamp"))
    path = sinks.write_as(event, new_path(spark, "audit") + "/audit.json", mode="append")
    said = spark.read.schema("at timestamp, event string, details map<string,string>").json(path)
    sums = privacy.table_checksum(o).select("n_rows", F.col("checksum").alias("a")).join(privacy.table_checksum(o.orderBy(F.desc("o_totalprice"))).select(F.col("n_rows"), F.col("checksum").alias("b")), "n_rows")
    return said.crossJoin(sums).select("event", F.date_format("at", "yyyy-MM-dd").alias("day"), F.col("details")["rows"].alias("rows"), F.col("details")["customers"].alias("customers"), "n_rows", (F.col("a") == F.col("b")).alias("same"))


def archived(spark, d):
    """A snapshot, and whether its files are what their checksums say"""
    path = new_path(spark, "archive")
    files = party.archive(_orders(spark, d), path, "20240201")
    again = spark.read.format("binaryFile").load(f"{path}/snapshot=20240201/*.parquet").select(F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.sha2("content", 256).alias("now"))
    same = files.join(again, "file", "full").agg(F.every(F.coalesce(F.col("sha256") == F.col("now"), F.lit(False))).alias("intact"))
    rows = spark.read.schema(_ORDER_TYPES + ", snapshot string").option("basePath", path).parquet(f"{path}/snapshot=20240201")
    return rows.groupBy("snapshot").agg(F.count("*").alias("n"), F.sum("o_custkey").alias("customers")).crossJoin(same)


def star_written(spark, d):
    """The four tables of the star as they are read back"""
    rows = organisations(spark, d)
    refined = written(survivorship.refine(rows, PRIORITIES), "refined").withColumn("pos", F.col("organization_slug"))
    path = new_path(spark, "star")
    party.write_star(party.party_tables(refined, now=F.lit(NOW).cast("timestamp")), path)
    out = None
    for table in ("parties", "aliases", "contact_methods", "roles"):
        found = spark.read.parquet(f"{path}/{table}").agg(F.count("*").alias("n")).select(F.lit(table).alias("table_name"), "n")
        out = found if out is None else out.unionByName(found)
    return out


def sql_similarity(spark, d):
    """The three similarities in SQL"""
    similarity.register(spark)
    k = F.col("p_partkey")
    read(spark, d, "part").select(k, F.concat(F.lit("North Air "), k % 90).alias("a"), F.when(k % 3 == 0, F.concat(k % 90, F.lit(" Air North"))).when(k % 3 == 1, F.concat(F.lit("South Air "), k % 90)).alias("b")).createOrReplaceTempView("similar_names")
    return spark.sql("SELECT p_partkey, round(token_sort_ratio(a, b), 6) AS token_sort, round(partial_ratio(a, b), 6) AS partial, round(token_set_ratio(a, b), 6) AS token_set FROM similar_names")


TABLE_QUERIES = {
    f.__name__: f
    for f in (
        sheets_two, sheets_four, sheet_one, formats_read, lookups_read, published, exported, compressed, digest_written, ledger, table_sql, repeated_columns, header_matches, mapped_columns, semantic_types,
        row_provenance, cleaned_text, row_positions, reviewer_decisions, enriched_check, consent_gate, compliance_columns, audit_trail, archived, star_written, sql_similarity,
    )
}
