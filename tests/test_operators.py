import hashlib
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from goldpan.functions import similarity
from goldpan.functions.similarity import indel
from goldpan.functions.table import register as register_tables
from goldpan.operators import contacts, dedup, enrich, geo, intent, lead, linkage, mapping, party, privacy, quality, stats, survivorship
from goldpan.operators.components import connected_components
from goldpan.plans import refine
from goldpan.plans.queries import _linkable
from goldpan.sources import readers, sinks
from goldpan.streaming import intent as streams

def now():
    return F.lit("2025-04-01 00:00:00").cast("timestamp")


def sheets(spark):
    """The sample books: two organisations in three sources."""
    t = spark.createDataFrame
    orgs = t([(1, "Aero School", "2025-01-15", "JHB", "Flight School", "aero.example", "1 Main Rd", "C172", "Training", "Note", None, 0)], "ID long, `Organisation Name` string, `Reachout Date` string, Area string, Type string, Website string, Address string, Planes string, `Description Type` string, Notes string, `Open Questions` string, pos long")
    info = t([(1, "Jane", "Doe", "Manager", "082 123 4567", None, "jane.doe@aero.example", 0), (1, None, None, None, None, None, None, 1)], "ID long, Firstname string, Surname string, Position string, Phone string, WhatsApp string, Email string, pos long")
    firms = t([(7, "Heli Ops", "March 10, 2025", "Charter", "high", "Active", "http://www.heliops.example/", 0), (8, "Aero School", "10/03/2025", None, None, "Active", None, 1)], "C_ID long, Company string, Last_Order_Date string, Category string, Priority string, Status string, Website string, pos long")
    people = t([(7, "John", "Smith", "CEO", "+27821111111", None, "john@heliops.example", 0)], "C_ID long, FirstName string, Surname string, Position string, Cellnumber string, Landline string, Email string, pos long")
    places = t([(7, None, None, 0), (7, "Lanseria", "Hangar 4", 1), (7, "Other", None, 2)], "C_ID long, Airport string, `Unnamed: 4` string, pos long")
    captures = t([("heli ops", "first", None, 0), ("Heli Ops", "last", "Charter", 1)], "School string, Description string, Type string, pos long")
    registry = t([("Aero School", "gauteng", "Active", "https://aero.example", "Jane Doe", "0821234567", "Jane.Doe@aero.example; ops@aero.example", 0)], "`Name of Organisation` string, Province string, Status string, `Website URL` string, `Contact Person` string, `Contact Number` string, `Contact Email Address` string, pos long")
    return readers.organisation_source(orgs, info), readers.company_source(firms, people, places, captures), readers.registry_source(registry)


def test_refinement_of_three_sources(spark):
    out = refine.run(list(sheets(spark)), refine.Profile(website_share=0.5))
    rows = {r.organization_slug: r for r in out.table.collect()}
    assert set(rows) == {"aero-school", "heli-ops"} and not out.critical and out.invalid.count() == 0
    aero, heli = rows["aero-school"], rows["heli-ops"]
    assert (aero.contact_primary_email, aero.contact_primary_phone, aero.website, aero.province) == ("jane.doe@aero.example", "+27821234567", "https://aero.example", "Gauteng")
    assert aero.data_quality_score == 1.0 and aero.data_quality_flags == "none" and aero.last_interaction_date == "2025-03-10"
    assert aero.contact_secondary_emails == "ops@aero.example" and aero.source_datasets == "Contact Database; Reachout Database; SACAA Cleaned"
    assert (heli.address_primary, heli.notes, heli.contact_primary_role, heli.contact_primary_name) == ("Lanseria, Hangar 4", "last | Charter", "CEO", "John Smith")
    assert '"province":{"field":"province","value":"Gauteng","source_dataset":"SACAA Cleaned"' in aero.selection_provenance
    assert out.expectations.filter(~F.col("success")).count() == 0
    report = out.report.first()
    assert report.total_records == 2 and report.source_breakdown == {"Contact Database": 2, "Reachout Database": 1, "SACAA Cleaned": 1}


def test_survivorship_order_and_partitioning(spark):
    rows = []
    for i in range(60):
        rows.append((f"org-{i % 7}", f"Org {i % 7}", f"d{i % 3}", f"r{i}", f"p{i}" if i % 4 else None, [f"m{i % 5}@x.y"] if i % 3 else [], f"2024-01-{i % 28 + 1:02d}" if i % 2 else None, i))
    df = mapping.canonical(spark.createDataFrame(rows, "slug string, organization_name string, source_dataset string, source_record_id string, province string, contact_emails array<string>, last_interaction_date string, pos long"))
    want = None
    for n in (1, 7, 16):
        got = sorted(survivorship.refine(df.repartition(n), {"d0": 1, "d1": 3, "d2": 2}).drop("selection_provenance").collect(), key=lambda r: r.organization_slug)
        want = want or got
        assert got == want
    best = {}
    for slug, _, dataset, record, province, emails, seen, pos in rows:
        if province:
            key = ({"d0": 1, "d1": 3, "d2": 2}[dataset], bool(emails) + 1, seen or "", -pos)
            best[slug] = max(best.get(slug, ((), None)), (key, province))
    assert {r.organization_slug: r.province for r in want} == {s: p for s, (_, p) in best.items()}


def test_null_slugs_are_one_entity_or_apart(spark):
    df = mapping.canonical(spark.createDataFrame([(None, "A", 1), (None, "B", 2)], "slug string, organization_name string, pos long"))
    assert survivorship.refine(df, {}).count() == 1
    assert survivorship.refine(df, {}, keep_null_slugs_apart=True).count() == 2


def test_rule_linkage_golden(spark):
    df = spark.createDataFrame([(0, "Aero School", "aero-school", "ops@aero.example", "+27821234567", "Gauteng", None), (1, "Aero School", "aero-school", "ops@aero.example", "+27821234567", "Gauteng", None), (2, "Heli Ops", "heli-ops", None, None, None, None), (3, None, None, None, None, None, None), (4, None, None, None, None, None, None)],
                               "id long, organization_name string, organization_slug string, contact_primary_email string, contact_primary_phone string, province string, website string")
    left, scored, review = linkage.link_by_rules(df, high=0.9, review=0.6)
    assert sorted(r.id for r in left.collect()) == [0, 2, 3, 4]  # blank rows don't merge
    (pair,) = scored.collect()
    assert (pair.l, pair.r, pair.classification) == (0, 1, "match") and pair.match_probability == pytest.approx(0.95)
    assert review.count() == 0
    with pytest.raises(ValueError):
        linkage.classify(F.lit(1.0), 0.5, 0.7)


def test_fuzzy_pairs_are_brute_force(spark):
    r = random.Random(3)
    names = ["".join(r.choice("abcde ") for _ in range(r.randint(10, 60))).strip() for _ in range(40)]
    for n in list(names):
        at = r.randrange(len(n))
        names.append(n[:at] + r.choice("xyz") + n[at + 1 :])
        names.append(n[:at] + n[at + 1 :])
    key = lambda s: " ".join(sorted(s.split()))
    for threshold in (0.96, 0.9):
        want = {(i, j) for (i, a), (j, b) in itertools.combinations(enumerate(names), 2) if key(a) and key(b) and indel(key(a), key(b)) >= threshold}
        got = {tuple(x) for x in linkage.fuzzy_pairs(spark.createDataFrame(list(enumerate(names)), "id long, s string"), "s", threshold=threshold).collect()}
        assert got == want


def test_history_is_one_to_one(spark):
    current = spark.createDataFrame([(0, "Beta", "active", "beta"), (1, "Alpha", "closed", "alpha"), (2, "Gamma", "active", None), (3, "Alpha", "active", "alpha")], "pos long, organization_name string, status string, slug string")
    past = spark.createDataFrame([(10, "Alpha", "alpha", ["Alpha Old"], [("active", "2020-01-01")]), (11, "Delta", "delta", ["Beta"], None)], "entity_id long, organization_name string, slug string, name_variants array<string>, status_history array<struct<status:string,date:string>>").withColumn("first_seen", F.lit("2020-01-01").cast("timestamp"))
    got = {(r.organization_name, r.entity_id): r for r in linkage.entity_registry(current, past, now()).collect()}
    assert set(got) == {("Beta", 11), ("Alpha", 10), ("Gamma", 12), ("Alpha", 13)}
    assert [s.status for s in got["Alpha", 10].status_history] == ["active", "closed"] and got["Alpha", 10].name_variants == ["Alpha Old", "Alpha"]


def test_components_and_clusters(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (7, 8), (5, 5), (2, 1), (2, 2)] + [(20 + i, 21 + i) for i in range(15)], "l long, r long")
    got = {r.node: r.component for r in connected_components(edges, "l", "r").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 5: 5, 7: 7, 8: 7} | {20 + i: 20 for i in range(16)}
    ids = spark.createDataFrame([(i,) for i in (1, 2, 3, 4)], "id long")
    assert {r.id: r.cluster_id for r in linkage.clusters(edges, ids).collect()} == {1: 1, 2: 1, 3: 1, 4: 4}


def test_fellegi_sunter(spark):
    rows = linkage.with_link_columns(spark.createDataFrame([(1, "Acme Co", "a@b.c"), (2, "acme co", "a@b.c"), (3, "Other", None)], "id long, organization_name string, contact_primary_email string").selectExpr("*", "cast(null as string) organization_slug", "cast(null as string) contact_primary_phone", "cast(null as string) website", "cast(null as string) province"))
    pairs = spark.createDataFrame([(1, 2), (1, 3)], "l long, r long")
    v = {(r.l, r.r): r for r in linkage.comparison_vectors(rows, pairs).collect()}
    assert (v[1, 2].gamma_link_name, v[1, 2].gamma_link_email, v[1, 2].gamma_link_phone, v[1, 3].gamma_link_name, v[1, 3].gamma_link_email) == (0, 0, -1, 3, -1)
    u = {f: [0.1] * len(levels) for f, levels in linkage.LEVELS.items()}
    p = {(r.l, r.r): r.match_weight for r in linkage.match_probabilities(linkage.comparison_vectors(rows, pairs), u, prior=0.5).collect()}
    assert p[1, 2] == pytest.approx(math.log2(9.7) + math.log2(9.8)) and p[1, 3] == pytest.approx(math.log2(0.5))
    assert linkage.estimate_u(rows, pairs).filter("field = 'link_name'").agg(F.sum("u")).first()[0] == pytest.approx(1)


def test_distances(spark):
    cities = spark.createDataFrame([(0, 40.7128, -74.006), (1, 34.0522, -118.2437), (2, None, 1.0)], "id long, latitude double, longitude double")
    km = {(r.l, r.r): r.km for r in geo.pairs_within(cities, 4000.0).collect()}
    assert km == {(0, 1): pytest.approx(3936, rel=0.01)}
    assert {r.id: r.leader for r in geo.proximity_clusters(cities, 50).collect()} == {0: 0, 1: 1, 2: -1}


@pytest.mark.parametrize("km", [300.0, 2500.0])
def test_near_pairs_and_clusters_are_brute_force(spark, km):
    r = random.Random(4)
    points = [(i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(150)] + [(200, 89.9, 0.0), (201, 89.9, 180.0), (202, 0.0, 179.9), (203, 0.0, -179.9), (204, -90.0, 3.0), (205, -89.9, 100.0)]

    def dist(a, b):
        (_, y, x), (_, v, u) = a, b
        h = math.sin(math.radians(v - y) / 2) ** 2 + math.cos(math.radians(y)) * math.cos(math.radians(v)) * math.sin(math.radians(u - x) / 2) ** 2
        return 2 * geo.RADIUS_KM * math.asin(math.sqrt(min(1, h)))

    df = spark.createDataFrame(points, "id long, latitude double, longitude double")
    near = {(a[0], b[0]) for a, b in itertools.combinations(points, 2) if dist(a, b) <= km}
    assert {(x.l, x.r) for x in geo.pairs_within(df, km).collect()} == near
    leader = {}
    for i, *_ in points:
        if i not in leader:
            leader[i] = i
            for j, *_ in points:
                if (min(i, j), max(i, j)) in near:
                    leader.setdefault(j, i)
    assert {x.id: x.leader for x in geo.proximity_clusters(df, km).collect()} == leader


def test_contract_and_suite(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, None, "2")], "ID long, Name string, Extra string")
    c = quality.Contract("t", quality._fields("ID@number!|Name!|Age@integer"), ("ID",))
    assert {(r.check, r.field, r.n) for r in quality.check_contract(df, c).collect()} == {("missing_column", "Age", 1), ("extra_column", "Extra", 1), ("null", "Name", 1), ("key", "ID", 1)}
    suite = quality.suite_from_json({"expectations": [{"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "Name", "mostly": 0.5}}, {"expectation_type": "expect_column_values_to_match_regex", "kwargs": {"column": "Extra", "regex": "^[0-9]$"}}, {"expectation_type": "expect_column_to_exist", "kwargs": {"column": "Age"}}]})
    got = {r.expectation: r.success for r in quality.run_suite(df, suite).collect()}
    assert got == {"Name not_null": True, "Extra matches": False, "Age exists": False}
    assert {r.expectation: r.unexpected for r in quality.checkpoint(df, suite, "ID").collect()} == {"Name not_null": [], "Extra matches": ["x"], "Age exists": []}
    assert len(quality.CONTRACTS) == 8


def test_all_invalid_keeps_all(spark):
    df = spark.createDataFrame([(1,), (2,)], "v int")
    valid, invalid, critical = quality.split_valid(df, {"big": F.col("v") > 10})
    assert critical and valid.count() == 2 and invalid.count() == 2
    valid, invalid, critical = quality.split_valid(df, {"one": F.col("v") == 1})
    assert not critical and [r.v for r in valid.collect()] == [1] and invalid.first().errors == ["one"]


def test_privacy(spark):
    text = "Mail jane@x.org, card 4111 1111 1111 1111, not 4111 1111 1111 1112, ip 10.0.0.1, see https://a.b/c"
    df = spark.createDataFrame([(1, text, ["a@b.co", "ok"]), (2, None, None)], "k int, t string, l array<string>")
    found = privacy.detect(df, ["t"]).orderBy("k").collect()
    assert found[0].t_pii_types == "CREDIT_CARD,EMAIL_ADDRESS,IP_ADDRESS,URL" and not found[1].t_has_pii
    rows, events = privacy.redact(df, ["t", "l"], "k", "replace")
    assert rows.filter("k = 1").first().l == ["<EMAIL_ADDRESS>", "ok"] and rows.filter("k = 2").first().l is None
    assert sorted((r.column_name, r.value_index, r.type, r.start, r.stop) for r in events.filter("column_name = 't'").collect()) == [("t", None, k, a, b) for k, a, b in (("CREDIT_CARD", 22, 41), ("EMAIL_ADDRESS", 5, 15), ("IP_ADDRESS", 71, 79), ("URL", 85, 98))]
    assert [(r.value_index, r.type, r.start, r.stop, r.score) for r in events.filter("column_name = 'l'").collect()] == [(0, "EMAIL_ADDRESS", 0, 6, 1.0)]
    assert rows.filter("k = 1").first().t == "Mail <EMAIL_ADDRESS>, card <CREDIT_CARD>, not 4111 1111 1111 1112, ip <IP_ADDRESS>, see <URL>"
    for operation, card in (("redact", ""), ("mask", "*" * 19), ("hash", hashlib.sha256(b"4111 1111 1111 1111").hexdigest())):
        assert f"card {card}, not 4111 1111 1111 1112," in df.select(privacy.anonymise(F.col("t"), operation).alias("m")).first().m
    assert df.select(privacy.anonymise(F.col("t"), "mask").alias("m")).first().m.startswith("Mail **********,")
    checks = privacy.consent_checks(spark.createDataFrame([(1, "a", "granted"), (2, "b", None), (3, None, None)], "k int, contact_primary_email string, consent_status string"))
    assert {r.k: r.reason for r in checks.collect()} == {1: None, 2: "missing"}
    with pytest.raises(privacy.ConsentError):
        privacy.enforce_consent(checks)
    c = privacy.with_compliance_columns(df, "src", now(), 30).first()
    assert c.consent_status == "pending" and str(c.retention_until) == "2025-05-01"
    assert privacy.table_checksum(df).first() == privacy.table_checksum(df.repartition(3)).first()


def test_enrichment(spark):
    payload = '{"enterprise_name":"Aero","enterprise_number":"2015/1","enterprise_status":"In Business","registration_date":"01/02/2015","registered_address":{"line1":"1 Rd","city":"JHB"},"directors":[{"full_name":"J D","designation":"Director"}]}'
    e = spark.createDataFrame([(payload,), ("no json",)], "p string").select(enrich.registry_entry(F.col("p")).alias("e")).collect()
    assert (e[0].e.number, e[0].e.date, e[0].e.address, e[0].e.officers[0].name) == ("2015/1", "2015-02-01", "1 Rd, JHB", "J D") and e[1].e.name is None
    with pytest.raises(ValueError):
        mapping.allowed(spark.createDataFrame([("Bad",)], "provider string"), spark.createDataFrame([("good",)], "provider string"))
    plan = enrich.research_plan(spark.createDataFrame([("Aero", None, None, "a@aero.example", None)], "organization_name string, organization_slug string, website string, contact_primary_email string, province string"), ["province"]).first()
    assert plan.slug == "aero" and plan.urls == ["https://aero.example"] and plan.backfill == ["province"] and plan.steps["crawl"] == "planned"
    steps = enrich.Registry().add("x", lambda df: df.withColumn("x", F.lit(1))).add("y", lambda df: df.withColumn("y", F.lit(2)), lambda: False)
    assert steps(spark.range(1)).columns == ["id", "x"]


def test_intent(spark):
    got = spark.createDataFrame([("news", 0.5, 0.4, None), ("hiring", 0.5, None, None), ("tech", 0.5, None, "Production"), ("traffic", 0.95, 2.0, None), ("other", None, 1.0, None)], "t string, i double, d double, s string").select(intent.signal_score(F.col("t"), F.col("i"), F.col("d"), F.col("s")).alias("r")).collect()
    assert [round(r.r, 4) for r in got] == [0.6, 0.62, 0.9, 1.0, 0.0]
    targets = spark.createDataFrame([("Aero School", None), ("Heli", "heli-ops")], "identifier string, slug string")
    found = spark.createDataFrame([("aero-school", 1), ("aero school", 2), ("heli-ops", 3), ("x", 4)], "target_key string, n int")
    assert {(r.target_slug, r.n) for r in intent.match_targets(found, targets).collect()} == {("aero-school", 1), ("aero-school", 2), ("heli-ops", 3)}
    assert intent.backfill_runs(spark, "2024-01-01", "2024-01-03", ["a", "b"]).count() == 6


def test_streams_equal_batches(spark, tmp_path):
    rows = [(f"t{i % 3}", i % 5, f"2024-01-01 {i % 24:02d}:{i % 60:02d}:00", i / 100) for i in range(100)] + [("t0", 9, "2024-03-01 00:00:00", 0.0)]
    spark.createDataFrame(rows, "target_slug string, kind int, at string, score double").selectExpr("target_slug", "kind", "cast(at as timestamp) observed_at", "score", "monotonically_increasing_id() seq").coalesce(1).write.parquet(str(tmp_path / "in"))
    batch = spark.read.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    keys = ["target_slug", "kind"]
    streams.run_to_table(streams.dedup_stream(stream(), keys, watermark="10 days"), str(tmp_path / "a"), str(tmp_path / "ac"))
    assert spark.read.parquet(str(tmp_path / "a")).select(*keys).distinct().count() == batch.select(*keys).distinct().count()
    for name, window in (("b", {"size": "6 hours"}), ("c", {"size": "6 hours", "slide": "3 hours"}), ("d", {"size": "", "session_gap": "30 minutes"})):
        streams.run_to_table(streams.windowed_digest(stream(), watermark="1 hour", **window), str(tmp_path / name), str(tmp_path / f"{name}c"))
        want = streams.windowed_digest(batch, **window).filter("window_end < '2024-02-01'")
        got = spark.read.parquet(str(tmp_path / name)).filter("window_end < '2024-02-01'")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    streams.upsert_stream(stream(), str(tmp_path / "u"), str(tmp_path / "uc"), keys, "seq")
    assert streams.read_store(spark, str(tmp_path / "u"), batch.schema).count() == batch.select(*keys).distinct().count()


def test_lead_model(spark):
    r = random.Random(2)
    rows = [(i, x := r.random(), r.random(), 1.0, int(x + r.gauss(0, 0.1) > 0.5)) for i in range(400)]
    df = spark.createDataFrame(rows, "id long, a double, b double, same double, won int")
    model = lead.train(df, "won", ["a", "b", "same"], thresholds={"roc_auc": 0.8})
    assert model.features == ("a", "b") and model.metrics["roc_auc"] > 0.9
    scored = lead.score(model, df.withColumn("a", F.when(F.col("id") > 0, F.col("a"))))
    assert scored.filter("lead_score < 0 or lead_score > 1").count() == 0 and scored.count() == 400
    with pytest.raises(ValueError):
        lead.predict(model, df.drop("a"))
    with pytest.raises(ValueError):
        lead.train(df, "won", ["same"])


def test_party(spark):
    refined = refine.run(list(sheets(spark))).table.withColumn("pos", F.col("organization_slug"))
    t = party.party_tables(refined, now=now())
    assert {(r.kind, r.display_name) for r in t["parties"].collect()} == {("organisation", "Aero School"), ("organisation", "Heli Ops"), ("person", "Jane Doe"), ("person", "John Smith")}
    assert party.orphans(t).count() == 0 and t["roles"].count() == 2
    email = t["contact_methods"].filter("value = 'jane.doe@aero.example'").first()
    assert email.is_primary and email.confidence == pytest.approx(0.85) and email.provenance_source == "SACAA Cleaned"
    history = spark.createDataFrame([("d", 1, 2, 3)], "dataset string, major int, minor int, patch int")
    v = party.next_version(refined, history, "d", "minor", now()).first()
    assert (v.major, v.minor, v.patch, v.n_rows) == (1, 3, 0, 2)


def test_contacts(spark):
    rows = mapping.canonical(spark.createDataFrame([("o", "A", ["x", "y", None], ["ceo"], ["x@example.com", "y@s.t"], [], 0)], "organization_slug string, source_dataset string, contact_names array<string>, contact_roles array<string>, contact_emails array<string>, contact_phones array<string>, pos long"))
    table = contacts.scored(contacts.exploded(rows, "organization_slug"), {"A": 1})
    assert table.count() == 2
    one = contacts.consolidated(table, "organization_slug").first()
    assert one.primary.name == "x" and one.emails == ["x@example.com", "y@s.t"] and one.phones == []
    assert contacts.with_role(table, "CEO").count() == 1


def test_mapping(spark):
    headers = spark.createDataFrame([("E-mail",), ("Organisation Nme",), ("zzz",)], "header string")
    synonyms = spark.createDataFrame([("email", "e mail"), ("organization_name", "organisation name")], "target string, synonym string")
    got = {r.header: (r.target, r.outcome) for r in mapping.match_headers(headers, synonyms).collect()}
    assert got["E-mail"] == ("email", "mapped") and got["Organisation Nme"] == ("organization_name", "mapped") and got["zzz"][1] == "unmapped"
    kinds = mapping.semantic_types(spark.createDataFrame([(f"a{i}@b.co", f"+2782123456{i}", "https://x.y", "2024-01-02", "3.5", "same words") for i in range(9)], "e string, p string, u string, d string, n string, t string"))
    assert {r.column_name: r.semantic_type for r in kinds.collect()} == {"e": "email", "p": "phone", "u": "url", "d": "date", "n": "numeric", "t": "text"}
    twice = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "a", "b")
    assert mapping.distinct_names(twice).columns == ["a", "a__dup1", "b"]


def test_dedup_and_stats(spark):
    df = dedup.with_position(spark.range(0, 100, 1, 7).toDF("v"))
    assert [r.pos for r in df.orderBy("v").collect()] == list(range(100))
    assert stats.column_stats(df.limit(0), "v").first() == (0.0, 0.0, 0.0)
    due = stats.frameworks_due(spark.createDataFrame([("POPIA", "2025-03-01")], "framework string, run_at string").withColumn("run_at", F.col("run_at").cast("timestamp")), spark.createDataFrame([("popia",), ("iso",)], "framework string"), now())
    assert {r.framework: r.due for r in due.collect()} == {"popia": False, "iso": True}


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, " a ", ["x"]), (2, " ", None)], "k int, s string, l array<string>")
    paths = sinks.export(df, str(tmp_path / "out"), ["csv", "json", "parquet"])
    for kind, path in paths.items():
        back = readers.read_any(spark, path)
        assert back.count() == 2 and back.filter("s is null").count() == 1
    assert readers.read_lookup(spark, str(tmp_path), "out").count() == 2
    with pytest.raises(ValueError):
        readers.read_any(spark, "x.xlsx")
    for at in ("2024-01-01", "2024-01-02"):
        sinks.append_ledger(spark.createDataFrame([("r", "s", "l")], "record_id string, source string, license string"), str(tmp_path / "ledger"), "terms", F.lit(at))
    assert spark.read.json(str(tmp_path / "ledger")).count() == 2
    assert sinks.query_table(df, "t_", "SELECT k FROM t_ WHERE k > ?", [1]).count() == 1
    files = party.archive(df, str(tmp_path / "archive"), "20240101")
    assert files.count() >= 1 and all(len(r.sha256) == 64 for r in files.collect())
    register_tables(spark)
    assert spark.sql("SELECT * FROM contacts_of('Ann <a@x.org>; Bob')").count() == 2


def test_plans_have_no_cartesian_product(spark, sf_dir):
    from goldpan.plans.queries import QUERIES

    for name in ("entity_survivorship", "rule_linkage", "near_suppliers", "fuzzy_parts", "intent_digest"):
        assert "CartesianProduct" not in QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()


def test_fellegi_sunter_query_takes_every_shared_email(spark, tmp_path):
    """All pairs with one slug or one e-mail, row by row, against the query; ids 66,154 apart are alike in all fields."""
    from goldpan.plans.queries import QUERIES

    ids = [*range(1, 130), *range(66155, 66200)]
    spark.createDataFrame([(i,) for i in ids], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    rows = linkage.with_link_columns(_linkable(spark, str(tmp_path)))
    ordered = sorted(ids, key=lambda i: (i % 66154, i))  # the least id of rows alike in all fields says which side they are on
    pairs = spark.createDataFrame([(a, b) for a, b in itertools.combinations(ordered, 2) if a % 97 == b % 97 or a % 31 == b % 31], "l long, r long")
    want = linkage.comparison_vectors(rows, pairs).groupBy("gamma_link_name", "gamma_link_email", "gamma_link_phone").count()
    got = QUERIES["fellegi_sunter"](spark, str(tmp_path)).drop("match_weight")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_target_signals_match_every_customer(spark, tmp_path):
    from goldpan.plans.queries import QUERIES

    spark.createDataFrame([(i,) for i in range(1, 401)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(i, 1 + i % 400) for i in range(800)], "event_id long, user_id long").write.parquet(f"{tmp_path}/events.parquet")
    got = {r.target_slug.lower(): r.n for r in QUERIES["target_signals"](spark, str(tmp_path)).collect()}
    assert got == {f"user-{i}": 2 for i in range(1, 401)}


def test_rule_linkage_scores_classes(spark):
    """Copies of rows add a row each, not a pair each; with their classes all pairs of rows and their scores are there."""
    made = [(i, f"Acme {'Air' if i % 2 else 'Sea'}", "acme", f"m{i % 3}@x.example", f"+2782000000{i % 2}", None if i % 5 else "Gauteng") for i in range(120)]
    df = spark.createDataFrame(made, "id long, organization_name string, organization_slug string, contact_primary_email string, contact_primary_phone string, province string").withColumn("website", F.lit(None).cast("string"))
    rows = linkage.with_link_columns(df)
    want = {(r.l, r.r): r.match_probability for r in linkage.rule_scores(rows, linkage.pairs_by(rows, F.col("link_slug"))).collect()}
    _, scored, _ = linkage.link_by_rules(df)
    found = scored.collect()
    assert len(found) == 12 * 11 // 2 + 120 - 12
    of = {r.r: r.l for r in found if r.alike}
    classes = {}
    for i in range(120):
        classes.setdefault(of.get(i, i), []).append(i)
    got = {}
    for r in found:
        inside = itertools.combinations(classes[r.l], 2) if r.alike else itertools.product(classes[r.l], classes[r.r])
        got |= {(min(p), max(p)): r.match_probability for p in inside}
    assert got == want
    assert scored.agg(F.sum(linkage.pairs_stood_for())).first()[0] == len(want)


def test_rule_pairs_are_all_pairs_of_rows(spark, monkeypatch):
    """Whatever is scored once, each pair of rows is there with its own score; the phones' ratio depends on their order."""
    monkeypatch.setattr(linkage, "PIECE", 7)
    phones = ["+27820000001", "+27820000010", None]
    assert similarity._partial(phones[0], "+27820000100") != similarity._partial("+27820000100", phones[0])
    made = [(i * 37 % 121, f"Acme {'Air' if i % 2 else 'Sea'}", f"acme {i % 2}" if i % 9 else None, f"m{i % 3}@x.example", [*phones, "+27820000100"][i * 5 % 4], None if i % 5 else "Gauteng") for i in range(120)]
    df = spark.createDataFrame(made, "id long, organization_name string, organization_slug string, contact_primary_email string, contact_primary_phone string, province string").withColumn("website", F.lit(None).cast("string"))
    rows = linkage.with_link_columns(df)
    want = {(r.l, r.r): r.match_probability for r in linkage.rule_scores(rows, linkage.pairs_by(rows, linkage.block_key())).collect()}
    found = linkage.rule_pairs(df, review=0.6, context=["organization_name"]).collect()
    assert len(found) == len(want) and {(r.l, r.r): r.match_probability for r in found} == want
    name = {x[0]: x[1] for x in made}
    assert all((r.left_organization_name, r.right_organization_name) == (name[r.l], name[r.r]) for r in found)
    kept = linkage.rule_pairs(df, review=0.6, only="review").collect()
    assert sorted((r.l, r.r) for r in kept) == sorted((r.l, r.r) for r in found if r.classification == "review") != []


@pytest.mark.parametrize("name, n", [("rule_linkage", 16 * 15 // 2), ("review_queue", 4 * 4)])
def test_linkage_gives_pairs_of_rows(spark, tmp_path, name, n):
    """Rows 1, 66155, 132309 and 198463 are alike in all that is scored: each pair of them and of others is a row, no class stands for it."""
    import duckdb

    from goldpan.plans.queries import QUERIES
    from goldpan.plans.table_oracle import LINK_SQL
    from tests.oracle import same

    keys = [k + i * 66154 for k in (1, 98, 195, 1068) for i in range(4)]
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert QUERIES[name](spark, str(tmp_path)).count() == n
    same(spark, con, QUERIES[name], LINK_SQL[name], str(tmp_path))


def test_candidate_rows_are_candidate_pairs_without_a_shuffle_of_pairs(spark):
    made = [(i, i % 3 if i % 7 else None, i % 4 if i % 5 else None) for i in range(60)]
    df = spark.createDataFrame(made, "id long, a int, b int")
    found = linkage.candidate_rows(df, [F.col("a"), F.col("b")], ["b"])
    want = {tuple(x) for x in linkage.candidate_pairs(df, [F.col("a"), F.col("b")]).collect()}
    rows = found.collect()
    assert len(rows) == len(want) and {(r.l, r.r) for r in rows} == want and all((r.b_l, r.b_r) == (made[r.l][2], made[r.r][2]) for r in rows)
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString()
