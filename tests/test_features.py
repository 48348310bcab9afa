"""Linkage weights, one-to-one history, fuzzy classes, streams over several batches, redaction by spans, samples, boxes, totals."""

import itertools
import json
import random
import re

import pytest
from pyspark.sql import functions as F

from goldpan.functions import similarity
from goldpan.functions import table as tables
from goldpan.operators import dedup, geo, intent, linkage, mapping, privacy, quality, stats
from goldpan.streaming import intent as streams


def greedy(rows, past):
    """Rows in order take the lowest entity that shares a key and is free."""
    taken, out = set(), {}
    for pos, keys in sorted(rows):
        found = sorted(e for e, k in past if e not in taken and set(k) & set(keys))
        if found:
            out[pos] = found[0]
            taken.add(found[0])
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_history_is_greedy(spark, seed):
    r = random.Random(seed)
    some = lambda: r.sample("abcdef", r.randint(0, 3))
    rows, past = [(i, some()) for i in range(14)], [(100 + i, some()) for i in range(10)]
    got = linkage.match_history(spark.createDataFrame(rows, "pos long, keys array<string>"), spark.createDataFrame(past, "entity_id long, keys array<string>"))
    assert {x.pos: x.entity_id for x in got.collect()} == greedy(rows, past)


def test_namesakes_take_one_round(spark, monkeypatch):
    """Any number of rows with one key, also beside rows with one key more, is settled without a second round."""
    made = []
    plain = linkage.written
    monkeypatch.setattr(linkage, "written", lambda df, name: (made.append(name), plain(df, name))[1])
    rows = spark.range(20_000).select(F.col("id").alias("pos"), F.array(F.lit("same")).alias("keys"))
    past = spark.range(15_000).select((F.col("id") + 7).alias("entity_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit("same"), F.lit("more"))).otherwise(F.array(F.lit("same"))).alias("keys"))
    got = linkage.match_history(rows, past)
    assert got.agg(F.count("*"), F.min(F.col("entity_id") - F.col("pos")), F.max(F.col("entity_id") - F.col("pos"))).first() == (15_000, 7, 7)
    assert len(made) <= 6


def test_history_of_nothing(spark):
    rows, past = spark.createDataFrame([(1, ["a"]), (2, [])], "pos long, keys array<string>"), spark.createDataFrame([], "entity_id long, keys array<string>")
    assert linkage.match_history(rows, past).count() == 0
    assert linkage.match_history(rows.limit(0), past).count() == 0


@pytest.mark.parametrize("threshold", [0.8, 0.9, 0.96])
def test_fuzzy_classes_are_brute_force(spark, threshold):
    r = random.Random(5)
    base = ["".join(r.choice("abcdeé 0") for _ in range(r.randint(1, 40))) for _ in range(25)]
    texts = []
    for b in base:
        for _ in range(6):
            x = list(b)
            for _ in range(r.randint(0, 3)):
                at = r.randrange(len(x) + 1)
                x[at : at + r.randint(0, 1)] = r.choice(["", "a", "z", " "])
            texts.append("".join(x))
    texts += ["", "   ", None, texts[0], " ".join(reversed(texts[0].split()))]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, name string")
    members, pairs = linkage.fuzzy_classes(df, "name", threshold=threshold)
    key = lambda t: " ".join(sorted(t.split()))
    classes = {}
    for i, t in enumerate(texts):
        if t and t.strip():
            classes.setdefault(key(t), []).append(i)
    assert {(x.id, x["class"]) for x in members.collect()} == {(i, min(ids)) for ids in classes.values() for i in ids}
    want = {tuple(sorted((min(classes[a]), min(classes[b])))) for a, b in itertools.combinations(classes, 2) if similarity.indel(a, b) >= threshold}
    assert {(x.x, x.y) for x in pairs.collect()} == want and want
    rows = {(x.l, x.r) for x in linkage.fuzzy_pairs(df, "name", threshold=threshold).collect()}
    near = {(a, b) for a, b in itertools.combinations(classes, 2) if similarity.indel(a, b) >= threshold}
    assert rows == {tuple(sorted(p)) for a, b in near for p in itertools.product(classes[a], classes[b])} | {p for ids in classes.values() for p in itertools.combinations(ids, 2)}


def test_random_pairs(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    pairs = {(r.l, r.r) for r in linkage.random_pairs(df, "k", seeds=3).collect()}
    assert 5900 < len(pairs) <= 6000 and all(a < b for a, b in pairs)
    assert pairs == {(r.l, r.r) for r in linkage.random_pairs(df.repartition(7), "k", seeds=3).collect()}
    count = dict.fromkeys(range(2000), 0)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
    assert max(count.values()) <= 6  # twice a seed
    assert abs(sum(b - a for a, b in pairs) / len(pairs) - 2000 / 3) < 30
    assert linkage.random_pairs(df.limit(1), "k").count() == 0


def test_weights_are_found_again(spark):
    """Vectors drawn from known m and u: expectation maximisation comes back to m and the share of matches."""
    r = random.Random(6)
    u = {"link_name": [0.02, 0.03, 0.05, 0.9], "link_email": [0.01, 0.99], "link_phone": [0.1, 0.1, 0.8], "link_province": [0.3, 0.7], "link_website": [0.05, 0.95]}
    m = {"link_name": [0.7, 0.2, 0.05, 0.05], "link_email": [0.9, 0.1], "link_phone": [0.6, 0.2, 0.2], "link_province": [0.8, 0.2], "link_website": [0.85, 0.15]}
    rows = []
    for i in range(40_000):
        p = m if i % 5 == 0 else u
        rows.append(tuple(-1 if r.random() < 0.05 else r.choices(range(len(p[f])), p[f])[0] for f in linkage.LEVELS) + (1,))
    schema = ", ".join(f"gamma_{f} int" for f in linkage.LEVELS) + ", n long"
    counts = linkage.gamma_counts(spark.createDataFrame(rows, schema).drop("n"))
    found, share = linkage.estimate_m(counts, u, rounds=60)
    assert abs(share - 0.2) < 0.02
    for f in m:
        assert found[f] == pytest.approx(m[f], abs=0.03)
    vectors = spark.createDataFrame([(i, i + 1, *x[:-1]) for i, x in enumerate(rows[:5])], "l long, r long, " + schema.rpartition(",")[0])
    given, own = linkage.match_probabilities(vectors, u, m=found), linkage.match_probabilities(vectors, u)
    assert given.first().match_weight != own.first().match_weight
    assert linkage.estimate_m(counts.limit(0), u) == ({f: [level[-1] for level in levels] for f, levels in linkage.LEVELS.items()}, 0.5)


def files(spark, folder, batches, schema):
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)


def at(day, hour=0):
    from datetime import datetime

    return datetime(2024, 1, day, hour)


def test_store_rewrites_touched_parts_only(spark, tmp_path):
    """Last wins across batches; a batch leaves the parts that it has no key of as they are; a batch that runs again changes nothing."""
    batches = [[(i, "old", i) for i in range(40)], [(3, "new", 100), (3, "newer", 101)], [(50, "late", 102)]]
    stream = files(spark, str(tmp_path / "in"), batches, "k long, v string, seq long")
    store = str(tmp_path / "store")
    streams.upsert_stream(stream, store, str(tmp_path / "c"), ["k"], "seq", parts=16)
    want = {i: "old" for i in range(40)} | {3: "newer", 50: "late"}
    assert {r.k: r.v for r in streams.read_store(spark, store, stream.schema).collect()} == want
    versions = {p.parent.name: {x.name for x in p.parent.iterdir() if x.name.startswith(streams.VERSION)} for p in (tmp_path / "store").glob(f"{streams.PART}=*/{streams.VERSION}=*")}
    assert len(versions) > 8 and sum(v == {f"{streams.VERSION}=0"} for v in versions.values()) >= len(versions) - 2
    # The last batch once more, as after a failure before its commit.
    commit = max((tmp_path / "c" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commit.unlink()
    (commit.parent / f".{commit.name}.crc").unlink(missing_ok=True)
    streams.upsert_stream(stream, store, str(tmp_path / "c"), ["k"], "seq", parts=16)
    assert {r.k: r.v for r in streams.read_store(spark, store, stream.schema).collect()} == want
    assert streams.read_store(spark, str(tmp_path / "none"), stream.schema).count() == 0


def test_late_rows_are_kept_aside(spark, tmp_path):
    batches = [[(1, at(1)), (2, at(5))], [(3, at(4, 1)), (4, at(3)), (5, at(9)), (6, None)], [(7, at(7)), (8, at(8)), (9, at(20))]]
    stream = files(spark, str(tmp_path / "in"), batches, "k long, observed_at timestamp")
    where = [str(tmp_path / x) for x in ("on", "late", "most")]
    streams.split_late(stream, *where, str(tmp_path / "c"), watermark="1 day")
    read = lambda p: sorted(r.k for r in spark.read.schema(stream.schema).parquet(p).collect())
    assert read(where[0]) == [1, 2, 3, 5, 6, 8, 9] and read(where[1]) == [4, 7]


def test_dedup_state_lives_across_batches(spark, tmp_path):
    batches = [[(1, at(1)), (1, at(1)), (2, at(2))], [(1, at(1)), (3, at(10))], [(5, at(11))], [(2, at(2)), (4, at(2)), (3, at(10))]]
    stream = files(spark, str(tmp_path / "in"), batches, "k long, observed_at timestamp")
    out = stream.withWatermark("observed_at", "3 days").dropDuplicates(["k", "observed_at"])
    query = streams.run_to_table(out, str(tmp_path / "out"), str(tmp_path / "c"))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3, 5]  # 4 is new, but behind the watermark
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 2  # what the watermark has passed is forgotten


def test_overlapping_hits(spark):
    spans = privacy.found_spans
    assert [(k, a, b) for k, a, b, _ in spans("4111 1111 1111 1111")] == [("CREDIT_CARD", 0, 19)]
    both = "https://a.b/jane@x.org/c"
    assert [(k, both[a:b]) for k, a, b, _ in spans(both)] == [("EMAIL_ADDRESS", "jane@x.org")]  # the surer one of two that overlap
    assert spans("no 4111 1111 1111 1112 here") == [] and spans("") == []
    assert spans("+27 82 123 4567", least=0.5) == []
    long = "x " * 100_000 + "a@b.co " * 2000
    assert len(spans(long)) == 2000
    df = spark.createDataFrame([(1, ["a@b.co c", None, "é 10.0.0.1"], "+27 82 123 4567"), (1, [], None), (2, None, "")], "k int, l array<string>, t string")
    rows, events = privacy.redact(df, ["l", "t"], "k", "mask")
    assert sorted(map(tuple, rows.collect()), key=repr) == sorted([(1, ["****** c", None, "é ********"], "*" * 15), (1, [], None), (2, None, "")], key=repr)
    assert sorted((r.k, r.column_name, r.value_index, r.type, r.start, r.stop) for r in events.filter("value_index is not null").collect()) == [(1, "l", 0, "EMAIL_ADDRESS", 0, 6), (1, "l", 2, "IP_ADDRESS", 2, 10)]
    assert [r.text for r in df.select(privacy.span_redactor("hash")(F.col("t")).alias("x")).select("x.text").collect()][1:] == [None, ""]


def test_spans_agree_with_patterns_one_by_one(spark):
    """Where hits don't overlap, one rewrite gives what replacing kind by kind does."""
    r = random.Random(7)
    parts = ["jane@x.org", "https://a.b/c?d=e", "GB82WEST12345698765432", "4111 1111 1111 1111", "4111 1111 1111 1112", "8001015009087", "10.20.30.40", "+27 82 123 4567", "plain", "1234", "é"]
    texts = [" , ".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, t string")
    for operation in ("replace", "redact", "hash", "mask"):
        got = df.select("k", privacy.span_redactor(operation)(F.col("t"))["text"].alias("a"), privacy.anonymise(F.col("t"), operation).alias("b")).collect()
        if operation != "hash":  # a hash may look like a number to the patterns that follow
            assert all(x.a == x.b for x in got)


def test_first_filled_values_wherever_they_are(spark):
    rows = [(i, f"a{i}@b.co" if i >= 150 else None, None if i % 2 else str(i), None) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, mail string, n string, none string").repartition(7)
    kinds = {r.column_name: r.semantic_type for r in mapping.semantic_types(df, position="i").collect()}
    assert kinds == {"mail": "email", "n": "numeric", "none": "empty"}
    first = mapping.filled_samples(df, "i", 100).filter("column_name = 'mail'").orderBy("at").collect()
    assert [r.value for r in first] == [f"a{i}@b.co" for i in range(150, 250)]
    profile = {r.column_name: r for r in mapping.full_profile(df, "i").collect()}
    assert profile["n"].samples == ["0", "2", "4"] and profile["none"].samples == [] and profile["mail"].n_missing == 150
    assert {r.semantic_type for r in mapping.semantic_types(df.limit(0), position="i").collect()} == {"empty"}


def test_checkpoint_shows_the_first_bad_values(spark, tmp_path):
    path = tmp_path / "suite.json"
    path.write_text(json.dumps({"expectations": [{"type": "expect_column_values_to_be_between", "kwargs": {"column": "v", "min_value": 0, "max_value": 9, "mostly": 0.1}}, {"type": "expect_column_values_to_be_in_set", "kwargs": {"column": "s", "value_set": ["a"]}}, {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "s"}}]}))
    df = spark.createDataFrame([(i, i, "a" if i % 2 else None if i % 4 else f"b{i}") for i in range(30)], "i int, v int, s string").repartition(5)
    got = {r.expectation: r for r in quality.checkpoint(df, quality.suite_from_file(spark, str(path)), "i").collect()}
    assert got["v between"].success and got["v between"].unexpected == []  # a rule that holds mostly shows nothing
    assert got["s in_set"].unexpected == ["b0", "b4", "b8"] and got["s in_set"].n_bad == 8
    assert got["s not_null"].unexpected == [None, None, None]


def test_smallest_box(spark):
    r = random.Random(8)
    boxes = []
    for i in range(60):
        south, west = r.uniform(-90, 85), r.uniform(-180, 180)
        north, east = min(90.0, south + r.choice((0.1, 3, 40))), west + r.choice((0.1, 5, 120))
        boxes.append((f"b{i}", south, north, west, east - 360 if east > 180 else east))
    boxes += [("world", -90.0, 90.0, -180.0, 180.0), ("twin b", 10.0, 11.0, 20.0, 21.0), ("twin a", 10.0, 11.0, 20.0, 21.0), ("date line", -5.0, 5.0, 179.5, -179.5)]
    points = [(i, r.uniform(-90, 90), r.uniform(-180, 180)) for i in range(300)] + [(900, 10.0, 20.0), (901, 0.0, 180.0), (902, 0.0, -180.0), (903, None, 1.0), (904, 95.0, 0.0)]

    def inside(p, b):
        _, y, x = p
        name, s, n, w, e = b
        return s <= y <= n and (w <= x <= e if w <= e else x >= w or x <= e)

    size = lambda b: ((b[4] - b[3] if b[3] <= b[4] else b[4] - b[3] + 360) * (b[2] - b[1]), b[0])
    want = {}
    for p in points:
        found = [b for b in boxes if p[1] is not None and -90 <= p[1] <= 90 and inside(p, b)]
        want[p[0]] = min(found, key=size)[0] if found else None
    for degrees in (0.5, 7.0):
        got = geo.province_by_box(spark.createDataFrame(points, "id long, latitude double, longitude double"), spark.createDataFrame(boxes, "name string, south double, north double, west double, east double"), degrees=degrees)
        assert {x.id: x.box for x in got.collect()} == want


def test_totals_tell_null_from_sum(spark):
    rows = [("a", "x", None, 0.5), ("a", None, "on", 1.0), (None, "x", "on", 0.0)]
    out = stats.provenance_totals(spark.createDataFrame(rows, "source string, strategy string, network_status string, confidence double")).collect()
    assert [(r.n, r.mean_confidence) for r in out if r.level == "total"] == [(3, 0.5)]
    assert {(r.source, r.n) for r in out if r.level == "source"} == {("a", 2), (None, 1)} and sum(r.level == "detail" for r in out) == 3
    runs = stats.run_totals(spark.createDataFrame([("k", True, 1, 2), (None, False, 3, 4)], "kind string, success boolean, seconds long, records long"), "kind").collect()
    assert {(r.kind, r.is_total, r.runs, r.records) for r in runs} == {("k", False, 1, 2), (None, False, 1, 4), (None, True, 2, 6)}


def test_contacts_in_a_lateral_join(spark):
    tables.register(spark)
    cells = spark.createDataFrame([(1, "Ann <a@x.y>; ;Bob"), (2, None), (3, " <c@x.y> ")], "k int, cell string")
    got = spark.sql("SELECT c.k, p.* FROM {c} c, LATERAL contacts_of(c.cell) p", c=cells).collect()
    assert {tuple(r) for r in got} == {(1, 0, "Ann", "a@x.y"), (1, 2, "Bob", None), (3, 0, None, "c@x.y")}


def test_consent_stops_the_write(spark, tmp_path):
    good = spark.createDataFrame([(1, "a@b.c", "Granted"), (2, None, "denied"), (3, " ", None)], "k int, contact_primary_email string, consent_status string")
    privacy.with_consent(good, key="k").write.parquet(str(tmp_path / "good"))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3
    for status in ("denied", None, "maybe", "pending"):
        bad = good.unionByName(spark.createDataFrame([(9, "x@y.z", status)], good.schema))
        with pytest.raises(Exception, match=r"consent of 9 is (denied|missing|unknown|pending)"):
            privacy.with_consent(bad, key="k").write.mode("overwrite").parquet(str(tmp_path / "bad"))
    assert not list(tmp_path.glob("bad/*.parquet"))


@pytest.mark.parametrize("parts", [1, 7])
def test_places_within_parts(spark, parts):
    r = random.Random(9)
    rows = [(r.choice("aaab"), r.randint(0, 5), i) for i in range(500)]
    got = dedup.ranked_within(spark.createDataFrame(rows, "p string, v int, i int").repartition(parts), "p", F.col("v").desc(), F.col("i").asc(), name="at")
    want = {}
    for p in "ab":
        own = sorted((x for x in rows if x[0] == p), key=lambda x: (-x[1], x[2]))
        want |= {x[2]: (at, len(own)) for at, x in enumerate(own)}
    assert {x.i: (x.at, x.n) for x in got.collect()} == want


def test_digest_of_weights_and_silent_targets(spark):
    found = spark.createDataFrame([("a", "news", 0.2, 1.0, at(1), "x", 1), ("a", "tech", 0.8, 3.0, at(2), None, 2)], "target_slug string, signal_type string, score double, weight double, observed_at timestamp, insight string, seq long")
    out = {r.target_slug: r for r in intent.digest(found, spark.createDataFrame([("a",), ("b",)], "target_slug string")).collect()}
    import math

    assert out["a"].score == pytest.approx(1 / (1 + math.exp(-12 * (0.65 - 0.5)))) and out["b"].score == 0 and out["b"].signal_count == 0 and out["b"].top_insights is None
    assert re.fullmatch("news|tech", out["a"].signal_types[0])


def test_sliding_scores_are_rounded_from_exact_sums(spark, tmp_path):
    """Sums with a 5 in the fifth digit, which sums of doubles round as the order of rows has it."""
    from goldpan.plans.queries import QUERIES

    rows = [(7 * i + 1, i % 60, "view", f"2024-01-{1 + i % 2:02d} 00:00:{i % 60:02d}", 0.072 + i % 97 / 1000) for i in range(1, 2002)]
    rows = [x for x in rows if x[0] % 5] + [(7 * 5000 + 3, 1, "view", "2024-01-25 00:00:00", 1.0)]  # neither late ones nor repeats
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, at string, value double").select("event_id", "user_id", "event_type", F.col("at").cast("timestamp_ntz").alias("ts"), "value").write.parquet(f"{tmp_path}/events.parquet")
    want = sum(round(x[4] * 1000) for x in rows[:-1])
    assert want % 10 == 5
    got = {r.day: (r.n, r.score) for r in QUERIES["stream_sliding"](spark, str(tmp_path)).collect()}
    assert got["2023-12-31"] == (len(rows) - 1, (want + 5) // 10 / 10000)


def test_sliding_windows_at_their_borders(spark, tmp_path):
    """Fractions of a second before a window, and one target with all rows, whose sums of doubles depend on their order."""
    import duckdb

    from goldpan.plans.feature_oracle import FEATURE_SQL
    from goldpan.plans.queries import QUERIES
    from tests.oracle import same

    times = [f"2024-01-{1 + i % 30:02d} {('23:59:59.700000', '23:59:59.200000', '23:59:59.500000', '23:59:58.500000', '12:00:00.000001')[i // 30 % 5]}" for i in range(20_000)]
    rows = [(i, 1, "view", at, 0.001 * (i * 7919 % 99_991)) for i, at in enumerate(times)]
    made = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, at string, value double")
    made.select("event_id", "user_id", "event_type", F.col("at").cast("timestamp_ntz").alias("ts"), "value").write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    same(spark, con, QUERIES["stream_sliding"], FEATURE_SQL["stream_sliding"], str(tmp_path))


@pytest.mark.parametrize("threshold", [0.92, 0.8])
def test_partial_classes_are_brute_force_and_meet_no_others(spark, threshold):
    """Few characters and one beginning for all, some strings twice; short ones meet in what is left of them, longer ones in parts."""
    r = random.Random(5)
    made = ["+27" + "".join(r.choice("01") for _ in range(r.choice((3, 6, 7, 7, 9)))) for _ in range(120)] + ["".join(r.choice("ab") for _ in range(n)) for n in (30, 30, 31, 34, 60)]
    made += [s[:-2] + "x" for s in made[-5:]]
    members, pairs = linkage.partial_classes(spark.createDataFrame(list(enumerate(made)), "id long, s string"), "s", threshold=threshold)
    of = {x.id: x["class"] for x in members.collect()}
    assert of == {i: made.index(s) for i, s in enumerate(made)}
    short_first = lambda i, j: (made[i], made[j]) if (len(made[i]), made[i]) < (len(made[j]), made[j]) else (made[j], made[i])
    want = [(i, j) for i, j in itertools.combinations(sorted(set(of.values())), 2) if similarity._partial(*short_first(i, j)) >= threshold]
    assert sorted(tuple(x) for x in pairs.collect()) == want
    assert linkage._shared_rests(10, 0.92) == [(10, 0, 0), (9, 1, 0)] and linkage._shared_rests(60, 0.92) is None


def test_fuzzy_phones_counts_pairs_of_rows(spark, tmp_path):
    """Each number three times, and one similar to it: all pairs of rows are counted, no string stands for its rows."""
    import duckdb

    from goldpan.plans.queries import QUERIES
    from goldpan.plans.table_oracle import LINK_SQL
    from tests.oracle import same

    # Keys that differ by three times the modulus have one string; the third of them, longer by " x", holds that of the first two.
    keys = [k + i * 3 * 1_000_003 for k in (1, 2, 1 + 1_000_003 * 2) for i in range(3)]
    assert sorted(k % 3 for k in keys) == [0] * 3 + [1] * 3 + [2] * 3
    spark.createDataFrame([(k,) for k in keys], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert QUERIES["fuzzy_phones"](spark, str(tmp_path)).first()["n_pairs"] == 3 * 3 + 3 * 3
    same(spark, con, QUERIES["fuzzy_phones"], LINK_SQL["fuzzy_phones"], str(tmp_path))


def test_filled_samples_sort_no_table(spark):
    """The first filled values of each column come from heaps of the tasks; what is sorted is what they leave."""
    made = [(i * 7919 % 1009, None if i % 3 else f"a{i}", i if i > 900 else None) for i in range(1009)]
    found = mapping.filled_samples(spark.createDataFrame(made, "i long, a string, b int").repartition(7), "i", 20)
    for c, at in (("a", 1), ("b", 2)):
        want = [str(x[at]) for x in sorted(made) if x[at] is not None][:20]
        assert [r.value for r in sorted(found.filter(F.col("column_name") == c).collect(), key=lambda r: r["at"])] == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("TakeOrderedAndProject") == 2 and "Generate" not in plan
