"""The corpus pipeline: each stage against plain Python on its own input."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from goldpan.llm import quality_rules
from goldpan.llm.queries import tokenizer_path
from tests.llm.test_rest import scores, words

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, kept string, row string, r long"


def documents():
    r = random.Random(11)
    vocabulary = [a + b + c for a in ("ba", "do", "ki", "lu", "mé") for b in ("na", "re", "so", "ti") for c in ("", "m", "st", "x")]
    prose = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    out = {i: prose(r.randint(60, 140)) for i in range(260)}
    for i in range(20):  # near copies, copies, and a chain
        w = out[i].split()
        w[len(w) // 2] = "changed"
        out[300 + i] = " ".join(w)
        out[340 + i] = out[i]
        w[3] = "again"
        out[380 + i] = " ".join(w)
    items = {1: " ".join(out[30].split()[5:40]), 2: "Never said, here", 3: None, 4: prose(30)}
    out[500], out[501] = prose(60) + " " + items[4] + " " + prose(20), prose(50) + " never SAID here " + prose(20)
    out |= {600 + i: " ".join(f"&&&{i}{j} ###" for j in range(60)) for i in range(30)}
    out |= {700: None, 701: "", 702: "too short", 703: prose(40) + " one two three" * 40, 704: prose(9000)}
    rows = [(i, t, ("en", "fr", None)[i % 3 if i < 200 else 0], ("s1", "s2", None)[i % 3], 1, "mine", "x", 5) for i, t in out.items()]
    rows += [(7, prose(80), "en", "s1", 2, "mine", "x", 6), (None, prose(90), "en", "s2", 2, "mine", "x", 6), (None, out[40], "en", "s2", 2, "mine", "x", 6), rows[9], rows[9]]
    labels = [(i, 1) for i in range(0, 260)] + [(600 + i, 0) for i in range(15)] + [(None, 0), (3, None)]
    return rows, items, labels


def write(spark, folder, labels, items):
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")


def run(spark, folder, rows, labels, items):
    """What goes into each stage and what comes out of it."""
    write(spark, folder, labels, items)
    docs, seen = spark.createDataFrame(rows, SCHEMA), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        out.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        assert name == "token_records" or after.columns == docs.columns
        seen.append((name, [tuple(x) for x in docs.collect()], [tuple(x) for x in after.collect()]))
        docs = after
    return seen


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    rows, items, labels = documents()
    folder = str(tmp_path_factory.mktemp("corpus"))
    return rows, items, labels, {name: (before, after) for name, before, after in run(spark, folder, rows, labels, items)}


def test_quality_rules(spark, stages):
    rows, _, labels, seen = stages
    before, after = seen["quality_rules"]
    assert Counter(before) == Counter(rows)
    tables = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int")
    cuts = {r.stratum: r for r in quality_rules.cutoffs(quality_rules.scored(tables[0]), tables[1]).collect()}
    want = Counter()
    for row in rows:
        base, own = scores(row[1] or "")
        cut = cuts.get(row[2] or "")
        over = cut and any(cut[f"cut_{n}"] is not None and v > cut[f"cut_{n}"] for n, v in own.items())
        want[row] += not base and not over
    assert Counter(after) == +want
    kept = {r[0] for r in after}
    assert kept >= set(range(260)) | {500, 501, 704, None} and not kept & {700, 701, 702, 703}
    assert cuts["en"].cut_symbol_share is not None and not kept & set(range(600, 630))


def test_near_duplicates(stages):
    before, after = stages[3]["near_duplicates"]
    sets = []
    for row in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), row[1]))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    group = list(range(len(before)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(before)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                group[max(top(i), top(j))] = min(top(i), top(j))
    members = {}
    for i, row in enumerate(before):
        members.setdefault(top(i), []).append(row)
    least = lambda rs: min(float("inf") if r[0] is None else r[0] for r in rs)
    assert len(after) == len(members)
    found = Counter(after)
    for rs in members.values():
        assert sum(found[r] for r in set(rs)) == 1
        assert least([r for r in rs if found[r]]) == least(rs)
    assert not {r[0] for r in after} & (set(range(300, 320)) | set(range(340, 360)) | set(range(380, 400)))


def test_decontamination(stages):
    _, items, _, seen = stages
    before, after = seen["decontamination"]
    windows = set()
    for t in items.values():
        w = words(t or "")
        m = min(10, len(w))
        windows |= {tuple(w[i : i + m]) for i in range(len(w) - m + 1)} if m else set()
    sizes = {len(w) for w in windows}
    dirty = lambda w: any(tuple(w[i : i + m]) in windows for m in sizes for i in range(len(w) - m + 1))
    assert Counter(after) == Counter(r for r in before if not dirty(words(r[1])))
    assert {30, 500, 501} <= {r[0] for r in before} and not {30, 500, 501} & {r[0] for r in after}


def test_mixing(stages):
    before, after = stages[3]["mixing"]
    size = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r[1]))
    sources = ["s1", "s2", None]
    have = {s: sum(size(r) for r in before if r[3] == s) for s in sources}
    target, open_, rest = {}, dict(zip(sources, (3, 1, 2))), 1.5 * sum(have.values())
    while open_:
        share = {s: rest * w / sum(open_.values()) for s, w in open_.items()}
        over = [s for s in open_ if share[s] > 2 * have[s]]
        target |= {s: 2 * have[s] for s in over} if over else share
        rest -= sum(target[s] for s in over)
        open_ = {s: w for s, w in open_.items() if over and s not in over}
    known, taken = Counter(before), Counter(after)
    assert all(taken[r] <= 2 * known[r] for r in taken)
    for s in sources:
        got = sum(size(r) for r in after if r[3] == s)
        assert abs(got - target[s]) <= max(size(r) for r in before if r[3] == s)


def test_token_records(stages):
    from tokenizers import Tokenizer

    before, after = stages[3]["token_records"]
    tokenizer, want = Tokenizer.from_file(tokenizer_path()), Counter()
    for r in before:
        ids = tokenizer.encode(r[1], add_special_tokens=False).ids + [0]
        want[(r[0], len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    assert Counter((i, n, crc) for i, _, n, crc in after) == want
    at = 0
    for i, start, n, _ in sorted(after, key=lambda x: x[1]):
        assert start == at
        at += n
    order = [(i is not None, i or 0) for i, *_ in sorted(after, key=lambda x: x[1])]
    assert order == sorted(order)


def test_empty_tables(spark, tmp_path):
    rows, items, labels = documents()
    seen = run(spark, str(tmp_path / "a"), rows[:30] + rows[-40:], [], {})
    assert len(seen[-1][2]) > 0 and len(seen[2][1]) == len(seen[2][2])
    assert run(spark, str(tmp_path / "b"), [], labels, items)[-1][2] == []
