import random
import re
from collections import defaultdict

import pytest

from goldpan.llm import jaccard_join, line_dedup, substring_dedup, suffix_dedup
from tests.llm.cases import collected, corpus, empty, rows

LAST = 1 << 63


def table(spark, **options):
    return [(r.doc_id, r.text or "") for r in corpus(spark, **options).collect()]


def covered(sequences, length):
    """Per row: which symbols a window covers that a smaller id has too."""
    first = {}
    for i, seq in sequences:
        for a in range(len(seq) - length + 1):
            w = tuple(seq[a : a + length])
            first[w] = min(first.get(w, LAST), LAST - 1 if i is None else i)
    for i, seq in sequences:
        gone = [False] * len(seq)
        for a in range(len(seq) - length + 1):
            if first[tuple(seq[a : a + length])] < (LAST - 1 if i is None else i):
                gone[a : a + length] = [True] * length
        yield i, gone


@pytest.mark.parametrize("spread", [{}, {"chunks": 6}, {"chunks": 5, "together": 0}])
def test_suffixes_are_brute_force(spark, spread):
    data = [(i, t.encode()) for i, t in table(spark)]
    want = []
    for (i, gone), (_, seq) in zip(covered(data, 50), data):
        runs = len(re.findall("1+", "".join("1" if g else "0" for g in gone)))
        want.append((i, len(seq), sum(gone), runs, bytes(b for b, g in zip(seq, gone) if not g)))
    got = suffix_dedup.dedup_strings(corpus(spark), length=50, **spread)
    from pyspark.sql import functions as F

    assert collected(got.withColumn("runs", F.size("spans")), "doc_id", "n_bytes", "n_removed", "runs", "kept") == sorted(want, key=repr)


def test_suffix_arrays_are_small(spark):
    """Anchors are compared a few at a time, and one with long contents by its windows, however much lands in one group."""
    import string

    from goldpan.llm import repeats

    most = repeats._MOST

    def small(symbols, lengths, ord_, length):
        assert len(symbols) <= most
        return suffix_dedup._by_suffixes(symbols, lengths, ord_, length)

    marks = string.ascii_uppercase + string.digits + string.punctuation
    data = [(i, "ab" * (10_000 + 17 * (i * 7 % 60)) + marks[i] * 60) for i in range(60)]
    assert sum(len(t) for _, t in data) > most
    found = repeats.covered(spark.createDataFrame(data, "doc_id long, text string"), length=50, k=32, read=suffix_dedup._read_bytes, dtype="uint8", local=small, chunks=1)
    spans = lambda r: repeats.united([(s.start, s.stop) for s in r.spans])
    assert {r.ord: spans(r) for r in found.collect()} == {i: [(0, len(t) - 60)] for i, t in data if i}


def test_windows_settle_what_suffixes_do():
    import numpy as np

    from goldpan.llm import repeats

    r = random.Random(4)
    for alphabet in ("ab", "a"):
        made = ["".join(r.choice(alphabet) for _ in range(r.randint(8, 40))).encode() for _ in range(60)]
        symbols, lengths = np.frombuffer(b"".join(made), np.uint8), np.array([len(x) for x in made])
        ids = np.array([r.randint(0, 30) for _ in made])
        mask = lambda found: {(o, i) for low, high, o in zip(*map(np.ndarray.tolist, found)) for i in range(low, high)}
        assert mask(repeats._by_windows(symbols, lengths, ids, 8)) == mask(suffix_dedup._by_suffixes(symbols, lengths, ids, 8)) != set()
    prints = np.array([3, 3, 5, 7, 7, 7, 9])
    at = repeats._AT_A_TIME
    assert list(repeats._whole_anchors(prints, np.array([1, 1, at - 2, at, 1, 1, 5]))) == [(0, 3), (3, 6), (6, 7)]


@pytest.mark.parametrize("spread", [{}, {"chunks": 6}, {"chunks": 23}])
def test_windows_are_brute_force(spark, spread):
    data = [(i, t.encode().split()) for i, t in table(spark)]
    want = [(i, len(seq), sum(gone), b" ".join(w for w, g in zip(seq, gone) if not g).decode()) for (i, gone), (_, seq) in zip(covered(data, 50), data)]
    got = substring_dedup.dedup_windows(corpus(spark), length=50, **spread)
    assert collected(got, "doc_id", "n_words", "n_removed", "kept") == sorted(want, key=repr)


def test_suffix_array_and_intervals():
    import numpy as np

    text = np.array([ord(c) for c in "banana"] + [1])
    order, common = suffix_dedup.suffix_array(text)
    assert [int(x) for x in order] == sorted(range(7), key=lambda i: text[i:].tolist())
    assert [int(x) for x in common] == [0, 0, 1, 3, 0, 0, 2]
    left = np.concatenate(([-1], text[:-1]))
    groups = list(suffix_dedup.repeat_groups(order, common, np.arange(7), left, 1))
    found = {("".join(chr(c) for c in text[order[a] : order[a] + d]), b - a + 1) for d, a, b, _ in groups}
    assert found == {("a", 3), ("ana", 2)}  # "na" always follows "a", so it isn't maximal


def test_lines_are_brute_force(spark):
    data = table(spark)
    key = lambda x: re.sub("[A-Z]", lambda m: m[0].lower(), x.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, t in data:
        for x in t.split("\n"):
            held[key(x)].add(i)
    hot = {k: max(v, key=lambda i: -1 if i is None else i) for k, v in held.items() if len(k) >= 40 and len(v) >= 5}
    want = []
    for i, t in data:
        lines = t.split("\n")
        kept = [x for x in lines if key(x) not in hot or hot[key(x)] == i]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert hot and collected(line_dedup.dedup_lines(corpus(spark)), "doc_id", "n_lines", "n_dropped", "kept_text") == sorted(want, key=repr)


def sets(t, n):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


@pytest.mark.parametrize("n, num, chunks", [(3, 90, None), (5, 80, 4), (2, 50, 3)])
def test_links_are_brute_force(spark, n, num, chunks):
    data = [(LAST - 1 if i is None else i, sets(t, n)) for i, t in table(spark)]
    parent = {i: i for i, _ in data}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(data):
        for j, b in data[:x]:
            if a and b and 100 * len(a & b) >= num * len(a | b):
                i_, j_ = sorted((find(i), find(j)))
                parent[j_] = i_
    real = lambda i: None if i == LAST - 1 else i
    component = {}
    for i, s in data:
        component.setdefault((i, len(s)), set()).add(find(i))
    got = jaccard_join.link_documents(corpus(spark), n=n, num=num, den=100, chunks=chunks).collect()
    assert len(got) == len(data)
    twice = {9}  # an id with two texts: its rows are documents of their own
    for r in got:
        i = LAST - 1 if r.doc_id is None else r.doc_id
        if i not in twice:
            assert r.component_id in {real(c) for c in component[(i, r.n_shingles)]}


def test_near_copies_of_one_hub_are_brute_force(spark):
    """Variants that are too far from the first one, some of them close to each other."""
    import random

    r = random.Random(8)
    base = [f"w{r.randint(0, 400)}" for _ in range(90)]
    texts = [" ".join(base)]
    for i in range(90):
        words = list(base if i % 3 else texts[r.randrange(len(texts))].split())
        for _ in range(r.randint(1, 7)):
            words[r.randrange(len(words))] = f"x{r.randint(0, 60)}"
        if i % 5 == 0:
            words += [f"y{i}", f"z{i % 2}"]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for num in (85, 92):
        own = [sets(t, 3) for t in texts]
        label = list(range(len(texts)))
        for _ in range(len(texts)):
            for i in range(len(texts)):
                for j in range(i):
                    if 100 * len(own[i] & own[j]) >= num * len(own[i] | own[j]):
                        label[i] = label[j] = min(label[i], label[j])
        assert 1 < len(set(label)) < len(texts)
        got = jaccard_join.link_documents(docs, n=3, num=num, den=100, chunks=3)
        assert {x.doc_id: x.component_id for x in got.collect()} == dict(enumerate(label))


@pytest.mark.parametrize("few", [1, 3, 20])
def test_families_that_share_a_passage_are_linked_within_only(spark, monkeypatch, few):
    """Sets far from the first set of their signature, alone and in crowds."""
    monkeypatch.setattr(jaccard_join, "FEW", few)
    r = random.Random(few)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = [passage + " " + " ".join(f"first{i}" for i in range(30))]
    for f in range(7):
        base = [f"f{f}w{i}" for i in range(r.choice((30, 60, 90)))]
        for i in range(r.choice((2, 9, 16))):
            words = list(base)
            for _ in range(r.randint(0, 5)):
                words[r.randrange(len(words))] = f"x{r.randint(0, 25)}"
            texts.append(passage + " " + " ".join(words))
    texts = list(dict.fromkeys(texts))
    own = [sets(t, 3) for t in texts]
    label = list(range(len(texts)))
    for _ in range(8):
        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j]):
                    label[i] = label[j] = min(label[i], label[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x.component_id for x in jaccard_join.link_documents(docs, n=3, num=80, den=100, chunks=2).collect()}
    assert got == dict(enumerate(label)) and 8 <= len(set(label)) < len(texts)


def linked_and_written(spark, monkeypatch, texts, n, module=jaccard_join):
    """Component of each text, and the rows of each scratch table by its name."""
    rows, write = {}, jaccard_join.written

    def counted(df, name):
        out = write(df, name)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(jaccard_join, "written", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {x.doc_id: x.component_id for x in module.link_documents(docs, n=n, num=80, den=100, chunks=2).collect()}, rows


def test_sets_with_too_much_of_their_own_are_not_compared_within_a_hub(spark, monkeypatch):
    """Half of each text is a passage that all share, the rest its own; two of the texts are near copies."""
    passage = " ".join(f"p{i}" for i in range(60))
    texts = [f"{passage} " + " ".join(f"t{t}w{i}" for i in range(60)) for t in range(40)]
    texts.append(texts[20].replace("t20w30", "changed"))
    got, rows = linked_and_written(spark, monkeypatch, texts, 3)
    assert got == {i: 20 if i == 40 else i for i in range(41)}
    assert rows["hub-pairs"] > 30 and rows["hub-differences"] <= 2


def test_near_copies_are_not_listed_for_each_of_their_keys(spark, monkeypatch):
    """Copies with an edit each share hundreds of keys with each other and some with outsiders."""
    from goldpan.llm import minhash

    r = random.Random(6)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(base)]
    for i in range(60):
        words = list(base)
        for _ in range(1 if i < 50 else 14):
            words[r.randrange(200)] = f"x{i}y{r.randrange(9)}"
        texts.append(" ".join(words))
    own = [sets(t, 4) for t in texts]
    label = list(range(len(texts)))
    for _ in range(8):
        for i in range(len(texts)):
            for j in range(i):
                if 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j]):
                    label[i] = label[j] = min(label[i], label[j])
    got, rows = linked_and_written(spark, monkeypatch, texts, 4, minhash)
    assert got == dict(enumerate(label)) and len(set(label)) > 3
    assert max(c for name, c in rows.items() if name not in ("shared-adds", "rare-adds", "rare-differences")) < 64 * len(texts)


def test_bands_never_lose_a_link():
    import numpy as np

    r = np.random.Generator(np.random.PCG64(1))
    bands = jaccard_join.Bands(80, 100, 400)
    for _ in range(400):
        a = np.unique(r.integers(0, 2**63, r.integers(6, 120)).astype(np.uint64))
        b = a.copy()
        while True:
            c = np.unique(np.concatenate((b[r.random(len(b)) > 0.02], r.integers(0, 2**63, 1).astype(np.uint64))))
            both = len(np.intersect1d(a, c))
            if 100 * both < 80 * (len(a) + len(c) - both):
                break
            b = c
        shared = set()
        for s in (a, b):
            found, _ = jaccard_join.signatures(s, np.array([len(s)]), bands, 0)
            shared = set(found.tolist()) if not shared else shared & set(found.tolist())
        assert shared or np.array_equal(a, b)


def test_one_of_each_group_stays(spark):
    kept = jaccard_join.keep_one(corpus(spark), n=5, num=80, den=100)
    assert kept.columns == corpus(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(5) == 1 and 6 in ids and 7 not in ids and 8 not in ids and 5000 in ids


def test_rows_with_one_id_are_documents_of_their_own(spark):
    """Null ids and an id with several texts: links of one text say nothing of the others, and near copies among them are found."""
    text = lambda name, *changed: " ".join("changed" if i in changed else f"{name}{i}" for i in range(80))
    data = [(5, text("a")), (None, text("a", 79)), (None, text("b")), (None, text("c")), (None, text("c", 79)), (7, text("d")), (7, text("a", 0)), (7, text("e")), (7, text("e", 79)), (None, ""), (9, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    name = {spark.createDataFrame([(t,)], "text string").selectExpr("xxhash64(text)").first()[0]: t for _, t in data}
    for chunks in (1, 4):
        got = {(r.doc_id, name[r.text_hash]): r.component_id for r in jaccard_join.link_documents(docs, n=5, num=80, den=100, chunks=chunks).collect()}
        assert got == {(i, t): 5 if t in (text("a"), text("a", 79), text("a", 0)) else i for i, t in data}
        kept = {(r.doc_id, r.text) for r in jaccard_join.keep_one(docs, n=5, num=80, den=100, chunks=chunks).collect()}
        assert len(kept) == 7 and kept - {(None, text("c")), (None, text("c", 79)), (7, text("e")), (7, text("e", 79))} == {(5, text("a")), (None, text("b")), (7, text("d")), (None, ""), (9, "")}
        assert sum(t[:1] == "c" for _, t in kept) == 1


def test_empty_tables(spark):
    none = empty(spark)
    assert suffix_dedup.dedup_strings(none).count() == 0
    assert substring_dedup.dedup_windows(none).count() == 0
    assert line_dedup.dedup_lines(none).count() == 0
    assert jaccard_join.link_documents(none).count() == 0
    assert len(rows()) == 61
