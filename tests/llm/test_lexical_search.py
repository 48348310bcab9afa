import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from goldpan.llm import lexical_search as ls
from tests.llm.cases import corpus, empty

LAST = (1 << 63) - 1


def terms(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in counted:
            m = 10 + 90 * sum(c.values()) * n_docs // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                scores.append((-score, LAST if i is None else i))
        out += [(item, rank, None if i == LAST else i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def asked(spark):
    texts = [r.text for r in corpus(spark).filter("doc_id in (1, 12, 30)").orderBy("doc_id").collect()]
    rows = [(1, texts[0]), (2, "alpha1 BETA2 délta3 alpha1"), (3, None), (4, ""), (5, "!! --"), (6, "neverseen"), (None, "gamma7 Kappa9"), (2, "zêta4 line"), (8, texts[2])]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("options", [{}, {"shards": 1}, {"shards": 7, "k": 3}, {"shards": 3, "k": 200}])
def test_search_is_brute_force(spark, asked, options):
    docs = [(r.doc_id, r.text) for r in corpus(spark).collect()]
    items = [(r.item_id, r.text) for r in asked.collect()]
    assert got(ls.search(corpus(spark), asked, **options)) == brute(docs, items, options.get("k", 10))


def test_items_are_searched_in_passes(spark, asked, monkeypatch):
    whole = got(ls.search(corpus(spark), asked))
    monkeypatch.setattr(ls, "PASS_ITEMS", 2)
    assert got(ls.search(corpus(spark), asked)) == whole


def test_bounds_of_any_lists():
    """Ties at the last place, lists that end, and more asked for than there is."""
    r = random.Random(4)
    for _ in range(300):
        size, k = r.randint(1, 120), r.randint(1, 12)
        lists = []
        for _ in range(r.randint(0, 6)):
            docs = r.sample(range(size), r.randint(0, size))
            impacts = sorted((r.choice((0, 1, 2, 5, 9, 40)) for _ in docs), reverse=True)
            lists.append((np.array(docs, np.int64), np.array(impacts, np.int64)))
        total = np.zeros(size, np.int64)
        for d, i in lists:
            total[d] += i
        want = [(d, s) for s, d in sorted((-s, d) for d, s in enumerate(total.tolist()) if s > 0)[:k]]
        ls.FIRST_READ, before = r.choice((1, 2, 8)), ls.FIRST_READ
        places, scores = ls.first_by_score(lists, size, k)
        ls.FIRST_READ = before
        assert [(d, -s) for d, s in zip(places.tolist(), scores.tolist())] == want


def test_reading_ends_early():
    """Whole scores of the first are known before the long list is read to its end."""
    n = 200_000
    falling = np.arange(n, 0, -1)
    lists = [(np.arange(n), falling * 10)]

    class Counted:
        def __init__(self, x):
            self.x, self.read = x, 0

        def __len__(self):
            return len(self.x)

        def __getitem__(self, at):
            out = self.x[at]
            self.read += len(out) if isinstance(at, slice) else 0
            return out

    docs = Counted(lists[0][0])
    places, _ = ls.first_by_score([(docs, lists[0][1])], n, 10)
    assert places.tolist() == list(range(10)) and docs.read < 1000


def test_long_texts_hot_terms_and_large_counts(spark):
    docs = [(i, "common " * (1 + i % 3) + f"rare{i % 50}") for i in range(400)] + [(1000, "common " * 60_000), (1001, "x" * 300_000 + " common")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    items = [(1, "common rare7"), (2, "common"), (3, "x" * 300_000)]
    assert got(ls.search(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_empty_tables(spark, asked):
    none = empty(spark)
    assert ls.search(none, asked).count() == 0
    assert ls.search(corpus(spark), asked.limit(0)).count() == 0
    assert ls.search(none, asked.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
