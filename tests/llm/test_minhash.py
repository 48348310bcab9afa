import random
import re

import numpy as np
import pytest

from goldpan.llm import minhash
from goldpan.llm.rolling import U
from tests.llm.cases import corpus, empty

LAST = 1 << 63


def sets(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def labels(ids, own, num):
    """Smallest id that links reach, by position."""
    label = list(range(len(ids)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if own[i] and 100 * len(own[i] & own[j]) >= num * len(own[i] | own[j]):
                a, b = find(i), find(j)
                label[a] = label[b] = a if ids[a] <= ids[b] else b
    return [ids[find(i)] for i in range(len(ids))]


@pytest.mark.parametrize("chunks", [1, 5])
@pytest.mark.parametrize("n, num", [(4, 80), (2, 90)])
def test_components_are_brute_force(spark, chunks, n, num):
    data = [(LAST - 1 if r.doc_id is None else r.doc_id, r.text) for r in corpus(spark).collect()]
    got = minhash.link_documents(corpus(spark), n=n, num=num, den=100, chunks=chunks).collect()
    own = [sets(t, n) for _, t in data]
    want = labels([i for i, _ in data], own, num)
    real = lambda i: None if i == LAST - 1 else i
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got) == sorted((str(real(i)), len(s), str(real(c))) for (i, _), s, c in zip(data, own, want))
    firsts = {r.doc_id for r in got if r.kept}
    assert {r.component_id for r in got} - {None} <= firsts
    assert sum(r.kept for r in got) < len(got)


def families(seed, count=6, members=14):
    r = random.Random(seed)
    texts = []
    for f in range(count):
        base = [f"f{f}w{i}" for i in range(r.choice((12, 40, 150, 600)))]
        for _ in range(members):
            words = list(base)
            for _ in range(r.randint(0, max(1, len(words) // 16))):
                words[r.randrange(len(words))] = f"x{r.randint(0, 40)}"
            texts.append(" ".join(words))
    r.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_families_around_the_limit(spark, seed):
    """Variants that link to each other but often not to the first of their key."""
    texts = families(seed)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.link_documents(docs, n=4, chunks=3).collect()}
    want = labels(list(range(len(texts))), [sets(t, 4) for t in texts], 80)
    assert got == dict(enumerate(want)) and 6 < len(set(want)) < len(texts)


def test_minhashes_are_the_least_of_each_order():
    r = np.random.Generator(np.random.PCG64(3))
    sizes = np.array([1, 5, 40_000, 3, 70_000, 2])
    shingles = r.integers(0, 2**64, sizes.sum(), dtype=U)
    got = minhash.minhashes(shingles, sizes, 6, 1)
    draw = np.random.Generator(np.random.PCG64(1))
    factors, shifts = draw.integers(0, 2**64, 6, dtype=U) | U(1), draw.integers(0, 2**64, 6, dtype=U)
    ends = np.cumsum(sizes)
    for i in range(6):
        assert got[i].tolist() == [int(((shingles[e - n : e] ^ shifts[i]) * factors[i]).min()) for e, n in zip(ends, sizes)]


def test_tables_have_the_chance_that_is_stated():
    """Pairs of a known similarity share a key as often as the formula says."""
    r = np.random.Generator(np.random.PCG64(9))
    half, rows, size, trials = 2, 6, 60, 800
    for common in (20, 40):  # similarity 0.2 and 0.5
        a = [r.integers(0, 2**64, size, dtype=U) for _ in range(trials)]
        b = [np.concatenate((x[:common], r.integers(0, 2**64, size - common, dtype=U))) for x in a]
        sizes = np.full(2 * trials, size)
        all_ = minhash.bands(np.concatenate(a + b), sizes, half, rows)
        every = np.ones((rows, 2 * trials), bool)
        keys, owner = minhash.tensored(all_[:rows], all_[rows:], every, every)
        assert len(keys) == rows * rows * 2 * trials
        of = [set() for _ in range(2 * trials)]
        for k, o in zip(keys.tolist(), owner.tolist()):
            of[o].add(k)
        met = sum(bool(of[i] & of[trials + i]) for i in range(trials)) / trials
        s = common / (2 * size - common)
        want = (1 - (1 - s**half) ** rows) ** 2
        assert abs(met - want) < 4 * (want * (1 - want) / trials) ** 0.5 + 0.01


def test_no_rows_give_none(spark):
    assert minhash.link_documents(empty(spark)).count() == 0
