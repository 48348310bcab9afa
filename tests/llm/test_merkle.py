import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from goldpan.llm import merkle
from tests.llm.cases import corpus, empty

COLUMNS = ("doc_id", "source", "lang", "n", "text")


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, columns=COLUMNS):
    return h(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in columns])


def tree(leaves):
    """Root, and the siblings of each leaf, of the run's others level by level."""
    level, at, proofs = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for p, i in zip(proofs, at):
            p += [level[i ^ 1]] if i ^ 1 < len(level) else []
        level, at = [h(*level[i : i + 2]) for i in range(0, len(level), 2)], [i // 2 for i in at]
    return level[0], proofs


def brute(rows, part="lang"):
    parts = defaultdict(list)
    for r in rows:
        parts[r[part]].append(r)
    order = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    found = []
    for p in order:
        parts[p].sort(key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0, leaf(r)))
        found.append(tree([leaf(r) for r in parts[p]]))
    root, above = tree([t for t, _ in found])
    return sorted((str(r["doc_id"]), leaf(r), sub, root, "".join(own + up)) for p, (sub, proofs), up in zip(order, found, above) for r, own in zip(parts[p], proofs))


def got(df):
    return sorted((str(r.doc_id), r.leaf, r.subroot, r.root, "".join(s.sibling or "" for s in r.proof)) for r in df.collect())


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_is_brute_force(spark, levels):
    """Blocks of two, four and 1,024 leaves; nulls in all columns, repeated rows and ids."""
    docs = corpus(spark).cache()
    out = merkle.manifest(docs, columns=COLUMNS, levels=levels)
    assert got(out) == brute(docs.collect())
    again = out.select((merkle.folded(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"))
    assert {r.ok for r in again.collect()} == {True}


@pytest.mark.parametrize("counts", [(1,), (1, 1, 1), (5, 1), (8, 3, 2), (17, 33)])
def test_shapes_of_trees(spark, counts):
    rows = [(p * 100 + i, f"p{p}", "text") for p, n in enumerate(counts) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    columns = ("doc_id", "text")
    want = [(str(a), b, c, d, e) for a, b, c, d, e in brute_of(docs.collect(), columns)]
    assert got(merkle.manifest(docs, columns=columns, levels=2)) == want


def brute_of(rows, columns):
    global leaf
    plain = leaf
    leaf = lambda r: plain(r, columns)
    try:
        return brute(rows)
    finally:
        leaf = plain


def test_any_change_breaks_the_proof_of_its_row_alone(spark):
    docs = spark.createDataFrame([(i, ("a", None)[i % 2], "same text", i) for i in range(40)], "doc_id long, lang string, text string, n int")
    columns = ("doc_id", "lang", "text", "n")
    changed = [F.when(F.col("doc_id") == 7, F.lit(None)).otherwise(F.col("n")) if c == "n" else F.col(c) for c in columns]
    out = merkle.manifest(docs, columns=columns, carry={"now": merkle.leaf_digest(*changed)})
    ok = {r.doc_id: r.ok for r in out.select("doc_id", (merkle.folded(F.col("now"), F.col("proof")) == F.col("root")).alias("ok")).collect()}
    assert ok == {i: i != 7 for i in range(40)}


def test_one_hot_part_and_rows_alike(spark):
    """Many rows alike in id and content are leaves of their own, in one part."""
    docs = spark.createDataFrame([(1, "a", "x")] * 3000 + [(None, "a", "x")] * 50 + [(2, "b", "é" * 40_000)], "doc_id long, lang string, text string")
    columns = ("doc_id", "lang", "text")
    assert got(merkle.manifest(docs, columns=columns)) == brute_of(docs.collect(), columns)


def test_no_rows_give_none(spark):
    assert merkle.manifest(empty(spark), columns=COLUMNS).count() == 0
