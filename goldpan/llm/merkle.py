"""Merkle manifest of a dataset: one tree a part, one over the parts, and a proof for every row.

The trees are circuits whose gates are evaluated by time-forward processing (Chiang et al. 1995): every node has a label, its
level and its place in it, and a digest is a message to the parent's label. A priority queue gives the messages out in label
order, so a node finds its children's digests side by side. Beyond a block of neighbours the queue is external:
the messages are a written table, which Spark deals to the blocks of the next round. A sweep in the reverse order then
delivers to each child the proof of its parent with the child's sibling in front, until every leaf has its own.

A task holds one block, whatever the size of a part; a hot part only has more blocks.
"""

from __future__ import annotations

from hashlib import sha256
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.operators.dedup import ranked_within
from goldpan.scratch import written

#: Levels of a block: it has 1,024 leaves at most.
LEVELS = 10
PROOF = "array<struct<sibling:string,left:boolean>>"
_STEP = pa.struct([("sibling", pa.string()), ("left", pa.bool_())])
_NULL_ID = (1 << 63) - 1


def leaf_digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the values, each as its UTF-8 byte count, a colon and the value, or ``-`` if null."""
    one = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*map(one, columns)), 256)


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    def step(digest: Column, p: Column) -> Column:
        pair = F.when(p["sibling"].isNull(), digest).when(p["left"], F.concat(p["sibling"], digest)).otherwise(F.concat(digest, p["sibling"]))
        return F.sha2(pair, 256)

    return F.aggregate(proof, leaf, step)


def siblings(proof: Column) -> Column:
    """The digests of a proof laid end to end."""
    return F.array_join(F.transform(proof, lambda p: p["sibling"]), "")


def _digest(children: list[str]) -> str:
    return sha256("".join(children).encode()).hexdigest()


def sweep(digests: list[str], levels: int) -> tuple[str, list]:
    """Digest of the node ``levels`` above these neighbours, and (level, place, children) of all nodes between in the order of their labels."""
    queue, swept, top = [(1, i >> 1, i, d) for i, d in enumerate(digests)], [], digests[0]
    while levels and queue:
        level, place, children = *queue[0][:2], []
        while queue and queue[0][:2] == (level, place):
            children.append(heappop(queue)[2:])
        top = _digest([d for _, d in children])
        swept.append((level, place, children))
        if level < levels:
            heappush(queue, (level + 1, place >> 1, place, top))
    return top, swept


def sweep_back(swept: list, count: int, above) -> list:
    """The proof of each of ``count`` leaves as a chain of (sibling, left, rest); ``above`` is that of the topmost node."""
    if not swept:
        return [above]
    found = {swept[-1][:2]: above}
    for level, place, children in reversed(swept):
        rest = found.pop((level, place))
        for k, (child, _) in enumerate(children):
            found[level - 1, child] = (children[1 - k][1] if len(children) == 2 else None, k == 1, rest)
    return [found[0, i] for i in range(count)]


def _height(n: int) -> int:
    """Levels above n nodes until one is left."""
    return (n - 1).bit_length()


def _in_order(table: pa.Table, most: int) -> tuple[pa.Table, list[str], int]:
    table = table.sort_by("pos").combine_chunks()
    return table, table.column("digest").to_pylist(), min(most, _height(table.column("n")[0].as_py()))


def _up(most: int):
    """The digest of a block, as a node of the next round."""
    def up(table: pa.Table) -> pa.Table:
        table, digests, levels = _in_order(table, most)
        top, _ = sweep(digests, levels)
        n = -(-table.column("n")[0].as_py() // (1 << most))
        return pa.table({"part": table.column("part")[:1], "pos": table.column("block")[:1], "n": pa.array([n], pa.int64()), "digest": [top]})

    return up


def _lists(chains: list) -> pa.Array:
    sibling, left, ends = [], [], [0]
    for chain in chains:
        while chain:
            sibling.append(chain[0])
            left.append(chain[1])
            chain = chain[2]
        ends.append(len(sibling))
    steps = pa.StructArray.from_arrays([pa.array(sibling, pa.string()), pa.array(left, pa.bool_())], fields=list(_STEP))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), steps)


def _down(most: int):
    """A block's nodes with their proofs, from the proof of the block."""
    def down(table: pa.Table, above: pa.Table) -> pa.Table:
        table, digests, levels = _in_order(table, most)
        chain = None
        for step in reversed(above.column("proof")[0].as_py()):
            chain = (step["sibling"], step["left"], chain)
        proofs = _lists(sweep_back(sweep(digests, levels)[1], len(digests), chain))
        same = lambda name: pa.array([above.column(name)[0].as_py()] * len(digests), pa.string())
        names = [c for c in table.column_names if c not in ("n", "block")]
        return pa.table({c: table.column(c) for c in names} | {"subroot": same("subroot"), "root": same("root"), "proof": proofs})

    return down


def _blocks(df: DataFrame, levels: int):
    return df.withColumn("block", F.shiftright("pos", levels)).groupBy("part", "block")


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Tables of nodes (part, pos, n, digest): the leaves, then one row a block and round, until each part has one."""
    out, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        out.append(written(_blocks(out[-1].select("part", "pos", "n", "digest"), levels).applyInArrow(_up(levels), "part string, pos long, n long, digest string"), "manifest-nodes"))
        most = -(-most // (1 << levels))
    return out


def _proven(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """The first table of ``rounds`` with subroot, root and proof, from those of the last one's nodes: part, pos, subroot, root, proof."""
    for nodes in reversed(rounds[:-1]):
        fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema if f.name != "n")
        above = tops.withColumnRenamed("pos", "block").select("part", "block", "subroot", "root", "proof")
        found = _blocks(nodes, levels).cogroup(above.groupBy("part", "block")).applyInArrow(_down(levels), f"{fields}, subroot string, root string, proof {PROOF}")
        tops = found if nodes is rounds[0] else written(found.select("part", "pos", "subroot", "root", "proof"), "manifest-proofs")
    return tops if len(rounds) > 1 else rounds[0].join(tops.drop("pos"), "part")


def manifest(docs: DataFrame, *, id_col: str = "doc_id", part_col: str = "lang", columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), carry: dict[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof (array of sibling, left; from the leaf up), and the columns of ``carry``, one row for each input row.

    A leaf is the digest of ``columns``. The leaves of a part ascend by id; nodes meet two by two, level by level, a last one
    alone is hashed alone, and a lone leaf is its part's subroot. Subroots, ordered by part (null first, by UTF-8 bytes),
    give the root in the same way. A step without sibling has a null one; ``left``: the sibling stands left.

    Null values, ids included, are values of their own; null ids come last, rows that repeat an id are ordered by their
    leaves, and equal rows are leaves of their own. No rows give no rows. ``carry``: expressions over ``docs``; ``levels`` of a block.
    """
    real = [F.col(f"`{c}`") for c in columns]
    extra = F.struct(F.lit(True).alias("_"), *[c.alias(n) for n, c in (carry or {}).items()])
    part = F.coalesce(F.concat(F.lit("+"), F.col(f"`{part_col}`").cast("string")), F.lit(""))
    rows = docs.select(part.alias("part"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(f"`{id_col}`").cast("long").alias("doc_id"), leaf_digest(*real).alias("digest"), extra.alias("extra"))
    # The last key only spreads rows that are alike, whose order doesn't matter.
    leaves = written(ranked_within(rows, "part", F.col("id").asc(), F.col("digest").asc(), F.monotonically_increasing_id().asc()).drop("id"), "manifest-leaves")
    trees = _rounds(leaves, levels)
    subroots = trees[-1].select(F.col("part").alias("of"), F.col("digest"), F.lit("").alias("part"))
    upper = _rounds(written(ranked_within(subroots, "part", F.col("of").asc()), "manifest-subroots"), levels)
    root = upper[-1].select("part", "pos", F.lit("").alias("subroot"), F.col("digest").alias("root"), F.array().cast(PROOF).alias("proof"))
    tops = written(_proven(upper, root, levels).select(F.col("of").alias("part"), F.lit(0).cast("long").alias("pos"), F.col("digest").alias("subroot"), "root", "proof"), "manifest-tops")
    out = _proven(trees, tops, levels)
    names = list(carry or {})
    return out.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", "proof", *[F.col(f"extra.{n}").alias(n) for n in names])
