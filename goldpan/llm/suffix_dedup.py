"""Suffix-array dedup: repeated byte strings from the interval tree of an enhanced suffix array.

``repeats`` brings together, in groups of bounded size, one copy of each stretch that may share a string with another.
Over each group a suffix array with common-prefix lengths is built and scanned with a stack: every interval of suffixes with
a common prefix of ``length`` bytes or more is a repeat with all its occurrences. Intervals whose occurrences can all be
extended to the left by one byte are left out, as the extended interval says more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_text
from .repeats import _joined, covered, united
from .rolling import slices

_MIXED = -1


def suffix_array(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of all suffixes, and the common prefix of each with the one before it, by doubling. No two sentinels may be equal."""
    n = len(text)
    base = int(text.max(initial=0)) + 2
    width = max(w for w in (1, 2, 3, 4) if w == 1 or base**w < 1 << 62)  # symbols that fit into the first key
    key = np.zeros(n, np.int64)
    for i in range(width):
        key *= base
        key[: max(0, n - i)] += text[i:] + 1
    ranks, step = [], width
    while True:
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], sorted_[1:] != sorted_[:-1]))) if n else 0
        ranks.append(rank)
        if not n or rank[order[-1]] == n - 1 or step >= n:
            break
        key = rank * (n + 1)
        key[: n - step] += rank[step:] + 1
        step *= 2
    common = np.zeros(n, np.int64)
    if n > 1:
        x, y = order[:-1].copy(), order[1:].copy()

        def advance(values: np.ndarray, by: int, among: np.ndarray) -> np.ndarray:
            at = among[(x[among] < n) & (y[among] < n)]
            at = at[values[x[at]] == values[y[at]]]
            x[at] += by
            y[at] += by
            return at

        every = np.arange(n - 1)
        for j in range(len(ranks) - 1, -1, -1):
            advance(ranks[j], width << j, every)
        for _ in range(width - 1):
            every = advance(text, 1, every)
        common[1:] = x - order[:-1]
    return order, common


def repeat_groups(order: np.ndarray, common: np.ndarray, ord_: np.ndarray, left: np.ndarray, length: int):
    """(depth, first, last, smallest ord) of each left-diverse interval: suffixes order[first:last + 1] share ``depth`` symbols.

    ord_ and left are by position: the id of the suffix's document, and the symbol before it (``_MIXED``: none).
    """
    deep = np.flatnonzero(common >= length)
    if not len(deep):
        return
    breaks = np.flatnonzero(np.diff(deep) != 1)
    for a, b in zip(np.append(deep[0], deep[breaks + 1]).tolist(), np.append(deep[breaks], deep[-1]).tolist()):
        depths = common[a : b + 1].tolist() + [0]
        ids, lefts = ord_[order[a - 1 : b + 1]].tolist(), left[order[a - 1 : b + 1]].tolist()
        stack: list[list[int]] = []  # depth, first, smallest ord, left symbol
        for i, depth in enumerate(depths):
            first, least, before = i, ids[i], lefts[i]
            while stack and stack[-1][0] > depth:
                d, first, m, x = stack.pop()
                least, before = min(least, m), before if before == x else _MIXED
                if before == _MIXED:
                    yield d, a - 1 + first, a - 1 + i, least
            if stack and stack[-1][0] == depth:
                top = stack[-1]
                top[2], top[3] = min(top[2], least), top[3] if top[3] == before else _MIXED
            elif depth >= length:
                stack.append([depth, first, least, before])


def _by_suffixes(symbols: np.ndarray, lengths: np.ndarray, ord_: np.ndarray, length: int):
    """Ranges that a smaller id has too, of sequences laid end to end."""
    n, ends = len(lengths), np.cumsum(lengths)
    at = np.arange(len(symbols)) + np.repeat(np.arange(n), lengths)
    text = np.empty(len(symbols) + n, np.int64)
    text[at] = symbols.astype(np.int64) + n
    text[ends + np.arange(n)] = np.arange(n)  # a sentinel of its own behind each sequence
    owner = np.repeat(np.arange(n), lengths + 1)
    left = np.full(len(text), _MIXED, np.int64)
    left[1:] = text[:-1]
    left[(ends - lengths) + np.arange(n)] = _MIXED
    order, common = suffix_array(text)
    by_position, reach = ord_[owner], np.zeros(len(text), np.int64)
    for depth, first, last, least in repeat_groups(order, common, by_position, left, length):
        where = order[first : last + 1]
        where = where[by_position[where] > least]
        reach[where] = np.maximum(reach[where], depth)
    low = np.flatnonzero(reach)
    return _joined(low - owner[low], low - owner[low] + reach[low], owner[low])


def _read_bytes(texts, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    off = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset + begin : texts.offset + end + 1].astype(np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)), np.diff(off)


def with_spans(texts: DataFrame, spans: DataFrame) -> DataFrame:
    """``texts`` (doc_id, text) with each row's spans, null where there are none."""
    s = spans.select(F.when(F.col("ord") != (1 << 63) - 1, F.col("ord")).alias("s_id"), F.col("text_hash").alias("s_hash"), "spans")
    keyed = texts.withColumn("text_hash", F.xxhash64("text"))
    return keyed.join(s, keyed.doc_id.eqNullSafe(s.s_id) & (keyed.text_hash == s.s_hash), "left").select("doc_id", "text", "spans")


_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("kept", pa.binary())])


def _cut(batches):
    for batch in batches:
        for begin, end in slices(batch.column("text"), 8 << 20):
            part = batch.slice(begin, end - begin)
            texts = part.column("text").cast(pa.binary()).to_pylist()
            found = [united([(s["start"], s["stop"]) for s in x]) if x else [] for x in part.column("spans").to_pylist()]
            kept = []
            for data, gone in zip(texts, found):
                edges = [0, *(x for s in gone for x in s), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2])) if gone else data)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array([len(t) - len(x) for t, x in zip(texts, kept)], pa.int64()),
                 pa.array([[{"start": a, "stop": b} for a, b in s] for s in found], _OUT.field("spans").type), pa.array(kept, pa.binary())], schema=_OUT,
            )


def dedup_strings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = 32, **spread) -> DataFrame:
    """Cut each byte that a string of ``length`` bytes covers which also starts in a document with a smaller id.

    Returns doc_id, n_bytes, n_removed, spans (maximal cut byte ranges), kept (binary), one row for each input row. Strings
    are judged on the input and lie in one text. Null and empty texts have no bytes. Rows that repeat a doc_id don't cut
    each other. A null doc_id is after all others. No rows give no rows; other columns are ignored.

    ``k`` (below ``length``): bytes of the anchors that route equal strings to each other. ``spread``: chunks and together of ``covered``.
    """
    texts = id_text(docs, id_col, text_col)
    found = covered(texts, length=length, k=k, read=_read_bytes, dtype=np.uint8, local=_by_suffixes, **spread)
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:int,stop:int>>, kept binary"
    return with_spans(texts, found).mapInArrow(_cut, schema)
