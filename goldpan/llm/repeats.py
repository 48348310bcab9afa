"""Every stretch of ``length`` symbols that also stands in a document with a smaller id, exactly, on whole corpora.

Symbols are bytes or words. Steps, each a Spark job over groups of bounded size:

1. The least k-gram hash of each window of ``length`` symbols is its anchor; equal windows have equal anchors. Runs are
   consecutive windows with one anchor. ``shared_prints`` tells which anchors stand in more than one document.
2. Only the stretches under shared anchors go on. They are cut into runs again; a run's content is hashed and meets its equals in
   buckets by anchor, once a chunk with its smallest id. Copies that are not the first are covered at once.
3. What is left is one copy of each distinct run whose anchor has several contents: edges of passages and of edits. These
   meet by anchor in groups, where ``local`` finds their common parts, a few anchors at a time: equal windows have one anchor. An
   anchor with very many contents is spread over groups by content; each group sends its distinct windows once, by hash, and
   hears which of them a smaller id has. One whose contents are too long for ``local`` is settled by hashes of windows in its group.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_prints as sp
from goldpan.scratch import release, written

from .common import text_bytes
from .rolling import U, byte_symbols, fixed_windows, grams, keyed, mix, prefix, sliding_min, strings, windows

_PARTS = "chunk int, ord long, text_hash long, start int, data binary"
_FOUND = "kind int, ord long, text_hash long, start int, stop int, part long, spread boolean, print long, data binary"
_FIELDS = pa.schema([("kind", pa.int32()), ("ord", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32()), ("stop", pa.int32()), ("part", pa.int64()), ("spread", pa.bool_()), ("print", pa.int64()), ("data", pa.binary())])
COVERED, LEFT = 0, 1
#: log2 of the contents of one anchor up to which they meet in one group.
TOGETHER = 12
_SLICE = 1 << 20
#: Symbols of whole anchors that ``local`` gets at once, and those of one anchor up to which it does: its arrays take about 200 bytes a symbol.
_AT_A_TIME, _MOST = 1 << 18, 1 << 20


class Runs:
    """Maximal runs of windows with one anchor, of sequences laid end to end."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, length: int, k: int):
        #: Bytes or words as they came.
        self.plain, self.length = symbols, length
        least = sliding_min(grams(prefix(_wide(symbols)), k), length - k + 1)
        at = np.flatnonzero(fixed_windows(lengths, length)[: len(least)])
        anchor = least[at]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (anchor[1:] != anchor[:-1])
        first = np.flatnonzero(new)
        self.start = at[first]
        #: Behind the last symbol of the last window.
        self.stop = at[np.append(first[1:], len(at)) - 1] + length if len(at) else at
        self.print = anchor[first] >> U(64 - sp.BITS)
        self.owner = np.repeat(np.arange(len(lengths)), lengths)[self.start] if len(at) else at

    def contents(self) -> np.ndarray:
        """64-bit hash of each run."""
        width = self.plain.dtype.itemsize
        return strings(self.plain.view(np.uint8), self.start * width, self.stop * width)


def _table(kind: int, **cols) -> pa.Table:
    n = len(cols["ord"])
    return pa.table({f.name: pa.array(np.full(n, kind, np.int32)) if f.name == "kind" else pa.array(cols[f.name], f.type) if f.name in cols else pa.nulls(n, f.type) for f in _FIELDS}, schema=_FIELDS)


def _joined(low: np.ndarray, high: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges in order, those of one owner that overlap or touch made one."""
    if not len(low):
        return low, high, owner
    order = np.lexsort((low, owner))
    low, high, owner = low[order], high[order], owner[order]
    shift = owner.astype(np.int64) * (int(high.max()) + 2)
    reach = np.maximum.accumulate(high + shift)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] + shift[1:] > reach[:-1]
    first = np.flatnonzero(new)
    return low[first], (reach - shift)[np.append(first[1:], len(low)) - 1], owner[first]


def _runs_of_texts(cols: dict, read: Callable, length: int, k: int):
    """For each slice of texts: (symbols, end of each text, first text, runs)."""
    from .rolling import slices

    for begin, end in slices(cols["text"], _SLICE):
        symbols, lengths = read(cols["text"], begin, end)
        yield symbols, np.cumsum(lengths) - lengths, begin, Runs(symbols, lengths, length, k)


def _wide(symbols: np.ndarray) -> np.ndarray:
    return byte_symbols(symbols) if symbols.dtype == np.uint8 else symbols


def shared_parts(docs: DataFrame, read: Callable, length: int, k: int, chunks: int) -> DataFrame:
    """Steps 1: (chunk, ord, text_hash, start, data) of each stretch under anchors that two documents share."""
    texts = sp.chunked(docs, chunks)

    def send(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        found = [np.unique(runs.print) for *_, runs in _runs_of_texts(cols, read, length, k)]
        return sp.messages(cols["chunk"][0].as_py(), np.unique(np.concatenate(found)), chunks)

    def keep(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = {"chunk": [], "ord": [], "text_hash": [], "start": [], "data": []}
        if table.num_rows:
            cols = sp.columns(table)
            chunk, ord_, hash_ = cols["chunk"][0].as_py(), sp.numbers(cols["ord"]), sp.numbers(cols["text_hash"])
            each = list(_runs_of_texts(cols, read, length, k))
            prints = np.concatenate([r.print for *_, r in each])
            owners = np.concatenate([ord_[begin + r.owner] for _, _, begin, r in each])
            order = np.argsort(prints, kind="stable")
            known, first = np.unique(prints[order], return_index=True)
            here = owners[order]
            shared = sp.shared_mask(known, chunks, answers)
            if len(known):
                shared |= np.minimum.reduceat(here, first) != np.maximum.reduceat(here, first)
            known = known[shared]
            for symbols, starts, begin, runs in each:
                on = sp.contains(known, runs.print)
                low, high, owner = _joined_windows(runs, on, length)
                out["chunk"] += [chunk] * len(low)
                out["ord"].append(ord_[begin + owner])
                out["text_hash"].append(hash_[begin + owner])
                out["start"].append((low - starts[owner]).astype(np.int32))
                out["data"] += [symbols[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist())]
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        return pa.table({"chunk": pa.array(out["chunk"], pa.int32()), "ord": join(out["ord"], np.int64), "text_hash": join(out["text_hash"], np.int64), "start": join(out["start"], np.int32), "data": pa.array(out["data"], pa.binary())})

    answers = sp.answers(texts.groupBy("chunk").applyInArrow(keyed(send), sp.BLOBS))
    return written(texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(keyed(keep), _PARTS), "shared-parts")


def _joined_windows(runs: Runs, on: np.ndarray, length: int):
    """Stretches of consecutive chosen runs; runs whose windows are not neighbours stay apart."""
    start, last, owner = runs.start[on], runs.stop[on] - length, runs.owner[on]
    if not len(start):
        return start, last, owner
    new = np.ones(len(start), bool)
    new[1:] = start[1:] != last[:-1] + 1
    first = np.flatnonzero(new)
    return start[first], last[np.append(first[1:], len(start)) - 1] + length, owner[first]


def _part_runs(cols: dict, dtype, length: int, k: int):
    """For each slice of parts: (first part, start of each part, symbols, runs)."""
    from .rolling import slices

    width = np.dtype(dtype).itemsize
    offsets = np.frombuffer(cols["data"].buffers()[1], np.int32)[cols["data"].offset : cols["data"].offset + len(cols["data"]) + 1].astype(np.int64)
    raw = np.frombuffer(cols["data"].buffers()[2], np.uint8)
    for begin, end in slices(cols["data"], _SLICE * width):
        symbols = raw[offsets[begin] : offsets[end]].view(dtype) if width == 1 else np.frombuffer(raw[offsets[begin] : offsets[end]].tobytes(), dtype)
        lengths = np.diff(offsets[begin : end + 1]) // width
        yield begin, np.cumsum(lengths) - lengths, symbols, Runs(symbols, lengths, length, k)


def _entries(each: list, ord_: np.ndarray):
    """Distinct (print, content) of all runs, sorted, with the smallest ord, and each run's entry."""
    prints = np.concatenate([r.print for *_, r in each])
    contents = np.concatenate([r.contents() for *_, r in each])
    owners = np.concatenate([ord_[begin + r.owner] for begin, _, _, r in each])
    order = np.lexsort((owners, contents, prints))
    p, c = prints[order], contents[order]
    new = np.ones(len(p), bool)
    new[1:] = (p[1:] != p[:-1]) | (c[1:] != c[:-1])
    entry = np.empty(len(p), np.int64)
    entry[order] = np.cumsum(new) - 1
    return p[new], c[new], owners[order][new], entry, owners


def _meet(table: pa.Table) -> pa.Table:
    """Step 2 in a bucket. A byte for each entry: 128 if a smaller id has the content; else how many contents its anchor has (log2, rounded up)."""
    cols = sp.columns(table)
    prints = [sp.unpacked(b) for b in cols["prints"].to_pylist()]
    counts = [np.frombuffer(b, "<u2") for b in cols["counts"].to_pylist()]
    p = np.concatenate([np.repeat(x, n) for x, n in zip(prints, counts)])
    c = np.concatenate([np.frombuffer(b, "<u8") for b in cols["contents"].to_pylist()])
    o = np.concatenate([np.frombuffer(b, "<i8") for b in cols["ords"].to_pylist()])
    order = np.lexsort((o, c, p))
    sp_, sc, so = p[order], c[order], o[order]
    new_p = np.ones(len(p), bool)
    new_p[1:] = sp_[1:] != sp_[:-1]
    new = new_p.copy()
    new[1:] |= sc[1:] != sc[:-1]
    first = so[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
    group = np.cumsum(new_p) - 1
    contents = np.bincount(group, weights=new)[group]
    flags = np.empty(len(p), np.uint8)
    flags[order] = np.where(so > first, 128, 0) + np.ceil(np.log2(np.maximum(contents, 1))).astype(np.uint8)
    sizes = [int(x.sum()) for x in counts]
    ends = np.cumsum(sizes)
    return pa.table({"chunk": cols["chunk"], "bucket": cols["bucket"], "flags": pa.array([flags[e - n : e].tobytes() for n, e in zip(sizes, ends)], pa.binary())})


def _whole_anchors(prints: np.ndarray, lengths: np.ndarray):
    """(begin, end) of rows in order of their anchors: whole anchors, of about ``_AT_A_TIME`` symbols together."""
    first = np.append(np.flatnonzero(np.append(True, prints[1:] != prints[:-1])), len(prints))
    before = np.append(0, np.cumsum(lengths))[first]
    i = 0
    while i < len(first) - 1:
        j = max(i + 1, int(np.searchsorted(before, before[i] + _AT_A_TIME, "right")) - 1)
        yield int(first[i]), int(first[j])
        i = j


def _by_windows(symbols: np.ndarray, lengths: np.ndarray, ord_: np.ndarray, length: int):
    """Ranges that a smaller id has too, by the hash of each window: some rows at a time, of which only distinct windows stay."""
    ends = np.cumsum(lengths)

    def slices_():
        begin = 0
        while begin < len(lengths):
            start = int(ends[begin] - lengths[begin])
            end = max(begin + 1, int(np.searchsorted(ends, start + _SLICE, "right")))
            own = lengths[begin:end]
            at = np.flatnonzero(fixed_windows(own, length))
            yield start + at, begin + np.repeat(np.arange(end - begin), own)[at], windows(_wide(symbols[start : int(ends[end - 1])]), length)[at]
            begin = end

    def distinct(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((ids, hashes))
        hashes = hashes[order]
        new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
        return hashes[new], ids[order][new]

    found = [distinct(w, ord_[owner]) for _, owner, w in slices_()]
    known, least = distinct(*(np.concatenate(x) for x in zip(*found)))
    hits = []
    for at, owner, w in slices_():
        hit = least[np.searchsorted(known, w)] < ord_[owner]
        hits.append(_joined(at[hit], at[hit] + length, owner[hit]))
    return tuple(np.concatenate(x) for x in zip(*hits))


def covered(docs: DataFrame, *, length: int, k: int, read: Callable, dtype, local: Callable, chunks: int | None = None, together: int = TOGETHER) -> DataFrame:
    """ord, text_hash, spans (array of start, stop): which symbols of ``docs`` (doc_id, text) are covered, where any are.

    ``chunks``: tasks that the corpus is dealt to, by its size if not given; ``together``: log2 of the contents of one anchor
    up to which they meet in one group. ``read``: (texts, begin, end) -> symbols and their number in each text. ``local``: see step 3.
    """
    chunks = chunks or 4 * sp.chunk_count(text_bytes(docs) >> 2)  # half as large as others: a task holds about 35 bytes a symbol of its chunk
    parts = shared_parts(docs, read, length, k, chunks)

    def send(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        each = list(_part_runs(cols, dtype, length, k))
        p, c, o, *_ = _entries(each, sp.numbers(cols["ord"]))
        at, out = sp.bounds(p, chunks), []
        for b in np.flatnonzero(np.diff(at)):
            own = slice(at[b], at[b + 1])
            prints, n = np.unique(p[own], return_counts=True)
            wide = np.repeat(prints, -(-n // 65535))  # of a print with very many contents, several counts
            left = np.concatenate([[65535] * (m // 65535) + [m % 65535] * bool(m % 65535) for m in n.tolist()]) if (n > 65535).any() else n
            out.append((b, sp.packed(wide), np.asarray(left).astype("<u2").tobytes(), c[own].tobytes(), o[own].astype("<i8").tobytes()))
        chunk = cols["chunk"][0].as_py()
        return pa.table({"bucket": pa.array([x[0] for x in out], pa.int32()), "chunk": pa.array([chunk] * len(out), pa.int32())} | {n: pa.array([x[i] for x in out], pa.binary()) for i, n in enumerate(("prints", "counts", "contents", "ords"), 1)})

    def settle(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _FIELDS.empty_table()
        cols = sp.columns(table)
        ord_, hash_, from_ = sp.numbers(cols["ord"]), sp.numbers(cols["text_hash"]), sp.numbers(cols["start"])
        each = list(_part_runs(cols, dtype, length, k))
        p, c, o, entry, owners = _entries(each, ord_)
        flags, at, told = np.zeros(len(p), np.uint8), sp.bounds(p, chunks), sp.columns(answers)
        for b, x in zip(told["bucket"].to_pylist(), told["flags"].to_pylist()):
            flags[at[b] : at[b + 1]] = np.frombuffer(x, np.uint8)
        gone = (flags[entry] >= 128) | (o[entry] < owners)
        many = flags[entry] & 127
        out, done = [], 0
        for begin, starts, symbols, runs in each:
            n = len(runs.start)
            here, left = gone[done : done + n], ~gone[done : done + n] & (many[done : done + n] > 0)
            low, high, owner = _joined(runs.start[here], runs.stop[here], runs.owner[here])
            shift = from_[begin + owner] - starts[owner]
            out.append(_table(COVERED, ord=ord_[begin + owner], text_hash=hash_[begin + owner], start=(low + shift).astype(np.int32), stop=(high + shift).astype(np.int32)))
            low, high, owner = runs.start[left], runs.stop[left], runs.owner[left]
            e, wide = entry[done : done + n][left], many[done : done + n][left].astype(np.int64)
            salt = c[e] % (U(1) << np.maximum(wide - together, 0).astype(U))
            part = (mix(p[e] + salt * U(0x9E3779B97F4A7C15)) % U(chunks)).astype(np.int64)
            data = pa.array([symbols[a:b].tobytes() for a, b in zip(low.tolist(), high.tolist())], pa.binary())
            out.append(_table(LEFT, ord=ord_[begin + owner], text_hash=hash_[begin + owner], start=(low - starts[owner] + from_[begin + owner]).astype(np.int32), part=part, spread=wide > together, print=p[e].astype(np.int64), data=data))
            done += n
        return pa.concat_tables(out)

    def contents(cols: dict):
        """Contents laid end to end: symbols, their number in each, and windows of spread ones: (start, content, key)."""
        offsets = np.frombuffer(cols["data"].buffers()[1], np.int32)[cols["data"].offset : cols["data"].offset + len(cols["data"]) + 1].astype(np.int64)
        symbols = np.frombuffer(np.frombuffer(cols["data"].buffers()[2], np.uint8)[offsets[0] : offsets[-1]].tobytes(), dtype)
        lengths, spread = np.diff(offsets) // np.dtype(dtype).itemsize, sp.numbers(cols["spread"])
        if not spread.any():
            return symbols, lengths, None
        at = np.flatnonzero(fixed_windows(lengths, length))
        owner = np.repeat(np.arange(len(lengths)), lengths)[at]
        at, owner = at[spread[owner]], owner[spread[owner]]
        return symbols, lengths, (at, owner, windows(_wide(symbols), length)[at])

    def classes(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        _, _, (_, owner, window) = contents(cols)
        prints, ord_ = sp.numbers(cols["print"])[owner], sp.numbers(cols["ord"])[owner]
        order = np.lexsort((ord_, window, prints))
        p, w = prints[order], window[order]
        new = np.ones(len(p), bool)
        new[1:] = (p[1:] != p[:-1]) | (w[1:] != w[:-1])
        return pa.table({"part": pa.array(np.full(int(new.sum()), cols["part"][0].as_py(), np.int64)), "print": pa.array(p[new]), "window": pa.array(w[new].view(np.int64)), "least": pa.array(ord_[order][new])})

    def compare(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _FIELDS.empty_table()
        cols = sp.columns(table)
        order = pa.array(np.argsort(sp.numbers(cols["print"]), kind="stable"))
        cols = {n: cols[n].take(order) for n in ("ord", "text_hash", "start", "spread", "print", "data")}
        ord_, hash_, from_, prints = (sp.numbers(cols[n]) for n in ("ord", "text_hash", "start", "print"))
        sizes = np.diff(np.frombuffer(cols["data"].buffers()[1], np.int32)[cols["data"].offset : cols["data"].offset + len(prints) + 1]) // np.dtype(dtype).itemsize
        told = sp.columns(answers) if answers.num_rows else None
        if told:
            known = mix(sp.numbers(told["window"]).view(U) ^ mix(sp.numbers(told["print"]).view(U), 1))
            sort = np.argsort(known)
            known, first = known[sort], sp.numbers(told["first"])[sort]
        out = []
        for begin, end in _whole_anchors(prints, sizes):
            symbols, lengths, windows = contents({n: c.slice(begin, end - begin) for n, c in cols.items()})
            ids, starts = ord_[begin:end], np.cumsum(lengths) - lengths
            found = [(local if len(symbols) <= _MOST else _by_windows)(symbols, lengths, ids, length)]
            if windows is not None and told:
                at, owner, window = windows
                key = mix(window ^ mix(prints[begin + owner].view(U), 1))
                place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                hit = (known[place] == key) & (first[place] < ids[owner])
                found.append(_joined(at[hit], at[hit] + length, owner[hit]))
            for low, high, owner in found:
                shift, owner = from_[begin + owner] - starts[owner], begin + owner
                out.append(_table(COVERED, ord=ord_[owner], text_hash=hash_[owner], start=(low + shift).astype(np.int32), stop=(high + shift).astype(np.int32)))
        return pa.concat_tables(out)

    met = parts.groupBy("chunk").applyInArrow(keyed(send), "bucket int, chunk int, prints binary, counts binary, contents binary, ords binary").groupBy("bucket").applyInArrow(_meet, "chunk int, bucket int, flags binary")
    settled = written(parts.groupBy("chunk").cogroup(met.groupBy("chunk")).applyInArrow(keyed(settle), _FOUND), "settled-runs")
    release(parts)
    left = settled.filter(F.col("kind") == LEFT)
    sent = written(left.filter("spread").groupBy("part").applyInArrow(keyed(classes), "part long, print long, window long, least long"), "window-classes")
    firsts = sent.groupBy("print", "window").agg(F.min("least").alias("first"), F.count("*").alias("c")).filter("c > 1").select("print", "window", "first")
    told = sent.join(firsts, ["print", "window"]).filter("first < least").select("part", "print", "window", "first")
    compared = written(left.groupBy("part").cogroup(told.groupBy("part")).applyInArrow(keyed(compare), _FOUND), "compared-runs")
    pairs = [df.filter(F.col("kind") == COVERED).select("ord", "text_hash", "start", "stop") for df in (settled, compared)]
    return pairs[0].unionByName(pairs[1]).groupBy("ord", "text_hash").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def united(spans_: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges, those that overlap or touch made one."""
    out: list[list[int]] = []
    for a, b in sorted(spans_):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
