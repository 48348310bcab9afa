"""Substring dedup: Rabin-Karp hashes of windows of words, counted in Spark, merged into maximal removal intervals."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import shared_prints as sp
from .common import id_text, text_bytes
from .repeats import _joined, shared_parts, united
from .rolling import SPACED, U, Words, fixed_windows, keyed, laid_out, slices, windows
from .suffix_dedup import with_spans

_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])


def _read_words(texts, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    words = Words(*laid_out(texts, begin, end), SPACED, lower=False)
    return words.hash, words.counts


def _windows(cols: dict, length: int):
    """For each slice of stretches of words: start, owner (a stretch) and hash of every window, and where each stretch begins in the slice."""
    offsets = np.frombuffer(cols["data"].buffers()[1], np.int32)[cols["data"].offset : cols["data"].offset + len(cols["data"]) + 1].astype(np.int64)
    raw = np.frombuffer(cols["data"].buffers()[2], np.uint8)
    for begin, end in slices(cols["data"], 4 << 20):
        words = np.frombuffer(raw[offsets[begin] : offsets[end]].tobytes(), U)
        lengths = np.diff(offsets[begin : end + 1]) // 8
        at = np.flatnonzero(fixed_windows(lengths, length))
        owner = np.repeat(np.arange(end - begin), lengths)[at]
        yield at, begin + owner, windows(words, length)[at], begin, np.cumsum(lengths) - lengths


def _least(hashes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, the smallest id of each, and how often it comes."""
    order = np.lexsort((ids, hashes))
    sorted_ = hashes[order]
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(order) else order
    return sorted_[first], ids[order][first], np.diff(np.append(first, len(order)))


def repeated_windows(docs: DataFrame, *, length: int, k: int, chunks: int | None = None) -> DataFrame:
    """ord, text_hash, spans (array of start, stop): words of ``docs`` (doc_id, text) in windows that a smaller id has too.

    Windows whose anchors (see ``repeats``) no other document has can't repeat and aren't counted. Of all others each chunk of
    the corpus sends the hash once, with its smallest id and count; Spark counts them by hash and tells the chunks which
    ones begin in a smaller id elsewhere. A window that a third of all documents hold arrives once a chunk.
    """
    parts = shared_parts(docs, _read_words, length, k, chunks or sp.chunk_count(text_bytes(docs)))

    def count(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        ord_ = sp.numbers(cols["ord"])
        found = [(h, ord_[owner]) for _, owner, h, *_ in _windows(cols, length)]
        hashes, least, n = _least(np.concatenate([h for h, _ in found]), np.concatenate([o for _, o in found]))
        return pa.table({"chunk": pa.array(np.full(len(hashes), cols["chunk"][0].as_py(), np.int32)), "window": pa.array(hashes.view(np.int64)), "least": pa.array(least), "n": pa.array(n.astype(np.int64))})

    def mark(table: pa.Table, answers: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(4)]
        if table.num_rows:
            cols = sp.columns(table)
            ord_, hash_, from_ = (sp.numbers(cols[c]) for c in ("ord", "text_hash", "start"))
            each = list(_windows(cols, length))
            here, least, _ = _least(np.concatenate([h for _, _, h, *_ in each]), np.concatenate([ord_[owner] for _, owner, *_ in each]))
            told = np.sort(sp.numbers(sp.columns(answers)["window"]).view(U)) if answers.num_rows else np.zeros(0, U)
            for at, owner, hashes, begin, starts in each:
                hit = sp.contains(told, hashes) | (least[np.searchsorted(here, hashes)] < ord_[owner])
                low, high, part = _joined(at[hit], at[hit] + length, owner[hit])
                shift = from_[part] - starts[part - begin]
                for x, values in zip(out, (ord_[part], hash_[part], low + shift, high + shift)):
                    x.append(values.astype(np.int64))
        names = ("ord", "text_hash", "start", "stop")
        return pa.table({c: pa.array(np.concatenate(x), pa.int64() if c in names[:2] else pa.int32()) for c, x in zip(names, out)})

    counted = parts.groupBy("chunk").applyInArrow(keyed(count), "chunk int, window long, least long, n long")
    same = Window.partitionBy("window")  # a row a chunk at most
    repeated = counted.withColumn("first", F.min("least").over(same)).withColumn("times", F.sum("n").over(same)).filter("times > 1 and first < least")
    found = parts.groupBy("chunk").cogroup(repeated.select("chunk", "window").groupBy("chunk")).applyInArrow(keyed(mark), "ord long, text_hash long, start int, stop int")
    return found.groupBy("ord", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def _cut(batches):
    for batch in batches:
        for begin, end in slices(batch.column("text"), 8 << 20):
            part = batch.slice(begin, end - begin)
            counts, removed, kept = [], [], []
            for data, found in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("spans").to_pylist()):
                words = data.split()  # of bytes: at 0x20 and 0x09 to 0x0D only
                counts.append(len(words))
                gone = united([(s["start"], s["stop"]) for s in found]) if found else []
                edges = [0, *(x for s in gone for x in s), len(words)]
                left = [w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]] if gone else words
                removed.append(len(words) - len(left))
                kept.append(b" ".join(left))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], schema=_OUT)


def dedup_windows(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = 24, chunks: int | None = None) -> DataFrame:
    """Remove each word that a window of ``length`` words covers whose words also start in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept (the words left, joined by one space), one row for each input row. Words are
    what stands between 0x20 and 0x09 to 0x0D; windows are judged on the input and lie in one text. Null and empty
    texts have no words. Rows that repeat a doc_id don't remove each other's words. A null doc_id is after all others.
    No rows give no rows; other columns are ignored.

    ``k`` (below ``length``): words of the anchors that tell which windows can repeat. ``chunks``: tasks that the corpus is dealt to, by its size if not given.
    """
    texts = id_text(docs, id_col, text_col)
    found = repeated_windows(texts, length=length, k=k, chunks=chunks)
    return with_spans(texts, found).mapInArrow(_cut, "doc_id long, n_words long, n_removed long, kept string")
