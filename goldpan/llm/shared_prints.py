"""Which fingerprints stand in more than one chunk of the corpus, at about four bytes a fingerprint.

A chunk is a group of documents by hash, small enough for a task. It sends its sorted distinct fingerprints, as differences,
to buckets by value, so a fingerprint that a third of all documents hold arrives once a chunk. A bucket answers each chunk
with one bit a fingerprint. Fingerprints have 48 bits: a clash only makes a candidate more, which exact steps drop later.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rolling import U, tidy

BITS = 48
BLOBS = "bucket int, chunk int, prints binary"
ANSWERS = "chunk int, bucket int, bits binary"


def chunk_count(total_bytes: int) -> int:
    """Chunks of 4 MB and, as the corpus grows, of up to 64 MB: their number squared is the number of messages."""
    each = min(64 << 20, max(4 << 20, math.isqrt(total_bytes << 14)))
    return max(1, -(-total_bytes // each))


def chunked(docs: DataFrame, chunks: int) -> DataFrame:
    """chunk, ord (doc_id; null is after all others), text_hash, text."""
    keyed = docs.select(F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("ord"), F.xxhash64("text").alias("text_hash"), "text")
    return keyed.select(F.pmod(F.xxhash64("ord", "text_hash"), F.lit(chunks)).cast("int").alias("chunk"), "ord", "text_hash", "text")


def columns(table: pa.Table) -> dict[str, pa.Array]:
    """Each column in one piece. Groups begin with it, so what the last one left goes back first."""
    tidy()
    batches = table.combine_chunks()
    return {n: (c.combine_chunks() if isinstance(c := batches.column(n), pa.ChunkedArray) else c) for n in table.column_names}


def numbers(array: pa.Array) -> np.ndarray:
    return array.to_numpy(zero_copy_only=False)


def bounds(prints: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's values begin in sorted prints, and the end."""
    edges = [(b << BITS) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(prints, np.array(edges, U)), len(prints))


def packed(prints: np.ndarray) -> bytes:
    """Sorted values as differences, of 4 bytes each if they fit."""
    steps = np.diff(prints, prepend=U(0))
    steps_ = steps[1:] if len(steps) > 1 else steps[:0]
    narrow = not len(steps_) or int(steps_.max()) < 1 << 32
    return bytes([4 if narrow else 8]) + prints[:1].astype("<u8").tobytes() + steps_.astype("<u4" if narrow else "<u8").tobytes()


def unpacked(blob: bytes) -> np.ndarray:
    if len(blob) < 9:
        return np.zeros(0, U)
    steps = np.frombuffer(blob, "<u4" if blob[0] == 4 else "<u8", offset=9).astype(U)
    return np.cumsum(np.concatenate((np.frombuffer(blob, "<u8", 1, 1).astype(U), steps)), dtype=U)


def messages(chunk: int, prints: np.ndarray, buckets: int) -> pa.Table:
    at = bounds(prints, buckets)
    full = np.flatnonzero(np.diff(at))
    return pa.table({
        "bucket": pa.array(full.astype(np.int32)), "chunk": pa.array(np.full(len(full), chunk, np.int32)),
        "prints": pa.array([packed(prints[at[b] : at[b + 1]]) for b in full], pa.binary()),
    })


def _answer(table: pa.Table) -> pa.Table:
    cols = columns(table)
    parts = [unpacked(b) for b in cols["prints"].to_pylist()]
    values = np.concatenate(parts)
    order = np.argsort(values, kind="stable")
    sorted_ = values[order]
    same = sorted_[1:] == sorted_[:-1]
    shared = np.zeros(len(values), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    ends = np.cumsum([len(p) for p in parts])
    bits = [np.packbits(shared[e - len(p) : e]).tobytes() for p, e in zip(parts, ends)]
    return pa.table({"chunk": cols["chunk"], "bucket": cols["bucket"], "bits": pa.array(bits, pa.binary())})


def answers(blobs: DataFrame) -> DataFrame:
    return blobs.groupBy("bucket").applyInArrow(_answer, ANSWERS)


def shared_mask(prints: np.ndarray, buckets: int, table: pa.Table) -> np.ndarray:
    """From a chunk's answers: True for each of its sorted prints that another chunk has too."""
    at, out = bounds(prints, buckets), np.zeros(len(prints), bool)
    cols = columns(table)
    for b, bits in zip(cols["bucket"].to_pylist(), cols["bits"].to_pylist()):
        n = at[b + 1] - at[b]
        out[at[b] : at[b + 1]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=n).astype(bool)
    return out


def contains(sorted_: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(sorted_):
        return np.zeros(len(values), bool)
    return sorted_[np.minimum(np.searchsorted(sorted_, values), len(sorted_) - 1)] == values
