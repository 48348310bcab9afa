"""MinHash near-dedup with tensored banding.

A set of shingles is sketched by two collections of ``ROWS`` bands, each of ``HALF`` minhashes (Christiani, Fast
Locality-Sensitive Hashing Frameworks, 2019). A table's key joins a band of the first collection with one of the second, so
2 * ROWS * HALF minhashes make ROWS**2 tables with keys of 2 * HALF minhashes each; plain banding would need HALF * ROWS**2 * 2.
Two sets of similarity s share a key with a chance of (1 - (1 - s**HALF)**ROWS)**2: at 0.8 a pair is missed once in
ten million, at 0.3 it is compared once in twenty times.

Bands that no other document has can't be part of a shared key, so only documents that share a band of either collection
make keys at all. Sets of one key are candidates; links are decided on whole sets, as in ``jaccard_join``, which brings the
sets of a key together without pairing them all.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import jaccard_join as jj
from . import shared_prints as sp
from .rolling import U, mix

#: Minhashes of a band, and bands of a collection.
HALF, ROWS = 4, 32
#: Shingles that are hashed at once.
_AT_ONCE = 1 << 15


def minhashes(shingles: np.ndarray, sizes: np.ndarray, count: int, seed: int) -> np.ndarray:
    """(count, sets): the least of each set's shingles under ``count`` random orders; sets lie end to end and none is empty."""
    draw = np.random.Generator(np.random.PCG64(seed))
    factors, shifts = draw.integers(0, 2**64, count, dtype=U) | U(1), draw.integers(0, 2**64, count, dtype=U)
    out = np.empty((count, len(sizes)), U)
    ends = np.cumsum(sizes)
    begin = 0
    while begin < len(sizes):  # whole sets that fill the processor's cache, or one large set
        base = int(ends[begin] - sizes[begin])
        end = max(begin + 1, int(np.searchsorted(ends, base + _AT_ONCE, "right")))
        part, starts = shingles[base : int(ends[end - 1])], (ends - sizes)[begin:end] - base
        for i, (factor, shift) in enumerate(zip(factors, shifts)):
            out[i, begin:end] = np.minimum.reduceat((part ^ shift) * factor, starts)
        begin = end
    return out


def bands(shingles: np.ndarray, sizes: np.ndarray, half: int, rows: int) -> np.ndarray:
    """(2 * rows, sets): hash of each band; the first ``rows`` are the first collection's."""
    least = minhashes(shingles, sizes, 2 * rows * half, 17).reshape(2 * rows, half, len(sizes))
    out = mix(np.broadcast_to(np.arange(2 * rows, dtype=U)[:, None], (2 * rows, len(sizes))).copy(), 41)
    for j in range(half):
        out = mix(out ^ least[:, j])
    return out


def tensored(first: np.ndarray, second: np.ndarray, on_first: np.ndarray, on_second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """48-bit key and set of each pair of bands that are ``on``; all arrays (rows, sets)."""
    keys, owners = [], []
    for band, on in zip(first, on_first):
        pair, at = np.nonzero(on_second & on)
        keys.append(mix(band[at] + mix(second[pair, at], 43)) >> U(64 - sp.BITS))
        owners.append(at)
    return np.concatenate(keys), np.concatenate(owners)


class Signer:
    """Candidate keys for ``jaccard_join.shingle_sets``: bands go to the filter of shared ones, and shared ones are joined to keys."""

    def __init__(self, half: int, rows: int):
        self.half, self.rows = half, rows

    def prints(self, shingles: np.ndarray, sizes: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
        """48-bit print of each band of each set that isn't empty, and the set; band by band."""
        full = np.flatnonzero(sizes)
        own = bands(shingles, sizes[full], self.half, self.rows) >> U(64 - sp.BITS)
        return own.ravel(), np.tile(full, 2 * self.rows)

    def keys(self, prints: np.ndarray, owners: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Keys and sets, from what ``prints`` gave and which of them are shared."""
        prints, on = prints.reshape(2 * self.rows, -1), on.reshape(2 * self.rows, -1)
        keys, at = tensored(prints[: self.rows], prints[self.rows :], on[: self.rows], on[self.rows :])
        return keys, owners[: prints.shape[1]][at]


def link_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, half: int = HALF, rows: int = ROWS, chunks: int | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (smallest doc_id that links reach, itself included), kept; one row for each input row.

    Words, sets, links, nulls, empty texts, ties, repeated ids and empty tables as in ``jaccard_join.link_documents``. ``kept``:
    the row is its component's first, by id and then by the hash of its text; rows equal in both are all kept alike. A row
    without id is its own component unless a link reaches an id.

    ``half`` and ``rows``: minhashes of a band, bands of a collection. ``chunks``: tasks that the corpus is dealt to.
    """
    linked = jj.linked_rows(docs, id_col, text_col, n, num, den, chunks, Signer(half, rows))
    real = lambda c: F.when(F.col(c) != (1 << 63) - 1, F.col(c))
    kept = (F.col("first.ord") == F.col("ord")) & (F.col("first.text_hash") == F.col("text_hash"))
    return linked.select(real("ord").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), real("first.ord").alias("component_id"), kept.alias("kept"))
