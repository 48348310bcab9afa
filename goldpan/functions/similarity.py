"""Similarity of strings on the scale of 0 to 1, as Arrow UDFs over bit-parallel common subsequences."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, a machine word at a time (Hyyrö 2004)."""
    if len(a) < len(b):
        a, b = b, a
    where: dict[str, int] = {}
    for i, c in enumerate(b):
        where[c] = where.get(c, 0) | 1 << i
    row = mask = (1 << len(b)) - 1
    for c in a:
        hit = row & where.get(c, 0)
        row = (row + hit | row - hit) & mask
    return len(b) - row.bit_count()


def indel(a: str, b: str) -> float:
    """1 less the share of insertions and deletions that turn one string into the other."""
    total = len(a) + len(b)
    return 2 * _common(a, b) / total if total else 1.0


def _token_sort(a: str | None, b: str | None) -> float:
    return indel(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) if a and b else 0.0


def _partial(a: str | None, b: str | None) -> float:
    """Best ratio of the shorter string with a window of the longer one, windows at the edges included."""
    if not a or not b:
        return 0.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    if short in long:
        return 1.0
    n = len(short)
    windows = {long[max(0, i) : i + n] for i in range(1 - n, len(long))}
    return max(indel(short, w) for w in windows if w)


def _token_set(a: str | None, b: str | None) -> float:
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    both, rest_x, rest_y = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not rest_x or not rest_y):
        return 1.0
    left, right = f"{both} {rest_x}".strip(), f"{both} {rest_y}".strip()
    return max(indel(left, right), indel(both, left) if both else 0.0, indel(both, right) if both else 0.0)


#: Pairs of strings that a worker remembers for each similarity.
_REMEMBERED = 1 << 16


def _pairwise(f):
    @F.pandas_udf(DoubleType())
    def similarity(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = lru_cache(_REMEMBERED)(f)
        for a, b in batches:
            yield pd.Series([1.0 if x and x == y else known(x, y) for x, y in zip(a, b)], dtype=float)

    return similarity


token_sort_ratio, partial_ratio, token_set_ratio = _pairwise(_token_sort), _pairwise(_partial), _pairwise(_token_set)


def register(spark: SparkSession) -> None:
    """Make the three similarities callable in SQL."""
    for name, f in (("token_sort_ratio", token_sort_ratio), ("partial_ratio", partial_ratio), ("token_set_ratio", token_set_ratio)):
        spark.udf.register(name, f)
