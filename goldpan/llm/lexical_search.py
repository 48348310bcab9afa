"""Ranked lexical search by NRA (Fagin, Lotem and Naor 2003): sequential reads of impact-sorted lists, without random access.

Documents are dealt to shards by hash, so a task holds the lists of one shard, however many documents hold a term. In a
shard each term's list is sorted by impact. An item's lists are read in steps; each document met has a lower bound (what is
read of it) and an upper bound (that, and the last impact read of each list in which it has not been met). Reading ends
when the first ``k`` documents are known with their whole scores and no other document, met or not, can reach them or tie. Then
the first ``k`` of all shards are ranked.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from goldpan.scratch import release, written

from . import shared_prints as sp
from .common import text_bytes
from .rolling import ALNUM, Words, keyed, laid_out, slices

#: Items that are searched in one pass over the documents, and bytes of their texts: the pass sends their terms to all tasks.
PASS_ITEMS, PASS_BYTES = 10_000, 8 << 20
#: Entries that the first step reads of each list; each further step reads four times as many.
FIRST_READ = 128
#: Bytes of a shard's texts; small corpora are dealt to more tasks.
SHARD_BYTES = 32 << 20
_POSTINGS = "doc_id long, text_hash long, n long, terms array<long>, times array<long>"
_HITS = "item long, doc_id long, text_hash long, score long"


def words_of(texts, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term of texts, and the number of terms of each text."""
    words = Words(*laid_out(texts, begin, end), ALNUM, lower=True)
    return words.hash.view(np.int64), words.counts


def _postings(wanted: np.ndarray | None):
    """doc_id, text_hash, n, and the distinct terms of each text with their occurrences; only ``wanted`` (sorted) terms if given."""
    arrow = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])

    def read(batches):
        for batch in batches:
            for begin, end in slices(batch.column("text")):
                terms, counts = words_of(batch.column("text"), begin, end)
                owner = np.repeat(np.arange(end - begin), counts)
                if wanted is not None:
                    on = sp.contains(wanted, terms)
                    terms, owner = terms[on], owner[on]
                order = np.lexsort((terms, owner))
                terms, owner = terms[order], owner[order]
                first = np.flatnonzero(np.append(True, (terms[1:] != terms[:-1]) | (owner[1:] != owner[:-1]))) if len(terms) else np.zeros(0, np.int64)
                offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(owner[first], minlength=end - begin)))), pa.int32())
                rows = [batch.column(c).slice(begin, end - begin) for c in ("doc_id", "text_hash")]
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (terms[first], np.diff(np.append(first, len(terms))).astype(np.int64))]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(counts.astype(np.int64)), *lists], schema=arrow)

    return read


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Shard:
    """The lists of a shard by term: places of documents, impacts falling."""

    def __init__(self, cols: dict, weights: tuple[np.ndarray, np.ndarray], n_docs: int, n_words: int):
        #: Documents by id, so that a place tells which of two with one score is first; null ids are last.
        ids = cols["doc_id"].fill_null((1 << 63) - 1).to_numpy(zero_copy_only=False)
        hashes = sp.numbers(cols["text_hash"])
        self.order = np.lexsort((hashes, ids))
        place = np.empty(len(ids), np.int64)
        place[self.order] = np.arange(len(ids))
        # In Python's integers, as 90 * n * N passes 64 bits on a large corpus.
        m = np.array([10 + 90 * n * n_docs // n_words for n in cols["n"].to_pylist()], np.int64)
        sizes = np.diff(cols["terms"].offsets.to_numpy())
        terms, tf = (sp.numbers(cols[c].flatten()) for c in ("terms", "times"))
        doc = np.repeat(np.arange(len(ids)), sizes)
        known, of_term = weights
        w = of_term[np.searchsorted(known, terms)]
        impact = w * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
        order = np.lexsort((place[doc], -impact, terms))
        self.docs, self.impacts, terms = place[doc][order], impact[order], terms[order]
        self.size = len(ids)
        self.terms, starts = np.unique(terms, return_index=True)
        self.starts = np.append(starts, len(terms))

    def lists(self, terms: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of the terms that the shard holds."""
        at = np.searchsorted(self.terms, terms[sp.contains(self.terms, terms)])
        return [(self.docs[a:b], self.impacts[a:b]) for a, b in zip(self.starts[at].tolist(), self.starts[at + 1].tolist())]


def first_by_score(lists: list[tuple[np.ndarray, np.ndarray]], size: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` documents of the highest sums above 0, equal ones by place, of lists with falling impacts; ``size``: places there are."""
    lists = [x for x in lists if len(x[0])]
    lower, met, beaten = np.zeros(size, np.int64), np.zeros((size, len(lists)), bool), np.zeros(size, bool)
    last = np.array([impacts[0] for _, impacts in lists], np.int64)
    done, step = 0, FIRST_READ
    while last.any():
        for i, (docs, impacts) in enumerate(lists):
            if last[i]:
                read = slice(done, done + step)
                lower[docs[read]] += impacts[read]
                met[docs[read], i] = True
                last[i] = impacts[done + step - 1] if done + step < len(docs) else 0  # a list that ends adds no more
        done, step = done + step, step * 4
        seen = np.flatnonzero((lower > 0) & ~beaten)
        if len(seen) < k:
            continue
        least = np.partition(lower[seen], len(seen) - k)[len(seen) - k]
        upper = lower[seen] + (~met[seen]) @ last
        # Bounds only draw nearer to each other: who can't reach the k-th lower bound now never will.
        out = upper < least
        beaten[seen[out]] = True
        # Members, ties and scores are resolved if none that wasn't met can come in and the bounds of all that may be among the first meet.
        if int(last.sum()) < least and (upper[~out] == lower[seen[~out]]).all():
            break
    seen = np.flatnonzero((lower > 0) & ~beaten)
    best = seen[np.argsort(-lower[seen], kind="stable")[:k]]
    return best, lower[best]


def _search(items: list[np.ndarray], numbers: list[int], weights, n_docs: int, n_words: int, k: int):
    def search(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        shard, out = Shard(cols, weights, n_docs, n_words), [[np.zeros(0, np.int64)] * 3]
        for number, terms in zip(numbers, items):
            if lists := shard.lists(terms):
                places, scores = first_by_score(lists, shard.size, k)
                out.append([np.full(len(places), number), shard.order[places], scores])
        item, row, score = (np.concatenate(x) for x in zip(*out))
        rows = pa.array(row.astype(np.int64))
        return pa.table({"item": pa.array(item, pa.int64()), "doc_id": cols["doc_id"].take(rows), "text_hash": cols["text_hash"].take(rows), "score": pa.array(score, pa.int64())})

    return search


def _first_hits(hits: DataFrame, k: int) -> DataFrame:
    by = [F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("text_hash")]
    return hits.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*by))).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", k: int = 10, shards: int | None = None) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` documents of the highest score above 0 for each item, equal scores by ascending doc_id.

    Terms are runs of digits, letters and characters beyond ASCII, A-Z in lower case; the score is the integer one of
    ``weight`` and ``Shard``, summed over an item's distinct terms. Null and empty texts have no terms: such documents are in no
    list and in no count, such items get no rows. Null doc_ids come after all others, rows that repeat an id are documents
    of their own (equal scores then by the hash of the text). Rows that repeat an item_id are items of their own; null
    item_ids are kept. Empty tables give no rows.

    Documents are read once for each pass of ``PASS_ITEMS`` items, and only the passed items' terms leave the scan. ``shards``:
    tasks that the corpus is dealt to, by its size if not given.
    """
    text = lambda df, c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text(docs, text_col).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    asked = written(items.select(F.col(f"`{item_id_col}`").alias("item_id"), text(items, item_text_col).alias("text")).withColumn("at", F.monotonically_increasing_id()), "search-items")
    size = text_bytes(texts)
    shards = shards or max(-(-size // SHARD_BYTES), min(16, 1 + (size >> 20)))
    passes, hits, totals = _passes(asked), [], None
    for items_ in passes:
        # What comes back to the driver is one bounded pass.
        found = items_.select(F.col("at").alias("doc_id"), "text", F.lit(0).cast("long").alias("text_hash")).mapInArrow(keyed(_postings(None)), _POSTINGS).select("doc_id", "terms").toArrow()
        numbers, terms = found.column("doc_id").to_pylist(), [np.array(x, np.int64) for x in found.column("terms").to_pylist()]
        wanted = np.unique(np.concatenate(terms or [np.zeros(0, np.int64)]))
        rows = written(texts.mapInArrow(keyed(_postings(wanted)), _POSTINGS).filter("n > 0"), "search-postings")
        totals = totals or rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()  # a row for each term of the pass at most
        order = np.argsort(df.column("term").to_numpy())
        of_term = np.array([weight(totals[0], d) for d in df.column("df").to_numpy()[order].tolist()], np.int64)
        task = _search(terms, numbers, (df.column("term").to_numpy()[order], of_term), *totals, k)
        dealt = rows.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(shards))).groupBy("shard").applyInArrow(task, _HITS)
        hits.append(written(_first_hits(dealt, k), "search-hits"))
        release(rows)
    if not hits:
        return asked.select("item_id", F.lit(1).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    out = hits[0]
    for more in hits[1:]:
        out = out.unionByName(more)
    return out.join(asked.select("at", "item_id"), F.col("item") == F.col("at")).select("item_id", "rank", "doc_id", "score")


def _passes(asked: DataFrame) -> list[DataFrame]:
    """The items in parts of bounded rows and bytes, by a hash of their numbers."""
    n, size = asked.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(-(-n // PASS_ITEMS), -(-size // PASS_BYTES))
    return [asked.filter(F.pmod(F.xxhash64("at"), F.lit(parts)) == i) for i in range(parts)]
