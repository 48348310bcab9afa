"""Cross-entropy difference scores: how much likelier a document is under a target model than under a background model.

Both are bigram models with Witten-Bell smoothing over one vocabulary: every word of the whole corpus, one class for words
that none holds, and one for the start of a text. The background is every document, the target the good ones.

The corpus is dealt to chunks. A chunk sends what it counts of its distinct bigrams to buckets by hash; a bucket adds up and
answers each chunk for the bigrams that others hold too, and names one of the chunks as owner, so that distinct followers of
a word are counted once. Counts of words go the same way. So a task holds one chunk or one bucket, whatever the vocabulary,
and a very common word or pair arrives once a chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_prints as sp
from goldpan.scratch import written

from .common import id_text, text_bytes
from .rolling import SPACED, U, Words, keyed, laid_out, mix, slices
from .shared_prints import contains

#: Target ids up to which they are sent to all tasks (8 MB); more are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Stand for the start of a text and for words outside a bounded vocabulary.
START, OTHER = mix(np.array([1, 2], U), 31)
_COUNTS = "bucket int, chunk int, data binary"
_SUMS = "chunk int, bucket int, data binary, words long, n_all long, n_target long"


def word_counts(texts: DataFrame) -> DataFrame:
    """word (64-bit hash of the word, A-Z in lower case) and n over all texts."""

    def count(batches):
        for batch in batches:
            found = [Words(*laid_out(batch.column("text"), a, b), SPACED, lower=True).hash for a, b in slices(batch.column("text"), 8 << 20)]
            words, n = np.unique(np.concatenate(found or [np.zeros(0, U)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    return texts.select("text").mapInArrow(keyed(count), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _packed(*arrays: np.ndarray) -> bytes:
    """Counts or hashes, each array with as many bytes a value as its largest needs."""
    out = []
    for x in arrays:
        width = next(w for w in (1, 2, 4, 8) if int(x.max(initial=0)) < 1 << 8 * w)
        out += [bytes([width]), len(x).to_bytes(8, "little"), x.astype(f"<u{width}").tobytes()]
    return b"".join(out)


def _unpacked(blob: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(blob):
        width, n = blob[at], int.from_bytes(blob[at + 1 : at + 9], "little")
        out.append(np.frombuffer(blob, f"<u{width}", n, at + 9))
        at += 9 + width * n
    return out


def _bounds(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's keys begin in sorted ones, and the end."""
    return np.append(np.searchsorted(keys, np.array([(b << 64) // buckets for b in range(buckets)], U)), len(keys))


def _messages(chunk: int, keys: np.ndarray, counts: list[np.ndarray], buckets: int) -> pa.Table:
    at = _bounds(keys, buckets)
    full = np.flatnonzero(np.diff(at))
    return pa.table({
        "bucket": pa.array(full.astype(np.int32)), "chunk": pa.array(np.full(len(full), chunk, np.int32)),
        "data": pa.array([_packed(*(x[at[b] : at[b + 1]] for x in (keys, *counts))) for b in full], pa.binary()),
    })


def _sum(table: pa.Table) -> pa.Table:
    """A bucket's answers: which keys of a chunk others hold too, their sums, and which of their counts it owns; and totals of the bucket."""
    cols = sp.columns(table.sort_by("chunk"))
    parts = [_unpacked(b) for b in cols["data"].to_pylist()]
    keys, *counts = (np.concatenate([p[i] for p in parts]) for i in range(len(parts[0])))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.diff(np.append(starts, len(keys)))
    shared = np.empty(len(keys), bool)
    shared[order] = np.repeat(times > 1, times)
    sums, owned, first_sums = [], [], []
    for x in counts:
        x = x.astype(np.int64)[order]
        total = np.add.reduceat(x, starts)
        first = np.minimum.reduceat(np.where(x > 0, np.arange(len(x)), len(x)), starts)
        own = np.zeros(len(x) + 1, np.uint8)
        own[first] = 1
        back, mine = np.empty(len(x), np.int64), np.empty(len(x), np.uint8)
        back[order], mine[order] = np.repeat(total, times), own[:-1]
        sums.append(back)
        owned.append(mine)
        first_sums.append(total)
    out, begin = [], 0
    for p in parts:
        end = begin + len(p[0])
        on = shared[begin:end]
        out.append(_packed(np.packbits(on), *(x[begin:end][on] for x in (*sums, *owned))))
        begin = end
    n = len(out)
    only_first = lambda v: pa.array([int(v)] + [None] * (n - 1), pa.int64())
    return pa.table({
        "chunk": cols["chunk"], "bucket": cols["bucket"], "data": pa.array(out, pa.binary()),
        "words": only_first(np.count_nonzero(first_sums[0])), "n_all": only_first(first_sums[0].sum()), "n_target": only_first(first_sums[1].sum()),
    })


def _answered(keys: np.ndarray, counts: list[np.ndarray], buckets: int, answers: pa.Table) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Counts over all chunks, and whether this one owns them, from its own counts and the answers of the buckets."""
    at, sums, owned = _bounds(keys, buckets), [x.astype(np.int64) for x in counts], [x > 0 for x in counts]
    cols = sp.columns(answers)
    for b, data in zip(cols["bucket"].to_pylist(), cols["data"].to_pylist()):
        bits, *values = _unpacked(data)
        on = at[b] + np.flatnonzero(np.unpackbits(bits.astype(np.uint8), count=at[b + 1] - at[b]))
        for i, x in enumerate(values):
            (sums + owned)[i][on] = x
    return sums, owned


class Bigrams:
    """Words of a chunk's texts, each after its history, and the chunk's distinct bigrams and words with counts over all and target texts."""

    def __init__(self, cols: dict, vocabulary: np.ndarray | None):
        """vocabulary: sorted hashes; all words if not given."""
        found = [Words(*laid_out(cols["text"], begin, end), SPACED, lower=True) for begin, end in slices(cols["text"])]
        self.word = np.concatenate([w.hash for w in found])
        #: Number of words of each text.
        self.counts = np.concatenate([w.counts for w in found])
        if vocabulary is not None:
            self.word = np.where(contains(vocabulary, self.word), self.word, OTHER)
        history = np.empty_like(self.word)
        history[1:] = self.word[:-1]
        history[(np.cumsum(self.counts) - self.counts)[self.counts > 0]] = START
        chosen = np.repeat(sp.numbers(cols["target"]), self.counts)
        #: Bigrams by hash; ``of``: which one each word makes.
        self.keys, first, self.of = np.unique(mix(mix(history, 21) + self.word, 22), return_index=True, return_inverse=True)
        tally = lambda at, n: [np.bincount(at, minlength=n), np.bincount(at[chosen], minlength=n)]
        self.seen = tally(self.of, len(self.keys))
        self.words = np.unique(np.append(self.word[first], START)) if len(first) else self.word
        #: The word and the history of each bigram, as places in ``words``.
        self.last, self.before = (np.searchsorted(self.words, x[first]) for x in (self.word, history))
        self.tokens = [np.bincount(self.last, s, len(self.words)).astype(np.int64) for s in self.seen]
        self.followed = [np.bincount(self.before, s, len(self.words)).astype(np.int64) for s in self.seen]

    def word_columns(self, owned: list[np.ndarray]) -> list[np.ndarray]:
        """Of each word: how often it stands, how often a word follows, and how many kinds of owned bigrams follow; each over all and over target texts."""
        return [*self.tokens, *self.followed, *(np.bincount(self.before, o, len(self.words)).astype(np.int64) for o in owned)]


def score(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: int | None = None, chunks: int | None = None) -> DataFrame:
    """doc_id, n_tokens, target_bits, background_bits (per-token cross-entropies) and score (their difference; lower is closer to the target).

    The target is every document that ``labels`` give quality 1 (for ids labelled twice the lower quality counts). Words and
    bigrams of all texts are in the models; a ``vocabulary`` makes one class of all but that many most frequent words. One
    row for each input row; null texts and texts without words have null scores. Without any target the target model is
    uniform. Null ids are never targets. No rows give no rows.

    ``chunks``: tasks that the corpus is dealt to, by its size if not given.
    """
    texts = id_text(docs, id_col, text_col)
    chunks = chunks or sp.chunk_count(text_bytes(texts))
    kept = None
    if vocabulary is not None:
        kept = np.sort(written(word_counts(texts), "word-counts").orderBy(F.desc("n"), "word").limit(vocabulary).toArrow().column("word").to_numpy().view(U))
    good = written(
        labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1").select(F.col("doc_id").cast("long").alias("t_id")), "target-ids"
    )
    marked = texts.join(F.broadcast(good) if good.count() <= BROADCAST_IDS else good, F.col("doc_id") == F.col("t_id"), "left")
    deal = F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(chunks)).cast("int")
    dealt = marked.select(deal.alias("chunk"), "doc_id", "text", F.col("t_id").isNotNull().alias("target"))

    def send(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        own = Bigrams(cols, kept)
        return _messages(cols["chunk"][0].as_py(), own.keys, own.seen, chunks)

    def send_words(table: pa.Table, answers: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        own = Bigrams(cols, kept)
        _, owned = _answered(own.keys, own.seen, chunks, answers)
        return _messages(cols["chunk"][0].as_py(), own.words, own.word_columns(owned), chunks)

    pairs = written(dealt.groupBy("chunk").applyInArrow(keyed(send), _COUNTS).groupBy("bucket").applyInArrow(_sum, _SUMS), "bigram-sums").select("chunk", "bucket", "data")
    words = written(dealt.groupBy("chunk").cogroup(pairs.groupBy("chunk")).applyInArrow(keyed(send_words), _COUNTS).groupBy("bucket").applyInArrow(_sum, _SUMS), "word-sums")
    kinds, *totals = (x or 0 for x in words.agg(F.sum("words"), F.sum("n_all"), F.sum("n_target")).first())
    width = (kinds if kept is None else len(kept)) + 2

    def rate(table: pa.Table, answers: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        own = Bigrams(cols, kept)
        of_words = sp.numbers(answers.column("of_words")).astype(bool)
        seen, owned = _answered(own.keys, own.seen, chunks, answers.filter(pa.array(~of_words)))
        known, _ = _answered(own.words, own.word_columns(owned), chunks, answers.filter(pa.array(of_words)))
        text, n, bits = np.repeat(np.arange(len(own.counts)), own.counts), own.counts, []
        for i in (1, 0):
            tokens, followed, follow = known[i], known[2 + i], known[4 + i]
            base = ((tokens + 1.0) / (totals[i] + width))[own.last]
            follow, followed = follow[own.before], followed[own.before]
            p = np.where(follow > 0, (seen[i] + follow * base) / np.maximum(followed + follow, 1), base)
            bits.append(pa.array(np.bincount(text, -np.log2(p)[own.of], len(n)) / np.maximum(n, 1), mask=n == 0))
        return pa.table({"doc_id": cols["doc_id"], "n_tokens": pa.array(n.astype(np.int64)), "target_bits": bits[0], "background_bits": bits[1]})

    answers = pairs.withColumn("of_words", F.lit(False)).unionByName(words.select("chunk", "bucket", "data").withColumn("of_words", F.lit(True)))
    rated = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(keyed(rate), "doc_id long, n_tokens long, target_bits double, background_bits double")
    return rated.withColumn("score", F.col("target_bits") - F.col("background_bits"))
