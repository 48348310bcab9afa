"""Benchmark decontamination by winnowing.

Of each window of ``words`` consecutive words the least k-gram hash is its fingerprint. A shared window has the same
fingerprint in a document and in an item, so a join on fingerprints finds every one; hits are then extended word by word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.scratch import lookup, written
from .rolling import ALNUM, U, Words, fixed_windows, grams, keyed, laid_out, mix, prefix, sliding_min, slices

#: Bits of the filter that tells which document fingerprints can match at all: 4 MB, whatever the number of items.
FILTER_BITS = 1 << 25
_SCHEMA = "{key} long, text_hash long, n_words long, pos int, m int, fh long, ctx array<long>"


def _fingerprints(words: Words, size: int, k: int, short: tuple[int, ...], wanted, missing: int):
    """Yield (m, position, text, fingerprint, context) arrays; ``wanted`` keeps fingerprints, ``short`` has other window sizes."""
    counts, h = words.counts, words.hash
    sums, text_of = prefix(h), np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    w = size - k + 1
    g = grams(sums, k)
    least = sliding_min(g, w)
    ok = fixed_windows(counts, size)[: len(least)]
    at = np.flatnonzero(ok[: len(least)])
    at = at[wanted(least[at], size)]
    if len(at):
        near = np.stack([g[at + j] for j in range(w)])
        p = np.unique(at + near.argmin(axis=0))
        reach = np.arange(-(w - 1), k + w - 1)
        i = p[:, None] + reach
        first, last = (ends - counts)[text_of[p]][:, None], ends[text_of[p]][:, None]
        ctx = np.where((i >= first) & (i < last), h[np.clip(i, 0, len(h) - 1)], U(missing))
        yield size, p, text_of[p], g[p], ctx
    for m in short:
        if m < size and len(h) >= m:
            fit = np.flatnonzero(fixed_windows(counts, m)[: len(h) - m + 1])
            f = mix(grams(sums, m)[fit], m)
            hit = wanted(f, m)
            yield m, fit[hit], text_of[fit[hit]], f[hit], np.zeros((int(hit.sum()), 0), U)


def _scan(key: str, size: int, k: int, short, bits, whole_short: bool, missing: int):
    schema = pa.schema([(key, pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("pos", pa.int32()), ("m", pa.int32()), ("fh", pa.int64()), ("ctx", pa.list_(pa.int64()))])

    def scan(batches):
        filter_ = None if bits is None else bits.value
        def wanted(f, m):
            if filter_ is None:
                return np.ones(len(f), bool)
            i = f & U(FILTER_BITS - 1)
            return (filter_[(i >> U(3)).astype(np.int64)] >> (i & U(7)).astype(np.uint8) & 1).astype(bool)

        for batch in batches:
            texts, ids, hashes = batch.column("text"), batch.column(key), batch.column("text_hash")
            for begin, end in slices(texts):
                words = Words(*laid_out(texts, begin, end), ALNUM, lower=True)
                n = end - begin
                own_ids, own_hashes = ids.slice(begin, n), hashes.slice(begin, n)
                yield pa.RecordBatch.from_arrays([own_ids, own_hashes, pa.array(words.counts), *(pa.nulls(n, t) for t in (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())))], schema=schema)
                sizes = tuple(sorted({int(c) for c in words.counts if 0 < c < size})) if whole_short else short
                starts = np.cumsum(words.counts) - words.counts
                for m, p, text, fh, ctx in _fingerprints(words, size, k, sizes, wanted, missing):
                    if whole_short and m < size:  # of a short item only the whole of it is a window
                        on = words.counts[text] == m
                        p, text, fh, ctx = p[on], text[on], fh[on], ctx[on]
                    if len(p):
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * ctx.shape[1], pa.int32()), pa.array(ctx.ravel().view(np.int64)))
                        yield pa.RecordBatch.from_arrays([own_ids.take(pa.array(text)), own_hashes.take(pa.array(text)), pa.nulls(len(p), pa.int64()), pa.array((p - starts[text]).astype(np.int32)), pa.array(np.full(len(p), m, np.int32)), pa.array(fh.view(np.int64)), lists], schema=schema)

    return scan


def find_overlaps(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", size: int = 10, k: int = 8) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, spans (hit word ranges), items (sorted ids as strings): one row for each input row.

    Words are runs of digits, a-z and characters beyond ASCII, after A-Z are lower-cased. Each ``size`` consecutive words of
    an item are a window; an item with fewer words, but not none, is one window. Null texts have no words. A null item id
    counts as the empty string; repeated items and documents count once in lists and are answered each; null doc_ids are
    kept. Empty tables give no hits or no rows.

    Documents are read once. A filter of fixed size, built from the items by Spark, drops fingerprints that no item has
    inside the scan, so only possible hits are shuffled. Items with the same words around a fingerprint are one site, so
    a passage that many documents and many items hold is not paired out before it is extended. Sites are broadcast only if
    their count is small; else AQE splits hot fingerprints.
    """
    spark = docs.sparkSession
    text = lambda df, i, t, key: df.select(F.col(f"`{i}`").alias(key), F.coalesce(F.col(f"`{t}`").cast("string"), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    named = text(items, item_id_col, item_text_col, "item").withColumn("item", F.coalesce(F.col("item").cast("string"), F.lit("")))
    # Items go through the same scan under the hash of their text; ids are joined back, so that any type of id will do.
    seen = named.select("text", "text_hash", F.col("text_hash").alias("key")).distinct()
    found = written(seen.mapInArrow(keyed(_scan("key", size, k, (), None, True, 1)), _SCHEMA.format(key="key")).filter("pos is not null"), "item-prints")
    set_bits = found.select(F.pmod("fh", F.lit(FILTER_BITS)).alias("b")).groupBy(F.shiftright("b", 3).alias("byte")).agg(F.bit_or(F.expr("shiftleft(1, cast(b & 7 as int))")).alias("bits"))
    table = set_bits.toArrow()  # a row for each byte of the filter at most
    filter_ = np.zeros(FILTER_BITS // 8, np.uint8)
    filter_[table.column("byte").to_numpy()] = table.column("bits").to_numpy().astype(np.uint8)
    short = tuple(r["m"] for r in found.filter(F.col("m") < size).select("m").distinct().collect())  # sizes below ``size``
    sent = spark.sparkContext.broadcast(filter_)
    scanned = text(docs, id_col, text_col, "doc_id").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = written(scanned.mapInArrow(keyed(_scan("doc_id", size, k, short, sent, False, 0)), _SCHEMA.format(key="doc_id")), "doc-prints")

    ids = named.select(F.col("text_hash").alias("i_hash"), "item").distinct()
    sites = (
        found.select(F.col("fh").alias("s_fh"), F.col("m").alias("s_m"), F.col("ctx").alias("s_ctx"), F.col("key").alias("i_hash")).join(ids, "i_hash")
        .groupBy("s_fh", "s_m", "s_ctx").agg(F.collect_set("item").alias("site_items"))
    )
    hits = rows.filter("pos is not null").dropDuplicates(["doc_id", "text_hash", "pos", "m"]).join(lookup(written(sites, "item-sites")), (F.col("fh") == F.col("s_fh")) & (F.col("m") == F.col("s_m")))
    same = lambda i: F.get("ctx", F.lit(i)) == F.get("s_ctx", F.lit(i))
    w = size - k
    left = right = F.lit(0)
    for i in range(w):  # from the outermost word in: a word counts if all words between it and the k-gram match
        left = F.when(same(i), left + 1).otherwise(0)
        right = F.when(same(w + k + w - 1 - i), right + 1).otherwise(0)
    core = F.lit(True)
    for i in range(w, w + k):
        core = core & same(i)
    long = F.col("m") == size
    start = F.when(long, F.col("pos") - left).otherwise(F.col("pos"))
    end = F.when(long, F.col("pos") + k + right).otherwise(F.col("pos") + F.col("m"))
    spans = hits.filter(~long | core).select("doc_id", "text_hash", start.alias("start"), end.alias("end"), "m", "site_items").filter(F.col("end") - F.col("start") >= F.col("m"))
    by_doc = spans.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("site_items")))).alias("items"))
    by_doc = by_doc.select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"), "spans", "items")
    out = rows.filter("pos is null").join(by_doc, F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("text_hash") == F.col("h_hash")), "left")
    n_hit = F.expr(
        "aggregate(spans, named_struct('total', 0L, 'reach', 0), (a, s) -> named_struct("
        "'total', a.total + greatest(0, s.end - greatest(s.start, a.reach)), 'reach', greatest(a.reach, s.end)), a -> a.total)"
    )
    return out.select("doc_id", "text_hash", "n_words", F.coalesce(n_hit, F.lit(0)).cast("long").alias("n_hit"), "spans", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` that hold no window of any item, with their columns."""
    hit = find_overlaps(docs, items, id_col=id_col, text_col=text_col, **options).filter("n_hit > 0").select(F.col("doc_id").alias("h_id"), F.col("text_hash").alias("h_hash"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("hash"))
    return keyed.join(hit, F.col("id").eqNullSafe(F.col("h_id")) & (F.col("hash") == F.col("h_hash")), "left_anti").select("row.*")
