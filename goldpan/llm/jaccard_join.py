"""N-gram Jaccard join by PartEnum signatures.

A document is its set of shingles. Two sets of sizes a <= b with similarity t or more have a >= t * b, so with size bands
that grow by 1 / t they are in one band or in neighbouring ones, and differ in at most k = a * (1 - t) / t shingles. For each
band the domain of shingles is cut, by hash, into groups of a few partitions. There are enough groups that one of them
holds at most ``SLACK`` differing shingles; all but ``SLACK`` of its partitions then agree. So each set signs every choice of
all but ``SLACK`` partitions of each group, and similar sets share a signature. Shared signatures are only candidates: links
are decided on whole sets.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared_prints as sp
from goldpan.operators.components import connected_components
from goldpan.scratch import release, written

from .common import id_text, text_bytes
from .rolling import SPACED, U, Words, fixed_windows, grams, keyed, laid_out, mix, prefix, slices, spans

SLACK = 1
#: Sets of a hub that may meet at one shingle at once; more meet by rarity.
FEW = 8
_SETS = "ord long, text_hash long, n long, s1 long, s2 long, prints array<long>, shingles array<long>"


class Bands:
    """Size bands for a similarity of num / den: their borders, and the groups of each band's instance."""

    def __init__(self, num: int, den: int, most: int):
        #: Partitions of a group: with fewer differences a partition holds more shingles, and fewer signatures will do.
        self.parts = 3 if 100 * num >= 88 * den else 4
        self.choices = tuple(combinations(range(self.parts), self.parts - SLACK))
        self.low, self.diff, self.groups, self.spare = [1], [], [], []
        while True:
            low = self.low[-1]
            high = low * den // num
            k = high * (den - num) // num  # differing shingles of a pair whose smaller set is in this band
            need = k // (SLACK + 1) + 1
            per_choice = low * (self.parts - SLACK) / self.parts / need
            spare = 1 + int(np.ceil(1.5 * need * len(self.choices) * np.exp(-per_choice)))
            self.diff.append(k)
            self.spare.append(spare)
            self.groups.append(need + spare)
            if low > most:
                break
            self.low.append(high + 1)
        self.low, self.diff, self.groups, self.spare = map(np.array, (self.low, self.diff, self.groups, self.spare))


def signatures(shingles: np.ndarray, sizes: np.ndarray, bands: Bands, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit signature, set) of sets laid end to end, each in its own band's instance and in the one below."""
    out, owners, parts = [], [], bands.parts
    band = np.searchsorted(bands.low, sizes, "right") - 1
    of = np.repeat(np.arange(len(sizes)), sizes)
    place, value = mix(shingles, seed + 1), mix(shingles, seed + 2)
    for below in (0, 1):
        at = band - below
        on = (sizes > 0) & (at >= 0)
        on &= bands.diff[np.maximum(at, 0)] > 0  # no difference allowed: only equal sets, which are found by their hash
        cells = np.where(on, bands.groups[np.maximum(at, 0)] * parts, 0)
        first = np.cumsum(cells) - cells
        mine = on[of]
        own = of[mine]
        cell = first[own] + (place[mine] % cells[own].astype(U)).astype(np.int64)
        sums, counts = np.zeros(int(cells.sum()), U), np.zeros(int(cells.sum()), np.int64)
        np.add.at(sums, cell, value[mine])
        np.add.at(counts, cell, 1)
        set_of = np.repeat(np.arange(len(sizes)), cells // parts)
        group = np.arange(len(set_of)) - (first // parts)[set_of]
        key = mix(group.astype(U) + (at[set_of].astype(U) << U(32)), seed + 3)
        sums, counts = sums.reshape(-1, parts), counts.reshape(-1, parts)
        held = np.stack([counts[:, c].sum(axis=1) for c in map(list, bands.choices)], axis=1)
        # A group that a set leaves empty in some choice says little. With so many spare groups that one is always left
        # whose choices all hold shingles, the empty choices needn't be signed.
        poor = np.bincount(set_of, weights=(held == 0).any(axis=1), minlength=len(sizes))
        use = (held > 0) | (poor > bands.spare[np.maximum(at, 0)])[set_of][:, None]
        for i, choice in enumerate(bands.choices):
            signed = key + U(i + 1)
            for j in choice:
                signed = mix(signed ^ sums[:, j])
            out.append(signed[use[:, i]] >> U(64 - sp.BITS))
            owners.append(set_of[use[:, i]])
    return np.concatenate(out), np.concatenate(owners)


def _sets(texts, begin: int, end: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts, sorted in each, and their numbers."""
    words = Words(*laid_out(texts, begin, end), SPACED, lower=True)
    sums, counts = prefix(words.hash), words.counts
    at = np.flatnonzero(fixed_windows(counts, n)[: max(0, len(words.hash) - n + 1)])
    owner = np.repeat(np.arange(len(counts)), counts)
    short = np.flatnonzero((counts > 0) & (counts < n))
    ends = np.cumsum(counts)
    whole = mix(spans(sums, ends[short] - counts[short], ends[short]) + counts[short].astype(U), 5)
    values = np.concatenate((grams(sums, n)[at], whole))
    owner = np.concatenate((owner[at], short))
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    return values[new], np.bincount(owner[new], minlength=end - begin)


def _identity(shingles: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each set, by sums, so that order doesn't matter."""
    out = []
    for seed in (11, 12):
        total = np.concatenate((np.zeros(1, U), np.cumsum(mix(shingles, seed), dtype=U)))
        ends = np.cumsum(sizes)
        out.append(mix(total[ends] - total[ends - sizes], seed))
    return out


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(values.view(np.int64)))


def _largest(texts: pa.Array) -> int:
    return max(2, int(np.diff(np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]).max(initial=0)))


class Signer:
    """How sets get their keys: ``prints`` that go to the filter of shared ones, and the ``keys`` that shared prints make."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def prints(self, shingles: np.ndarray, sizes: np.ndarray, largest: int) -> tuple[np.ndarray, np.ndarray]:
        return signatures(shingles, sizes, Bands(self.num, self.den, largest), 0)

    def keys(self, prints: np.ndarray, owners: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return prints[on], owners[on]


def shingle_sets(texts: DataFrame, *, n: int, chunks: int, signer) -> DataFrame:
    """One row for each row of ``texts`` (doc_id, text): ord, text_hash, n, s1, s2 and, for the first of a set in its chunk and if other sets share any of its signatures, those and the shingles."""
    dealt = sp.chunked(texts, chunks)

    def each(cols: dict):
        largest = _largest(cols["text"])
        for begin, end in slices(cols["text"]):
            shingles, sizes = _sets(cols["text"], begin, end, n)
            yield begin, shingles, sizes, *signer.prints(shingles, sizes, largest)

    def send(table: pa.Table) -> pa.Table:
        cols = sp.columns(table)
        return sp.messages(cols["chunk"][0].as_py(), np.unique(np.concatenate([np.unique(p) for *_, p, _ in each(cols)])), chunks)

    def keep(table: pa.Table, answers: pa.Table) -> pa.Table:
        schema = pa.schema([(c, pa.int64()) for c in ("ord", "text_hash", "n", "s1", "s2")] + [(c, pa.list_(pa.int64())) for c in ("prints", "shingles")])
        if not table.num_rows:
            return schema.empty_table()
        cols = sp.columns(table)
        parts, prints, ids = [], [], []
        for begin, shingles, sizes, signed, owner in each(cols):
            s1, s2 = _identity(shingles, sizes)
            parts.append((begin, shingles, sizes, signed, owner, s1, s2))
            prints.append(signed)
            ids.append(s1[owner])
        # Of rows with one set in this chunk the first by id speaks for all.
        ord_, two = sp.numbers(cols["ord"]), [np.concatenate([p[i] for p in parts]) for i in (5, 6)]
        by = np.lexsort((ord_, two[1], two[0]))
        speaks = np.ones(len(by), bool)
        speaks[by[1:]] = (two[0][by[1:]] != two[0][by[:-1]]) | (two[1][by[1:]] != two[1][by[:-1]])
        prints, ids = np.concatenate(prints), np.concatenate(ids)
        order = np.argsort(prints, kind="stable")
        known, first = np.unique(prints[order], return_index=True)
        shared = sp.shared_mask(known, chunks, answers)
        if len(known):
            shared |= np.minimum.reduceat(ids[order], first) != np.maximum.reduceat(ids[order], first)
        known, out = known[shared], []
        for begin, shingles, sizes, signed, owner, s1, s2 in parts:
            signed, owner = signer.keys(signed, owner, sp.contains(known, signed) & speaks[begin + owner])
            order = np.argsort(owner, kind="stable")
            counts = np.bincount(owner, minlength=len(sizes))
            wanted = np.repeat(counts > 0, sizes)
            rows = slice(begin, begin + len(sizes))
            out.append(pa.table({
                "ord": cols["ord"][rows], "text_hash": cols["text_hash"][rows], "n": pa.array(sizes.astype(np.int64)), "s1": pa.array(s1.view(np.int64)), "s2": pa.array(s2.view(np.int64)),
                "prints": _lists(signed[order], counts), "shingles": _lists(shingles[wanted], np.where(counts > 0, sizes, 0)),
            }, schema=schema))
        return pa.concat_tables(out)

    answers = sp.answers(dealt.groupBy("chunk").applyInArrow(keyed(send), sp.BLOBS))
    return written(dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(keyed(keep), _SETS), "shingle-sets")


def _by_rarity(each: DataFrame, sets: DataFrame, total: str, prefix: str) -> DataFrame:
    """hub, rep, i, x: the first ``prefix`` of the ``total`` shingles of each set, those that few sets of the hub have first; i counts those that no other has, which aren't given."""
    common = each.groupBy("hub", "x").agg(F.count("*").alias("c")).filter("c > 1")
    placed = each.join(common, ["hub", "x"]).groupBy("hub", "rep").agg(F.sort_array(F.collect_list(F.struct("c", "x"))).alias("order"))
    placed = placed.join(sets, ["hub", "rep"]).withColumn("lone", F.col(total) - F.size("order")).filter(f"lone < {prefix}")
    return placed.select("hub", "rep", "lone", F.posexplode(F.expr(f"slice(order, 1, {prefix} - lone).x")).alias("at", "x")).select("hub", "rep", (F.col("lone") + F.col("at")).alias("i"), "x")


def _meetings(compared: DataFrame, found: DataFrame, *, num: int, den: int) -> DataFrame:
    """hub, b, c: sets of a hub that may link and aren't in one component. ``compared``: hub-differences; ``found``: node, component.

    A set that links to one of n shingles lacks fewer than q of these. A set is far from its hub if it adds q or more to it; of
    its first 2q - 1 additions a partner then has q, or all but q - 1 if there are fewer, and these are among the
    partner's first ones too. Shared additions that few sets of the hub have are counted for each pair; if many have one, all
    of these sets meet by their additions in order of rarity. Sets that aren't far meet by additions and lacks in
    order of rarity, of which both need one among the first few, as the differences of two that link differ in few
    shingles themselves, and one of them isn't small.

    Before all that, differences from the hub that a set shares with no other one are counted: a pair differs in all of them, so
    copies that were each edited in places of their own drop out without meeting.
    """
    share = (den - num) / (den + num)  # sets of sizes n and m link if they differ in share * (n + m) shingles at most
    a, size = F.size("adds"), F.size("adds") + F.size("lacks")
    # A set that links to one of size n has num * n / den to den * n / num shingles, and a difference as large as its own but for reach.
    reach = share * F.col("n") * (1 + den / num) + 1e-9
    room = size - (size - share * F.greatest(F.lit(0), F.col("n") - F.col("hub_n"))) / 2 + 1e-9  # as an unlinked partner's difference isn't small
    first = F.floor(reach).cast("int") + 1
    first = F.when(F.col("linked"), F.least(first, F.floor(room).cast("int") + 1)).otherwise(first)
    q = F.col("n") - F.ceil(num * F.col("n") / F.lit(den)) + 1
    named = compared.select("hub", "rep", "n", "linked", a.alias("a"), size.alias("s"), first.alias("first"), q.cast("int").alias("q"))
    labels = found.select(F.col("node").alias("rep"), "component")
    every = written(named.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")).withColumn("far", F.col("a") >= F.col("q")), "open-sets")
    # What no other open set of the hub adds or lacks sets a pair apart, whoever the partner is.
    each = compared.select("hub", "rep", F.explode(F.concat("adds", "lacks")).alias("x"))
    alone = each.groupBy("hub", "x").agg(F.count("*").alias("c"), F.min("rep").alias("rep")).filter("c = 1").groupBy("hub", "rep").agg(F.count("*").alias("alone"))
    sets = every.join(alone, ["hub", "rep"], "left").withColumn("alone", F.coalesce("alone", F.lit(0)))
    sets = written(sets.filter(F.col("alone") <= reach), "hopeful-sets")
    full = compared.select("hub", "rep", "adds", "lacks").join(sets.select("hub", "rep", "q", "far"), ["hub", "rep"])

    def side(rows: DataFrame, k: str) -> DataFrame:
        return rows.join(sets, ["hub", "rep"]).select("hub", "x", *[F.col(c).alias(f"{c}{k}") for c in ("rep", "i", "component", "n", "a", "s", "q", "linked", "far", "alone")])

    # The first shingle that both have, and those after it.
    behind = lambda total: F.least(F.col(f"{total}b") - F.col("ib"), F.col(f"{total}c") - F.col("ic"))
    may = share * (F.col("nb") + F.col("nc")) + 1e-9
    apart = F.expr("repb < repc and componentb <> componentc") & (F.col("aloneb") + F.col("alonec") <= may)
    overlap = (behind("a") + F.least(F.col("nb") - F.col("ab"), F.col("nc") - F.col("ac"))) * (num + den) >= num * (F.col("nb") + F.col("nc"))
    pair = ["hub", F.col("repb").alias("b"), F.col("repc").alias("c")]

    def counted(rows: DataFrame) -> DataFrame:
        met = side(rows, "b").join(side(rows, "c"), ["hub", "x"]).filter(apart & (F.col("farb") | F.col("farc")))
        met = met.groupBy("hub", "repb", "repc", "nb", "nc", "ab", "ac", "qb", "qc").agg(F.min("ib").alias("ib"), F.min("ic").alias("ic"), F.count("*").alias("both"))
        least = F.least("qb", "qc", F.greatest(F.lit(1), F.col("ab") - F.col("qb") + 1, F.col("ac") - F.col("qc") + 1))
        return met.filter(overlap & (F.col("both") >= least)).select(*pair)

    def by_first(rows: DataFrame, enough) -> DataFrame:
        return side(rows, "b").join(side(rows, "c"), ["hub", "x"]).filter(apart & enough).select(*pair)

    some_far = sets.filter("far").select("hub").distinct()
    prefix = full.join(some_far, "hub", "left_semi").select("hub", "rep", F.posexplode(F.slice("adds", F.lit(1), 2 * F.col("q") - 1)).alias("i", "x"))
    times = prefix.groupBy("hub", "x").agg(F.count("*").alias("c")).filter("c > 1")
    shared = written(prefix.join(times, ["hub", "x"]), "shared-adds")
    met = counted(shared.filter(F.col("c") <= FEW).select("hub", "rep", "i", "x"))
    crowded = written(shared.filter(F.col("c") > FEW).select("hub", "rep").distinct(), "crowded-sets")
    each = full.join(crowded, ["hub", "rep"], "left_semi").select("hub", "rep", F.explode("adds").alias("x"))
    met = met.unionByName(by_first(written(_by_rarity(each, sets, "a", "q"), "rare-adds"), (F.col("farb") | F.col("farc")) & overlap))
    near = full.filter("not far").select("hub", "rep", F.explode(F.concat("adds", "lacks")).alias("x"))
    close = ~(F.col("linkedb") & F.col("linkedc")) & (2 * behind("s") >= F.col("sb") + F.col("sc") - may) & (F.abs(F.col("sb") - F.col("sc")) <= may)
    return met.unionByName(by_first(written(_by_rarity(near, sets, "s", "first"), "rare-differences"), close)).distinct()


def _hopeless(sets: DataFrame, *, num: int, den: int) -> DataFrame:
    """rep of each of ``sets`` (rep, n, shingles; once each) that links to no other of them, as too many of its shingles are in no other. Each shingle makes one row."""
    alone = sets.select("rep", "n", F.explode("shingles").alias("x")).groupBy("x").agg(F.count("*").alias("c"), F.min("rep").alias("rep"), F.min("n").alias("n")).filter("c = 1")
    return alone.groupBy("rep").agg(F.count("*").alias("alone"), F.min("n").alias("n")).filter(F.col("alone") * den > F.col("n") * (den - num)).select("rep")


def similar_sets(rows: DataFrame, *, num: int, den: int) -> DataFrame:
    """s1, s2 and first (ord and text_hash of the first row of its component) for each distinct set with a link to another; ``rows`` as of ``shingle_sets``, which is deleted on the way.

    Sets are numbered in the order of their first rows, as one ord may stand for several texts.

    Each set is compared with the first set (the hub) of each of its signatures, and links are noted. Two sets that share a
    signature share its hub, so all other links are between sets of one hub. Many hubs have one set beside them, or sets of one
    component, and need nothing more. Of the sets of the others most have too many shingles that no other of these has, and go
    before any two are compared. The rest are gathered under fewer hubs, as each hub gives way
    to its own first one, and what a set adds to it and lacks of it is kept; so a set of a large family is stored with a few hubs,
    not with all of its signatures'. Then sets meet as ``_meetings`` says. No pairs of a group are listed.
    """
    # The table of sets is narrow: signatures and shingles stay where they are and are read when they are needed.
    marked = rows.filter(F.size("prints") > 0)
    ids = marked.groupBy("s1", "s2", "n").agg(F.min(F.struct("ord", "text_hash")).alias("first"))
    at = ["ord", "text_hash", "s1", "s2"]
    chosen = written(ids.select("first.ord", "first.text_hash", "s1", "s2").orderBy(*at).withColumn("rep", F.monotonically_increasing_id()), "distinct-sets")
    keyed = marked.select(*at, "prints").join(chosen, at).select("rep", F.explode("prints").alias("key"))
    first = keyed.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("c")).filter("c > 1").select("key", "hub")
    shingles = marked.select(*at, "n", "shingles")

    def beside(pairs: DataFrame) -> DataFrame:
        """hub, rep, n, shingles, hub_n, hub_shingles. Numbers are turned back into rows first, so that shingles are shuffled once to be found and once more by hub."""
        reps = pairs.join(chosen, "rep").join(shingles, at).select("hub", "rep", "n", "shingles")
        hubs = pairs.select(F.col("hub").alias("rep")).distinct().join(chosen, "rep").join(shingles, at).select(F.col("rep").alias("hub"), F.col("n").alias("hub_n"), F.col("shingles").alias("hub_shingles"))
        return reps.join(hubs, "hub")

    linked = lambda adds: den * (F.col("n") - adds) >= num * (F.col("hub_n") + adds)
    tried = written(keyed.join(first, "key").filter("rep > hub").select("hub", "rep").distinct(), "hub-pairs")
    adds = F.size(F.array_except("shingles", "hub_shingles"))
    links = written(beside(tried).select("hub", "rep", "n", "hub_n", adds.alias("adds")).filter(linked(F.col("adds"))).select(F.col("hub").alias("a"), F.col("rep").alias("b")), "hub-links")
    found = written(connected_components(links), "set-components")

    labels = found.select(F.col("node").alias("rep"), "component")

    def of_open_hubs(pairs: DataFrame) -> DataFrame:
        """Pairs of the hubs that have sets of two components beside them. Asked of hubs, not of keys, of which two sets may share hundreds."""
        hubs = pairs.join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep")).groupBy("hub").agg(F.min("component").alias("least"), F.max("component").alias("most"))
        return pairs.join(hubs.filter("least < most").select("hub"), "hub", "left_semi")

    hopeless = written(_hopeless(of_open_hubs(tried).select("rep").distinct().join(chosen, "rep").join(shingles, at), num=num, den=den), "hopeless-sets")
    open_ = written(of_open_hubs(tried.join(hopeless, "rep", "left_anti").select("hub", "rep")), "open-pairs")
    first_of = tried.groupBy(F.col("rep").alias("hub")).agg(F.min("hub").alias("root"))
    open_ = written(open_.join(first_of, "hub", "left").select(F.coalesce("root", "hub").alias("hub"), "rep").distinct(), "open-pairs")
    release(tried)
    compared = beside(open_).select("hub", "rep", "n", "hub_n", F.array_except("shingles", "hub_shingles").alias("adds"), F.array_except("hub_shingles", "shingles").alias("lacks"))
    compared = written(compared.withColumn("linked", linked(F.size("adds"))), "hub-differences")
    release(rows)

    met = written(_meetings(compared, found, num=num, den=den), "met-pairs")
    side = lambda k: compared.select("hub", F.col("rep").alias(k), F.col("n").alias(f"n{k}"), F.col("adds").alias(f"a{k}"), F.col("lacks").alias(f"l{k}"))
    both = F.size(F.array_intersect("ab", "ac")) + F.size(F.array_intersect("lb", "lc"))
    apart = F.size("ab") + F.size("lb") + F.size("ac") + F.size("lc") - 2 * both
    near = met.join(side("b"), ["hub", "b"]).join(side("c"), ["hub", "c"]).filter((den + num) * apart <= (den - num) * (F.col("nb") + F.col("nc"))).select(F.col("b").alias("a"), F.col("c").alias("b"))
    new = written(near.unionByName(compared.filter("linked").select(F.col("hub").alias("a"), F.col("rep").alias("b"))).distinct(), "more-links")
    if not new.isEmpty():
        found = written(connected_components(links.unionByName(new)), "set-components")
    release(compared)
    of = found.join(chosen, F.col("node") == F.col("rep")).select("component", "s1", "s2", F.struct("ord", "text_hash").alias("row"))
    return of.join(of.groupBy("component").agg(F.min("row").alias("first")), "component").select("s1", "s2", "first")


def linked_rows(docs: DataFrame, id_col: str, text_col: str, n: int, num: int, den: int, chunks: int | None, signer=None) -> DataFrame:
    """ord, text_hash, n and first: ord and text_hash of the first row that links reach, itself included."""
    texts = id_text(docs, id_col, text_col)
    rows = shingle_sets(texts, n=n, chunks=chunks or sp.chunk_count(text_bytes(texts)), signer=signer or Signer(num, den))
    base = written(rows.select("ord", "text_hash", "n", "s1", "s2"), "set-rows")
    linked = written(similar_sets(rows, num=num, den=den), "linked-sets")
    row = F.struct("ord", "text_hash")
    classes = base.filter("n > 0").groupBy("s1", "s2").agg(F.min(row).alias("own")).join(linked, ["s1", "s2"], "left").select("s1", "s2", F.coalesce("first", "own").alias("first"))
    base = base.select("ord", "text_hash", "n", F.when(F.col("n") > 0, F.col("s1")).alias("s1"), F.col("s2"))
    return base.join(classes, ["s1", "s2"], "left").select("ord", "text_hash", "n", F.coalesce("first", row).alias("first"))


def link_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, chunks: int | None = None) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id (smallest doc_id that links reach, itself included), one row for each input row.

    Words stand between 0x20 and 0x09 to 0x0D, A-Z in lower case; a set has the distinct ``n``-word shingles of a whole text,
    or all its words as one if they are fewer. Sets link if den * intersection >= num * union. Null texts and texts
    without words have empty sets and link with nothing. A null doc_id is after all others; its component is null if it
    reaches no other. Rows that repeat a doc_id are documents of their own. No rows give no rows.

    Equal sets are one set from the start. ``chunks``: tasks that the corpus is dealt to, by its size if not given.
    """
    real = lambda c: F.when(F.col(c) != (1 << 63) - 1, F.col(c))
    rows = linked_rows(docs, id_col, text_col, n, num, den, chunks)
    return rows.select(real("ord").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), real("first.ord").alias("component_id"))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, num: int = 80, den: int = 100, chunks: int | None = None) -> DataFrame:
    """The row of ``docs`` with the smallest id of each component, with its columns; of rows equal in id and text one stays, of other texts of that id the one whose hash is smallest."""
    kept = linked_rows(docs, id_col, text_col, n, num, den, chunks).filter((F.col("first.ord") == F.col("ord")) & (F.col("first.text_hash") == F.col("text_hash"))).select(F.col("ord").alias("k_ord"), F.col("text_hash").alias("k_hash")).distinct()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    keyed = docs.select(row.alias("row"), F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit((1 << 63) - 1)).alias("id"), F.xxhash64(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("hash"))
    return keyed.join(kept, (F.col("id") == F.col("k_ord")) & (F.col("hash") == F.col("k_hash")), "left_semi").dropDuplicates(["id", "hash"]).select("row.*")
