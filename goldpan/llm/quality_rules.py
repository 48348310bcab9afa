"""Quality rules whose cutoffs carry a risk bound.

Each rule gives a document a score, higher being worse. A labelled holdout shows how many good documents the cutoffs of all
rules would reject together; an exact binomial test decides whether their true rate of false rejections is below the limit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldpan.scratch import lookup, written

SYMBOLS = "#*$%&|<>"
_UPPER = bytes(range(65, 91))
_COUNTS = ("n_words", "word_chars", "n_symbols", "n_upper", "n_bangs", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """score: of a column of features; grid: cutoffs from strict to lenient, fixed before any data is seen."""

    name: str
    top: str
    bottom: str
    grid: tuple[float, ...]


_SHARES = tuple(i / 64 for i in range(1, 65))
RULES = (
    Rule("symbol_share", "n_symbols", "word_chars", _SHARES),
    Rule("upper_share", "n_upper", "word_chars", _SHARES),
    Rule("bang_share", "n_bangs", "n_words", _SHARES),
    Rule("dup_line_share", "n_dup_lines", "n_lines", _SHARES),
    Rule("repeat_share", "n_repeat_words", "n_words", _SHARES),
    Rule("word_length", "word_chars", "n_words", tuple(4 + i / 4 for i in range(64))),
)


def _features(text: str) -> tuple[int, ...]:
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # of bytes: at 0x20 and 0x09 to 0x0D only
    blanks = sum(map(text.count, " \t\n\x0b\x0c\r"))
    lines = [x for x in data.split(b"\n") if x.strip()]
    repeats = 0
    if len(words) > 2:
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen: set = set()
            twice = {w for w in windows if w in seen or seen.add(w)}
            inside = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(np.fromiter((w in twice for w in windows), bool, len(windows)))
            np.add.at(inside, at, 1)
            np.add.at(inside, at + 3, -1)
            repeats = int((np.cumsum(inside[:-1]) > 0).sum())
    return (
        len(words), len(text) - blanks, sum(map(text.count, SYMBOLS)), len(data) - len(data.translate(None, _UPPER)),
        text.count("!"), len(lines), len(lines) - len(set(lines)), repeats,
    )


@F.pandas_udf(T.StructType([T.StructField(c, T.LongType()) for c in _COUNTS]))
def features(texts: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_features(t) for t in texts], columns=_COUNTS)


def _score(rule: Rule, counts: str) -> Column:
    top, bottom = F.col(f"{counts}.{rule.top}"), F.col(f"{counts}.{rule.bottom}")
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def _bins(counts: str) -> Column:
    """For each rule, how many cutoffs of its grid reject the document."""
    below = lambda score: lambda cut: cut < score
    return F.array(*[F.size(F.filter(F.array(*map(F.lit, r.grid)), below(_score(r, counts)))) for r in RULES])


def base_failed(counts: str) -> Column:
    """Fewer than 50 words, or more than half of the words in repeated windows."""
    return (F.col(f"{counts}.n_words") < 50) | (100 * F.col(f"{counts}.n_repeat_words") > 50 * F.col(f"{counts}.n_words"))


def binomial_cdf(x: int, n: int, p: float) -> float:
    """P(X <= x) for n trials with chance p, exactly summed."""
    if x >= n:
        return 1.0
    i = np.arange(1, x + 1, dtype=float)
    logs = np.concatenate(([0.0], np.cumsum(np.log((n - i + 1) / i) + np.log(p / (1 - p))))) + n * np.log1p(-p)
    return float(min(1.0, np.exp(logs).sum()))


def certified(rejected: np.ndarray, n: int, limit: float, error: float) -> int:
    """The last step of a path whose rate of false rejections is below ``limit``, or -1.

    rejected[j]: of ``n`` good documents, those that steps 0 to j reject. Steps are tested in order and the first failure ends
    it (fixed-sequence testing), so the chance that any claim is wrong is at most ``error``.
    """
    for j, x in enumerate(rejected.tolist()):
        if n == 0 or x > n * limit or binomial_cdf(int(x), n, limit) > error:
            return j - 1
    return len(rejected) - 1


def path(bad: np.ndarray, other: np.ndarray, times: tuple[np.ndarray, np.ndarray] | None = None) -> list[tuple[int, int]]:
    """Steps (rule, t) that lower one rule's cutoff each: from then on it rejects bins from t on.

    ``bad`` and ``other``: distinct bins of bad documents and of documents without a label, and ``times``, how many of each have them (once if not given). The next cutoff is the one that
    rejects most bad documents more for each other one that looks good, and it is gone to notch by notch. Documents without
    label are a mixture, in which the tail that bad ones dominate most tells how many bad ones to expect beside
    each labelled one. Without bad documents all rules go from lenient to strict side by side.
    """
    sizes = [len(r.grid) for r in RULES]
    if not len(bad):
        return [(r, t) for t in range(max(sizes), 0, -1) for r, n in enumerate(sizes) if t <= n]
    n_bad, n_other = times or (np.ones(len(bad), np.int64), np.ones(len(other), np.int64))
    tail = lambda bins, n, r: np.bincount(bins[:, r], n, sizes[r] + 1)[::-1].cumsum()[::-1]
    tails = [(tail(bad, n_bad, r), tail(other, n_other, r)) for r in range(len(RULES))]
    rate = min((float(y / x) for xs, ys in tails for x, y in zip(xs, ys) if x >= max(5, int(n_bad.sum()) // 10)), default=0.0)
    steps, floor = [], [n + 1 for n in sizes]
    while len(bad):
        best, tails = (0.0, 0, 0), [(tail(bad, n_bad, r), tail(other, n_other, r)) for r in range(len(RULES))]
        for r, (of_bad, of_other) in enumerate(tails):
            expected = rate * of_bad
            gain = of_bad / (1.0 + np.maximum(0.0, of_other - expected - 2 * np.sqrt(expected)))
            t = max(range(floor[r] - 1, 0, -1), key=lambda t: gain[t], default=0)
            if t and gain[t] > best[0]:
                best = (float(gain[t]), r, t)
        gain, r, t = best
        if not gain:
            break
        of_bad = tails[r][0]
        steps += [(r, notch) for notch in range(floor[r] - 1, t - 1, -1) if notch == len(of_bad) - 1 and of_bad[notch] or notch < len(of_bad) - 1 and of_bad[notch] > of_bad[notch + 1]]
        floor[r] = t
        left, rest = bad[:, r] < t, other[:, r] < t
        bad, n_bad, other, n_other = bad[left], n_bad[left], other[rest], n_other[rest]
    return steps


def _first_steps(steps: list[tuple[int, int]]) -> list[list[int]]:
    """For each rule and bin, the first step that rejects it (the number of steps: none does)."""
    out = []
    for r, rule in enumerate(RULES):
        of = np.full(len(rule.grid) + 1, len(steps))
        for j in range(len(steps) - 1, -1, -1):
            if steps[j][0] == r:
                of[steps[j][1] :] = j
        out.append(of.tolist())
    return out


def scored(docs: DataFrame, *, carry: list[str] | None = None, text_col: str = "text", id_col: str = "doc_id", stratum_col: str = "lang") -> DataFrame:
    """A written table: row (struct of the ``carry`` columns of ``docs``, all if not given), id, stratum, counts. Texts are read and counted once."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    text, stratum = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{stratum_col}`").cast("string"), F.lit(""))
    return written(docs.select(row.alias("row"), F.col(f"`{id_col}`").alias("id"), stratum.alias("stratum"), features(text).alias("counts")), "quality-counts")


def cutoffs(rows: DataFrame, labels: DataFrame, *, limit: float = 0.02, error: float = 0.05) -> DataFrame:
    """One row for each stratum that has good labelled documents: stratum, pooled, n_good (documents of the holdout), n_rejected (those that the cutoffs reject) and cut_<rule>, null where none is certified.

    ``rows``: of ``scored``. The holdout is every labelled document of quality 1 that passes the base rules. ``limit``: share of
    good documents that all rules together may reject. Cutoffs of all rules are lowered along one path, and each step is
    tested on the holdout by an exact binomial bound in a fixed sequence. ``error``: chance that any stratum's claim is wrong;
    each gets an equal part (Bonferroni). A stratum too small to show anything at its part is pooled with the others
    that are; a pool that is too small as well has no cutoffs and takes no part of the error.

    The path never sees a label of the holdout: it is fitted per stratum on all documents of quality 0 and all without label.
    Spark counts the documents of each vector of bins, and the vectors, of which a stratum has as many as its documents differ in
    notches, come to one task a stratum. All counts and the tests are over all rows. Labels with nulls are ignored; for
    ids labelled twice the lower quality counts; rows that repeat an id are tested each.
    """
    labelled = written(labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") >= 1).alias("good")).select(F.col("doc_id").alias("l_id"), "good"), "quality-labels")
    marked = rows.filter(~base_failed("counts")).select("id", "stratum", _bins("counts").alias("bins")).join(lookup(labelled), F.col("id") == F.col("l_id"), "left")
    kind = F.coalesce(F.when(F.col("good"), "good").when(~F.col("good"), "bad"), F.lit("other"))
    marked = written(marked.groupBy("stratum", "bins", kind.alias("kind")).agg(F.count("*").alias("n")), "quality-bins")
    sizes = marked.filter("kind = 'good'").groupBy("stratum").agg(F.sum("n").alias("good"))

    def plan(strata: pd.DataFrame) -> pd.DataFrame:
        """Which strata are tested on their own; one row a stratum comes here."""
        strata = strata.sort_values(["good", "stratum"], ascending=[False, True]).reset_index(drop=True)
        enough = lambda n, tests: n > 0 and binomial_cdf(0, int(n), limit) <= error / tests
        own = 0
        while own < len(strata) and enough(strata["good"][own], own + 1):
            own += 1
        while own and not enough(strata["good"][own - 1], own + 1) and enough(strata["good"][own:].sum(), own + 1):
            own -= 1  # the pool's test needs its part too
        tests = own + bool(enough(strata["good"][own:].sum(), own + 1))
        strata["pooled"] = strata.index >= own
        strata["alpha"] = error / max(1, tests)
        return strata[["stratum", "pooled", "alpha"]]

    planned = written(sizes.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(plan, "stratum string, pooled boolean, alpha double"), "quality-strata")
    grouped = marked.join(lookup(planned), "stratum").withColumn("of", F.when(F.col("pooled"), "").otherwise(F.col("stratum")))

    def fit(counted: pd.DataFrame) -> pd.DataFrame:
        bins, n = np.array(counted["bins"].tolist(), np.int64).reshape(-1, len(RULES)), counted["n"].to_numpy()
        bad, other = ((counted["kind"] == k).to_numpy() for k in ("bad", "other"))
        steps = path(bins[bad], bins[other], (n[bad], n[other]))
        return pd.DataFrame({"p_of": counted["of"].iloc[:1], "p_pooled": counted["pooled"].iloc[:1], "steps": [[list(x) for x in steps]], "first": [_first_steps(steps)]})

    vectors = grouped.filter("kind <> 'good'").groupBy("of", "pooled", "kind", "bins").agg(F.sum("n").alias("n"))
    paths = lookup(written(vectors.groupBy("of", "pooled").applyInPandas(fit, "p_of string, p_pooled boolean, steps array<array<int>>, first array<array<int>>"), "quality-paths"))
    on = (F.col("of") == F.col("p_of")) & (F.col("pooled") == F.col("p_pooled"))
    rejects = F.array_min(F.zip_with("first", "bins", lambda of, b: F.get(of, b)))
    levels = grouped.filter("kind = 'good'").join(paths, on, "left").groupBy("of", "pooled", "alpha", "steps", rejects.alias("level")).agg(F.sum("n").alias("n"))

    def certify(counts: pd.DataFrame) -> pd.DataFrame:
        steps = [] if counts["steps"].iloc[0] is None else [tuple(x) for x in counts["steps"].iloc[0]]
        by_level = np.zeros(len(steps) + 1, np.int64)
        np.add.at(by_level, counts["level"].fillna(len(steps)).astype(int), counts["n"])
        rejected, n = by_level.cumsum()[: len(steps)], int(by_level.sum())
        last = certified(rejected, n, limit, float(counts["alpha"].iloc[0]))
        cut = {r: RULES[r].grid[t - 1] for r, t in steps[: last + 1]}
        out = {"c_of": counts["of"].iloc[0], "c_pooled": counts["pooled"].iloc[0], "n_good": n, "n_rejected": int(rejected[last]) if last >= 0 else 0}
        return pd.DataFrame([out | {f"cut_{rule.name}": cut.get(r) for r, rule in enumerate(RULES)}]).astype({f"cut_{r.name}": float for r in RULES})

    names = ", ".join(f"cut_{r.name} double" for r in RULES)
    found = levels.groupBy("of", "pooled").applyInPandas(certify, f"c_of string, c_pooled boolean, n_good long, n_rejected long, {names}")
    found = found.select("c_of", "c_pooled", "n_good", "n_rejected", *[F.nanvl(f"cut_{r.name}", F.lit(None).cast("double")).alias(f"cut_{r.name}") for r in RULES])
    of = F.when(F.col("pooled"), "").otherwise(F.col("stratum"))
    return planned.join(found, (of == F.col("c_of")) & (F.col("pooled") == F.col("c_pooled"))).select("stratum", "pooled", "n_good", "n_rejected", *[f"cut_{r.name}" for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, *, carry: list[str] | None = None, text_col: str = "text", id_col: str = "doc_id", stratum_col: str = "lang", **options) -> DataFrame:
    """row (struct of the columns of ``docs``, or of those in ``carry``), counts (struct), base_failed, kept and certified (struct of the stratum's row in ``cutoffs``, null if it has none).

    A document is kept if it passes the base rules and no certified cutoff of its stratum is below its score. A stratum
    without good labels has no cutoffs. Null or empty texts have no words, so they fail the base rules; a null stratum counts
    as the empty string; repeated rows are judged each. Empty tables give no rows. ``options``: limit and error of ``cutoffs``.
    """
    rows = scored(docs, carry=carry, text_col=text_col, id_col=id_col, stratum_col=stratum_col)
    cuts = written(cutoffs(rows, labels, **options), "quality-cutoffs")
    certified_ = cuts.select(F.col("stratum").alias("c_stratum"), F.struct(*cuts.columns).alias("certified"))
    out = rows.join(lookup(certified_), F.col("stratum") == F.col("c_stratum"), "left")
    rejected = F.lit(False)
    for r in RULES:
        rejected = rejected | F.coalesce(_score(r, "counts") > F.col(f"certified.cut_{r.name}"), F.lit(False))
    return out.select("row", "counts", base_failed("counts").alias("base_failed"), (~base_failed("counts") & ~rejected).alias("kept"), "certified")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with its columns."""
    return judge(docs, labels, **options).filter("kept").select("row.*")
