"""Queries of the subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, jaccard_join, lexical_search, line_dedup, lm_scoring, merkle, minhash, mixing, quality_rules, secret_scan, substring_dedup, suffix_dedup, token_records
from .common import read_table

#: Name of the tokenizer file of op9, looked up where the public tokenizers are installed.
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.dedup_strings(read_table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), size=10)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_windows(read_table(spark, sf_dir, "documents"), length=50)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.find_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        "doc_id", count("assign"), count("access"), count("hex"), F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
        secret_scan.span_text(F.concat("base", "linked")).alias("spans"), F.size("linked").cast("long").alias("n_linked"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), carry=["doc_id"])
    counts = [F.col(f"counts.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("row.doc_id", *counts, "base_failed", "kept", *[F.col(f"certified.cut_{r.name}") for r in quality_rules.RULES])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"), min_chars=40, min_docs=5)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records.encode_and_read(read_table(spark, sf_dir, "documents"), tokenizer_path=tokenizer_path(), end_id=0)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jaccard_join.link_documents(read_table(spark, sf_dir, "documents"), n=3, num=90, den=100)
    return out.select("doc_id", "n_shingles", "component_id")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    damaged = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    n_chars = F.when(damaged, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    columns = ("doc_id", "source", "lang", "n_chars", "text")
    tampered = merkle.leaf_digest(*[n_chars if c == "n_chars" else F.col(c) for c in columns])
    out = merkle.manifest(docs, columns=columns, carry={"tampered": tampered})
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("proof")), 256).alias("proof_sha256"), merkle.folded(F.col("tampered"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lexical_search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = minhash.link_documents(read_table(spark, sf_dir, "documents"), n=4, num=80, den=100)
    return out.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


OP1_SQL = r"""
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), s AS (
  SELECT doc_id, x, unnest(range(0, len(x) // 2 - 49)) AS i FROM h WHERE len(x) >= 100
), w AS (
  SELECT doc_id, i, substring(x, 2 * i + 1, 100) AS k FROM s
), f AS (
  SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING min(doc_id) <> max(doc_id)
), hit AS (
  SELECT w.doc_id, w.i, lag(w.i) OVER (PARTITION BY w.doc_id ORDER BY w.i) AS before FROM w JOIN f USING (k) WHERE f.first < w.doc_id
), g AS (
  SELECT doc_id, i, sum(CASE WHEN i <= before + 50 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM hit
), sp AS (
  SELECT doc_id, n, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY doc_id, n
), gaps AS (
  SELECT h.doc_id, h.x, sp.n, sp.a, sp.b, coalesce(lag(sp.b) OVER (PARTITION BY h.doc_id ORDER BY sp.a), 0) AS from_ FROM h LEFT JOIN sp USING (doc_id)
)
SELECT doc_id, max(len(x) // 2) AS n_bytes, CAST(coalesce(sum(b - a), 0) AS BIGINT) AS n_removed, count(n) AS n_spans,
       sha256(unhex(coalesce(string_agg(substring(x, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a), '') || substring(max(x), 2 * coalesce(max(b), 0) + 1))) AS kept_sha256
FROM gaps GROUP BY doc_id
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bs AS (
  SELECT item, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0
), bw AS (
  SELECT DISTINCT item, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM bs
), ds AS (
  SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m
), hit AS (
  SELECT ds.doc_id, ds.i, ds.m, bw.item FROM ds JOIN bw ON ds.m = bw.m AND array_to_string(ds.w[ds.i:ds.i + ds.m - 1], ' ') = bw.win
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hit) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.list, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50
), k AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM s
), f AS (
  SELECT h, min(doc_id) AS first FROM k GROUP BY h HAVING min(doc_id) <> max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM (SELECT k.doc_id, k.i FROM k JOIN f USING (h) WHERE f.first < k.doc_id)
), words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d
), m AS (
  SELECT words.doc_id, words.p, words.word, gone.p IS NOT NULL AS gone FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
), r AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(r.n_removed, 0) AS n_removed, sha256(coalesce(r.kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id)
"""

OP7_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)
), k AS (
  SELECT doc_id, pos, line, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l
), hot AS (
  SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), m AS (
  SELECT k.doc_id, k.pos, k.line, hot.key IS NOT NULL AND k.doc_id <> hot.last_id AS gone FROM k LEFT JOIN hot ON k.key = hot.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


OP10_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 2], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), c AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_ FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT p.a, p.b FROM p JOIN c x ON x.doc_id = p.a JOIN c y ON y.doc_id = p.b WHERE 100 * p.both_ >= 90 * (x.n + y.n - p.both_)
), u AS (
  SELECT a, b FROM e UNION SELECT b, a FROM e
), r AS (
  SELECT doc_id AS node, doc_id AS reached FROM d UNION SELECT r.node, u.b FROM r JOIN u ON r.reached = u.a
)
SELECT d.doc_id, coalesce(c.n, 0) AS n_shingles, q.m AS component_id
FROM d LEFT JOIN c USING (doc_id) JOIN (SELECT node, min(reached) AS m FROM r GROUP BY node) q ON q.node = d.doc_id
"""

OP11_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
         list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, z: xor(a >> 1, (a & 1) * 3988292384))) AS r
  FROM documents
), v AS (
  SELECT doc_id, lang, n_chars, xor(r, 4294967295) % 7 = 0 AS bad,
         coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS before,
         coalesce(strlen(text) || ':' || text, '-') AS after
  FROM d
), l AS (
  SELECT doc_id, coalesce('+' || lang, '') AS part, sha256(before || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') || after) AS leaf,
         sha256(before || coalesce(strlen(CAST(CASE WHEN bad THEN n_chars + 1 ELSE n_chars END AS VARCHAR)) || ':' || CASE WHEN bad THEN n_chars + 1 ELSE n_chars END, '-') || after) AS tampered
  FROM v
), p AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id, leaf) - 1 AS i FROM l
), t AS (
  SELECT part, 0 AS lv, i, leaf AS h, count(*) OVER (PARTITION BY part) AS n FROM p
  UNION ALL
  SELECT part, lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY part, lv, i // 2
), s AS (
  SELECT part, h AS subroot, row_number() OVER (ORDER BY part) - 1 AS i FROM t WHERE n = 1
), u AS (
  SELECT 0 AS lv, i, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT lv + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lv, i // 2
), top AS (
  SELECT h AS root FROM u WHERE n = 1
), f AS (
  SELECT doc_id, part, i AS at, 0 AS lv, i, leaf, tampered AS fold, '' AS proof, false AS done FROM p
  UNION ALL
  SELECT f.doc_id, f.part, f.at, f.lv + 1, f.i // 2, f.leaf, sha256(CASE WHEN o.h IS NULL THEN f.fold WHEN f.i % 2 = 1 THEN o.h || f.fold ELSE f.fold || o.h END), f.proof || coalesce(o.h, ''), false
  FROM f JOIN t m ON m.part = f.part AND m.lv = f.lv AND m.i = f.i AND m.n > 1 LEFT JOIN t o ON o.part = f.part AND o.lv = f.lv AND o.i = xor(f.i, 1)
), g AS (
  SELECT f.doc_id, f.part, f.at, f.leaf, f.fold, f.proof, s.subroot, 0 AS lv, s.i FROM f JOIN t ON t.part = f.part AND t.lv = f.lv AND t.n = 1 JOIN s ON s.part = f.part
  UNION ALL
  SELECT g.doc_id, g.part, g.at, g.leaf, sha256(CASE WHEN o.h IS NULL THEN g.fold WHEN g.i % 2 = 1 THEN o.h || g.fold ELSE g.fold || o.h END), g.proof || coalesce(o.h, ''), g.subroot, g.lv + 1, g.i // 2
  FROM g JOIN u m ON m.lv = g.lv AND m.i = g.i AND m.n > 1 LEFT JOIN u o ON o.lv = g.lv AND o.i = xor(g.i, 1)
)
SELECT g.doc_id, g.leaf, g.subroot, top.root, sha256(g.proof) AS proof_sha256, g.fold AS folded_root, g.fold = top.root AS verified
FROM g JOIN u ON u.lv = g.lv AND u.n = 1, top
"""

OP12_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), c AS (
  SELECT CAST(count(*) AS BIGINT) AS n_all, CAST(sum(len(w)) AS BIGINT) AS l_all FROM d WHERE len(w) > 0
), p AS (
  SELECT doc_id, any_value(n) AS n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, term
), w AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * n_all + 2) / (2 * df + 1))) AS BIGINT) AS weight, n_all, l_all FROM (SELECT term, count(*) AS df FROM p GROUP BY term), c
), q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), s AS (
  SELECT q.item_id, p.doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_all) // l_all)))) AS BIGINT) AS score
  FROM q JOIN w USING (term) JOIN p USING (term) GROUP BY q.item_id, p.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 10
"""

#: The same steps as of op10, on other shingles.
OP13_SQL = OP10_SQL.replace("len(w) < 3", "len(w) < 4").replace("w[i:i + 2]", "w[i:i + 3]").replace("len(w) - 2", "len(w) - 3").replace(">= 90 *", ">= 80 *").replace("q.m AS component_id", "q.m AS component_id, d.doc_id = q.m AS kept")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_dedup": op1_suffix_dedup,
        "op2_decontamination": op2_decontamination,
        "op3_substring_dedup": op3_substring_dedup,
        "op4_secret_scan": op4_secret_scan,
        "op5_quality_rules": op5_quality_rules,
        "op6_mixing": op6_mixing,
        "op7_line_dedup": op7_line_dedup,
        "op8_lm_scoring": op8_lm_scoring,
        "op9_token_records": op9_token_records,
        "op10_jaccard_join": op10_jaccard_join,
        "op11_merkle": op11_merkle,
        "op12_lexical_search": op12_lexical_search,
        "op13_minhash": op13_minhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_suffix_dedup": OP1_SQL, "op2_decontamination": OP2_SQL, "op3_substring_dedup": OP3_SQL, "op7_line_dedup": OP7_SQL, "op10_jaccard_join": OP10_SQL, "op11_merkle": OP11_SQL, "op12_lexical_search": OP12_SQL, "op13_minhash": OP13_SQL}
