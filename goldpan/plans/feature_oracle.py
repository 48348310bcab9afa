"""SQL for DuckDB that gives the rows of ``feature_queries``."""

from __future__ import annotations

from goldpan.plans.feature_queries import FILES, ROUNDS
from goldpan.plans.oracle import _CASCADE, _PII, _luhn, _replaced

#: Number of levels of each field, and what m begins with; -1 where a side is null.
_START = {"name": (0.97, 0.86, 0.75, 0.05), "email": (0.98, 0.01), "phone": (0.9, 0.7, 0.05), "province": (0.85, 0.15), "website": (0.96, 0.04)}


def _list(values) -> str:
    return "[" + ", ".join(f"{v}::DOUBLE" for v in values) + "]"


def _gammas(pairs: str) -> str:
    """Counted vectors of pairs. Names and phones are one letter or digit repeated, so they are equal or on the last level."""
    level = lambda c, last: f"CASE WHEN a.{c} IS NULL OR b.{c} IS NULL THEN -1 WHEN a.{c} = b.{c} THEN 0 ELSE {last} END"
    return f"""SELECT {level('name', 3)} AS name, {level('email', 1)} AS email, {level('phone', 2)} AS phone, {level('province', 1)} AS province, {level('website', 1)} AS website, count(*) AS n
FROM {pairs} JOIN c a ON a.id = l JOIN c b ON b.id = r GROUP BY 1, 2, 3, 4, 5"""


def _weights() -> str:
    order = lambda k: f"row_number() OVER (ORDER BY substr(md5('{k}:' || id), 1, 15))"
    sides = ", ".join(f"o{k} AS (SELECT id, {order(k)} AS p FROM c)" for k in range(6))
    zipped = " UNION ".join(f"SELECT least(a.id, b.id) AS l, greatest(a.id, b.id) AS r FROM o{2 * s} a JOIN o{2 * s + 1} b USING (p) WHERE a.id <> b.id" for s in range(3))
    of_u = ", ".join("[" + ", ".join(f"coalesce(sum(n) FILTER ({f} = {i}), 0)::DOUBLE / sum(n) FILTER ({f} >= 0)" for i in range(len(m))) + f"] AS {f}" for f, m in _START.items())
    rounds = f"m0 AS (SELECT 5e-1 AS prior, {', '.join(f'{_list(m)} AS {f}' for f, m in _START.items())})"
    product = lambda t, floor: " * ".join(f"CASE WHEN v.{f} >= 0 THEN {'greatest(' if floor else ''}{t}.{f}[v.{f} + 1]{', 1e-6)' if floor else ''} ELSE 1e0 END" for f in _START)
    for r in range(ROUNDS):
        share = f"m{r}.prior * {product(f'm{r}', False)}"
        new = ", ".join("[" + ", ".join(f"greatest(coalesce(sum(p) FILTER ({f} = {i}), 0) / sum(p) FILTER ({f} >= 0), 1e-6)" for i in range(len(m))) + f"] AS {f}" for f, m in _START.items())
        rounds += f""", p{r} AS (SELECT v.*, n * ({share}) / (({share}) + (1 - m{r}.prior) * {product('u', True)}) AS p FROM v, m{r}, u),
m{r + 1} AS (SELECT least(greatest(sum(p) / sum(n), 1e-9), 1 - 1e-9) AS prior, {new} FROM p{r})"""
    rows = " UNION ALL ".join(f"SELECT 'link_{f}' AS field, {i} AS level, round(u.{f}[{i + 1}], 6) AS u, round(m.{f}[{i + 1}], 6) AS m FROM u, m{ROUNDS} m" for f, x in _START.items() for i in range(len(x)))
    return f"""WITH k AS (SELECT c_custkey AS id, c_custkey // 3 AS e FROM customer),
c AS (SELECT id, e, repeat(substr('abcdefghijklmnopqrst', ((CASE WHEN id % 7 = 0 THEN e + 1 ELSE e END) % 20 + 1)::INT, 1), 8) AS name,
  CASE WHEN id % 5 <> 0 THEN 'm' || CASE WHEN id % 11 = 0 THEN e + 1 ELSE e END END AS email, (CASE WHEN id % 4 = 0 THEN e + 1 ELSE e END) % 10 AS phone,
  (e + (id % 13 = 0)::INT) % 2 AS province, e % 50 AS website FROM k),
{sides}, rp AS ({zipped}), uv AS ({_gammas('rp')}), u AS (SELECT {of_u} FROM uv),
cp AS (SELECT a.id AS l, b.id AS r FROM c a JOIN c b ON a.id < b.id AND a.e = b.e UNION SELECT a.id, b.id FROM c a JOIN c b ON a.id < b.id AND a.id // 4 = b.id // 4),
v AS ({_gammas('cp')}), {rounds}
{rows} UNION ALL SELECT 'all', 0, NULL, round(prior, 6) FROM m{ROUNDS}"""


_FILES = f"""e AS (SELECT event_id, user_id AS target_slug, event_type, ts, least(1, greatest(0, value / 100)) AS score, least((day(ts) - 1) // 6, {FILES - 2}) AS f0 FROM events),
s AS (
  SELECT event_id, target_slug, event_type, ts, score, f0 AS file FROM e WHERE event_id % 7 <> 0 UNION ALL SELECT event_id, target_slug, event_type, ts, score, least(f0 + 1, {FILES - 1}) FROM e WHERE event_id % 5 = 0
  UNION ALL SELECT event_id, target_slug, event_type, ts, score, {FILES - 1} FROM e WHERE event_id % 7 = 0
),
b AS (SELECT x.file, max(s.ts) FILTER (s.file < x.file) - INTERVAL 3 DAY AS border, max(s.ts) FILTER (s.file < x.file - 1) - INTERVAL 3 DAY AS before FROM (SELECT DISTINCT file FROM s) x, s GROUP BY 1)"""

_HITS = " UNION ALL ".join(
    f"""SELECT doc_id, '{k}' AS type, list_sum([len(x) FOR x IN p[1:i]]) + coalesce(list_sum([len(x) FOR x IN h[1:i - 1]]), 0) AS start, h[i] AS x, {score} AS score
FROM (SELECT doc_id, string_split_regex(text, '{_PII[k]}') AS p, regexp_extract_all(text, '{_PII[k]}') AS h FROM documents), unnest(range(1, len(h) + 1)) t(i)"""
    for k, score in (("EMAIL_ADDRESS", 1.0), ("URL", 0.6), ("IBAN_CODE", 0.5), ("CREDIT_CARD", 1.0), ("ID_NUMBER", 1.0), ("IP_ADDRESS", 0.6), ("PHONE_NUMBER", 0.4))
)
_EVENTS = f"""h AS ({_HITS}), g AS (SELECT doc_id, type, CAST(start AS INT) AS start, CAST(start + len(x) AS INT) AS stop, score FROM h WHERE type NOT IN ('CREDIT_CARD', 'ID_NUMBER') OR {_luhn('x')}),
ev AS (SELECT * FROM g WHERE NOT EXISTS (SELECT 1 FROM g o WHERE o.doc_id = g.doc_id AND o.start < g.stop AND o.stop > g.start AND (o.score, o.stop - o.start, -o.start) > (g.score, g.stop - g.start, -g.start)))"""

_SPARSE = """l AS (SELECT l_orderkey * 10 + l_linenumber AS k, CAST(l_quantity AS INT) AS q, l_returnflag, CAST(l_shipdate AS DATE) AS day FROM lineitem), m AS (SELECT max(k) / 2 AS late FROM l),
s AS (SELECT k, CASE WHEN k > late THEN 'a' || k || '@x.example' END AS mail, CASE WHEN k > late THEN CAST(q AS VARCHAR) END AS amount, CASE WHEN k > late THEN strftime(day, '%Y-%m-%d') END AS day, CASE WHEN k % 2 = 0 THEN l_returnflag END AS mode, CAST(NULL AS VARCHAR) AS nothing FROM l, m),
w AS (SELECT k, 'mail' AS column_name, mail AS value FROM s UNION ALL SELECT k, 'amount', amount FROM s UNION ALL SELECT k, 'day', day FROM s UNION ALL SELECT k, 'mode', mode FROM s),
x AS (SELECT column_name, value, row_number() OVER (PARTITION BY column_name ORDER BY k, value) AS n FROM w WHERE value IS NOT NULL),
y AS (SELECT * FROM x WHERE n <= 100)"""
_share = lambda p: f"avg(regexp_matches(value, '{p}')::INT) > 0.7"
_TYPES = f"""{_SPARSE}, t AS (
  SELECT column_name, CASE WHEN {_share('^[^@ ]+@[^@ ]+\\.[^@ ]+$')} THEN 'email' WHEN avg((regexp_matches(value, '^\\+?[0-9() -]{{7,}}$') AND NOT regexp_matches(value, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'))::INT) > 0.7 THEN 'phone'
    WHEN {_share('^(https?://|www\\.)')} THEN 'url' WHEN avg((TRY_CAST(value AS DATE) IS NOT NULL)::INT) > 0.7 THEN 'date' WHEN avg((TRY_CAST(value AS DOUBLE) IS NOT NULL)::INT) > 0.7 THEN 'numeric'
    WHEN count(DISTINCT value) / count(*) < 0.1 THEN 'categorical' ELSE 'text' END AS semantic_type FROM y GROUP BY 1
  UNION ALL SELECT 'nothing', 'empty'
)"""

_ENTRIES = f"""{_CASCADE}, en AS (
  SELECT c_custkey, 0 AS seq, 'lookup' AS source, 0.95 AS confidence, CASE WHEN a IS NOT NULL THEN 'deterministic' ELSE 'none' END AS strategy, 'disabled' AS network_status FROM c
  UNION ALL SELECT c_custkey, 1, 'derived', 0.9, CASE WHEN b IS NOT NULL THEN 'deterministic' ELSE 'none' END, 'disabled' FROM c WHERE a IS NULL
  UNION ALL SELECT c_custkey, CASE WHEN a IS NULL THEN 2 ELSE 1 END, 'research', 0.0, 'none', 'skipped: network disabled' FROM c
)"""

_broken = lambda c, bad: f"(SELECT coalesce(string_agg(v, '|' ORDER BY k), '') FROM (SELECT CAST({c} AS VARCHAR) AS v, o_orderkey AS k FROM orders WHERE {bad} ORDER BY o_orderkey LIMIT 3))"


def _rule(name: str, column: str, bad: str, mostly: float) -> str:
    return f"""SELECT '{name}' AS expectation, count({column}) AS n, count(*) FILTER ({bad}) AS n_bad, 1 - count(*) FILTER ({bad}) / count({column}) >= {mostly} AS success,
  CASE WHEN 1 - count(*) FILTER ({bad}) / count({column}) >= {mostly} THEN '' ELSE {_broken(column, bad)} END AS unexpected FROM orders"""


FEATURE_SQL: dict[str, str] = {
    "estimated_weights": _weights(),
    "history_namesakes": """WITH r AS (SELECT c_custkey AS pos, CASE WHEN c_custkey % 3 = 0 THEN 'hot' ELSE 'n' || c_nationkey END AS k FROM customer),
e AS (SELECT s_suppkey AS entity_id, CASE WHEN s_suppkey % 3 = 0 THEN 'hot' ELSE 'n' || s_nationkey END AS k FROM supplier UNION ALL SELECT c_custkey + 1000000, CASE WHEN c_custkey % 3 = 0 THEN 'hot' ELSE 'n' || c_nationkey END FROM customer WHERE c_custkey % 2 = 0),
a AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY pos) AS i FROM r), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY entity_id) AS i FROM e)
SELECT pos, entity_id FROM a JOIN b USING (k, i)""",
    "fuzzy_classes": """WITH s AS (SELECT p_partkey AS id, array_to_string(list_sort(string_split_regex(concat_ws(' ', p_partkey % 400 * 1013 % 997, p_brand), '\\s+')), ' ') AS s FROM part), d AS (SELECT s, min(id) AS class FROM s GROUP BY 1),
near AS (SELECT x.class AS x, y.class AS y, x.s AS a, y.s AS b FROM d x JOIN d y ON x.class < y.class AND levenshtein(x.s, y.s) <= 0.08 * (length(x.s) + length(y.s)) + 1e-9),
lc AS (SELECT x, y, length(a) AS n, length(b) AS m, list_reduce([list_transform(range(0, length(b) + 1), lambda z: 0)] || list_transform(range(1, length(a) + 1), lambda i: [i]), lambda row, i:
  list_reduce([[0]] || list_transform(range(1, length(b) + 1), lambda j: [j]), lambda new, j: list_append(new, CASE WHEN a[i[1]] = b[j[1]] THEN row[j[1]] + 1 ELSE greatest(row[j[1] + 1], new[len(new)]) END))) AS t FROM near),
ok AS (SELECT x, y FROM lc WHERE 2.0 * t[m + 1] / (n + m) >= 0.92 - 1e-12)
SELECT 'member' AS what, count(*) AS n, CAST(sum(id) AS BIGINT) AS sum_x, CAST(sum(class) AS BIGINT) AS sum_y FROM s JOIN d USING (s) UNION ALL SELECT 'pair', count(*), CAST(sum(x) AS BIGINT), CAST(sum(y) AS BIGINT) FROM ok""",
    "kept_per_cluster": "SELECT min(c_custkey) AS c_custkey, arg_min(c_name, c_custkey) AS c_name, any_value(c_nationkey) AS c_nationkey FROM customer WHERE c_acctbal IS NOT NULL GROUP BY c_nationkey, floor(c_acctbal / 200)",
    "history_lists": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'a' || c_custkey || ';b' WHEN 1 THEN 'v' || c_custkey ELSE '' END AS variants,
  CASE c_custkey % 3 WHEN 0 THEN 'open:2024-01-0' || (c_custkey % 9 + 1) || ';shut:-' WHEN 1 THEN 'open:-' ELSE '' END AS statuses FROM customer""",
    # A row that comes again is dropped while its state lives. A batch drops what is behind the watermark of the batch before it, which is when the state of such rows has gone.
    "stream_batches": f"""WITH {_FILES}, k AS (SELECT s.* FROM s JOIN b USING (file) WHERE before IS NULL OR ts >= before),
f AS (SELECT event_id, any_value(event_type) AS event_type, min(file) AS file FROM k GROUP BY event_id) SELECT CAST(file AS INT) AS file, event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM f GROUP BY 1, 2""",
    "stream_sliding": f"""WITH {_FILES}, k AS (SELECT s.*, border IS NULL OR ts >= border AS ok FROM s JOIN b USING (file)),
w AS (SELECT (CAST(epoch(ts) AS BIGINT) // 172800 - i) * 172800 AS start, score FROM k, (SELECT unnest([0, 1]) AS i) WHERE ok)
SELECT strftime(make_timestamp(CAST(start AS BIGINT) * 1000000), '%Y-%m-%d') AS day, count(*) AS n, CAST(round(sum(CAST(score AS DECIMAL(28, 10))), 4) AS DOUBLE) AS score FROM w GROUP BY 1 UNION ALL SELECT 'late', count(*), NULL FROM k WHERE NOT ok""",
    "stream_store": f"WITH {_FILES} SELECT target_slug, event_type, event_id, CAST(file AS INT) AS file FROM s QUALIFY row_number() OVER (PARTITION BY target_slug, event_type ORDER BY file DESC, event_id DESC) = 1",
    "documents_redacted": f"SELECT doc_id, sha256({_replaced('text')}) AS redacted FROM documents",
    "redaction_events": f"WITH {_EVENTS} SELECT doc_id, 'text' AS column_name, type, start, stop, score FROM ev",
    "redacted_lines": f"""WITH {_EVENTS}, n AS (SELECT doc_id, count(*) AS n_events, count(DISTINCT len(string_split(substr(text, 1, start), chr(10)))) AS n_lines FROM ev JOIN documents USING (doc_id) GROUP BY 1)
SELECT doc_id, sha256({_replaced('text')}) AS redacted, n_events, n_lines FROM documents JOIN n USING (doc_id)""",
    "suite_examples": " UNION ALL ".join((
        _rule("o_orderstatus in_set", "o_orderstatus", "o_orderstatus NOT IN ('O', 'F')", 0.999), _rule("o_orderpriority matches", "o_orderpriority", "NOT regexp_matches(o_orderpriority, '^[1-3]-')", 1.0),
        _rule("o_custkey between", "o_custkey", "o_custkey NOT BETWEEN 10 AND 100000000", 1.0), _rule("o_orderkey not_null", "o_orderkey", "o_orderkey IS NULL", 1.0), "SELECT 'o_clerk_of_old exists', 0, 1, false, ''",
    )),
    "filled_types": f"WITH {_TYPES} SELECT * FROM t",
    "filled_profile": f"""WITH {_TYPES}, c AS (SELECT column_name, count(*) AS filled, count(DISTINCT value) AS n_distinct, string_agg(value, '|' ORDER BY n) FILTER (n <= 3) AS samples FROM x GROUP BY 1)
SELECT t.column_name, (SELECT count(*) FROM s) AS n_rows, (SELECT count(*) FROM s) - coalesce(filled, 0) AS n_missing, coalesce(n_distinct, 0) AS n_distinct, semantic_type, coalesce(samples, '') AS samples FROM t LEFT JOIN c USING (column_name)""",
    "boxed_suppliers": """WITH p AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 <> 9 THEN (s_suppkey * 37 % 1400) / 10 - 70 END AS y, (s_suppkey * 73 % 3600) / 10 - 180 AS x FROM supplier),
b AS (SELECT n_name, n_nationkey * 11 % 120 - 65 AS s, n_nationkey * 11 % 120 - 60 + n_nationkey AS n, n_nationkey * 53 % 360 - 180 AS w, (n_nationkey * 53 + 30 + 2 * n_nationkey) % 360 - 180 AS e FROM nation),
i AS (SELECT id, n_name, (CASE WHEN w <= e THEN e - w ELSE e - w + 360 END) * (n - s) AS area FROM p JOIN b ON y BETWEEN s AND n AND CASE WHEN w <= e THEN x BETWEEN w AND e ELSE x >= w OR x <= e END)
SELECT p.id, arg_min(n_name, (area, n_name)) AS box FROM p LEFT JOIN i USING (id) GROUP BY 1""",
    "provenance_totals": f"""WITH {_ENTRIES} SELECT CASE GROUPING(source, strategy, network_status) WHEN 0 THEN 'detail' WHEN 3 THEN 'source' WHEN 5 THEN 'strategy' WHEN 6 THEN 'network_status' ELSE 'total' END AS level, source, strategy, network_status, count(*) AS n, round(avg(confidence), 6) AS mean_confidence
FROM en GROUP BY GROUPING SETS ((source, strategy, network_status), (source), (strategy), (network_status), ())""",
    "best_entries": f"""WITH {_ENTRIES}, f AS (SELECT * FROM en WHERE strategy = 'deterministic' QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY confidence DESC, seq) = 1)
SELECT c_custkey, coalesce(source, 'original') AS provenance_source, coalesce(confidence, 1.0) AS provenance_confidence, coalesce(strategy, 'none') AS provenance_strategy FROM customer LEFT JOIN f USING (c_custkey)""",
    "contact_cells": """SELECT c_custkey, 0 AS at, 'Ann ' || c_custkey AS name, 'ann' || c_custkey || '@x.example' AS email FROM customer WHERE c_custkey % 5 <> 0
UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 2 END, CASE WHEN c_custkey % 2 = 0 THEN 'Bob' ELSE 'Cy' END, CASE WHEN c_custkey % 2 = 0 THEN 'bob' || c_custkey || '@x.example' END FROM customer WHERE c_custkey % 5 <> 0""",
    "consent_write": "SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'granted' WHEN 1 THEN 'denied' END AS consent FROM customer",
    "cache_totals": "SELECT count(*) AS entries, count(*) FILTER (ts >= TIMESTAMP '2024-01-21') AS live, count(*) FILTER (ts < TIMESTAMP '2024-01-21') AS expired, CAST(sum(user_id) AS BIGINT) AS hits, round(avg(user_id), 6) AS mean_hits FROM events",
    "crawl_contacts": """WITH p AS (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN page_id END AS i, CASE WHEN page_id % 3 = 0 THEN page_id % 40 END AS d FROM pages),
d AS (SELECT d, max(page_id) AS p FROM p WHERE d IS NOT NULL GROUP BY 1), m AS (SELECT c_custkey, coalesce((SELECT max(page_id) FROM p WHERE i = c_custkey), d.p) AS p FROM customer LEFT JOIN d ON d.d = c_custkey % 40)
SELECT CAST(c_custkey AS VARCHAR) AS identifier, 'https://p/' || lpad(CAST(p AS VARCHAR), 6, '0') AS url, CASE WHEN p IS NOT NULL THEN 'a' || p || '@x.example' END AS emails, CASE WHEN p IS NOT NULL THEN 'Ann' END AS names FROM m""",
    "acquired": """WITH t AS (SELECT c_custkey AS k, c_custkey % 60 AS d FROM customer),
r AS (SELECT k, s_suppkey AS s FROM t JOIN supplier ON s_suppkey = k UNION ALL SELECT k, s_suppkey FROM t JOIN supplier ON s_suppkey = d AND s_suppkey < 60 WHERE NOT EXISTS (SELECT 1 FROM supplier x WHERE x.s_suppkey = k)),
a AS (SELECT 'registry' AS source_dataset, 'registry:' || k || ':0' AS id, s_name AS name, 'a' || s || '@x.example' AS mail FROM r JOIN supplier ON s_suppkey = s UNION ALL SELECT 'people', 'people:' || k || ':0', 'Part ' || k, 'b' || k || '@y.example' FROM t JOIN part ON p_partkey = k AND k % 3 = 0)
SELECT source_dataset, count(*) AS n, count(DISTINCT name) AS names, min(id) AS first_id, max(mail) AS last_email FROM a GROUP BY 1""",
    "digest_weights": """WITH e AS (SELECT user_id, sum(least(1, greatest(0, value / 200)) * (1 + event_id % 3)) / sum(1 + event_id % 3) AS x, count(*) AS n FROM events GROUP BY 1)
SELECT 'user-' || (c_custkey * 3) AS target_slug, round(coalesce(CASE WHEN x <= 0 THEN 0.0 WHEN x >= 1 THEN 1.0 ELSE 1 / (1 + exp(-12 * (x - 0.5))) END, 0), 6) AS score, coalesce(n, 0) AS signal_count FROM customer LEFT JOIN e ON user_id = c_custkey * 3""",
    "last_gates": """WITH l AS (SELECT o_orderkey AS at, o_totalprice > 100000 AS ok FROM orders ORDER BY o_orderkey DESC LIMIT 25)
SELECT count(*) AS total, count(*) FILTER (ok) AS passed, count(*) FILTER (NOT ok) AS failed, round(avg(ok::INT), 6) AS pass_rate, max(l.at) AS latest_at, arg_max(ok, l.at) AS latest_passed FROM l""",
    "run_totals": """SELECT o_orderpriority, GROUPING(o_orderpriority) = 1 AS is_total, count(*) AS runs, count(*) FILTER (o_orderstatus <> 'F') AS successes, round(avg((o_orderstatus <> 'F')::INT), 6) AS success_rate, CAST(sum(o_orderkey % 1000) AS BIGINT) AS records, CAST(sum(o_custkey % 100) AS BIGINT) AS seconds FROM orders GROUP BY ROLLUP (o_orderpriority)""",
    "poor_advice": """WITH m AS (SELECT avg(c_custkey % 5 / 8) AS q, count(*) FILTER (c_custkey % 5 / 8 < 0.4) AS poor, avg((c_custkey % 4 <> 0)::INT) AS e, avg((c_custkey % 3 <> 0)::INT) AS p FROM customer)
SELECT 'Average data quality is ' || format('{:.2f}', q) || ': complete missing fields' AS recommendation FROM m WHERE q < 0.7 UNION ALL SELECT poor || ' records have poor quality' FROM m WHERE poor > 0
UNION ALL SELECT 'More than half of the records lack an e-mail' FROM m WHERE e > 0.5 UNION ALL SELECT 'More than half of the records lack a phone number' FROM m WHERE p > 0.5 UNION ALL SELECT 'Expectation failed: contact_primary_email not_null' FROM m WHERE 1 - e < 0.9""",
    "annotated_contacts": """SELECT CASE c_custkey % 3 WHEN 0 THEN 'deliverable' WHEN 1 THEN 'undeliverable' END AS email_status, CASE c_custkey % 3 WHEN 0 THEN 0.92 WHEN 1 THEN 0.0 END AS email_confidence,
  CASE WHEN c_custkey % 2 = 0 THEN 'deliverable' END AS phone_status, CASE WHEN c_custkey % 2 = 0 THEN 0.85 END AS phone_confidence, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS ids FROM customer GROUP BY 1, 2, 3, 4""",
    "first_filled": "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END, CASE WHEN c_custkey % 5 = 0 THEN ' ' END, 'n' || c_custkey) AS value FROM customer",
    "lead_weights": r"""WITH t AS (SELECT doc_id, length(text) AS c, len(string_split(text, ' ')) AS w, len(regexp_extract_all(text, '[#*$%&|<>!]')) AS s FROM documents),
p AS (SELECT doc_id, 1 / (1 + exp(-(0.4 + 0.8 * (coalesce(c, 0) - 2400) / 2500 - 0.3 * (coalesce(w, 0) - 400) / 420 - 1.7 * (coalesce(s, 0) - 3) / 6))) AS p FROM t)
SELECT doc_id, round(p, 6) AS probability, round(CASE WHEN p <= 0 THEN 0.0 WHEN p >= 1 THEN 1.0 ELSE 1 / (1 + exp(-12 * (p - 0.5))) END, 6) AS lead_score FROM p""",
    "lead_metrics": "SELECT unnest(['roc_auc', 'precision', 'recall', 'own scores', 'better than chance']) AS metric, true AS holds",
    "ranked_orders": "SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) - 1 AS pos, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders",
}
