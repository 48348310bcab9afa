"""SQL of ``table_queries`` and of the linkage queries, for DuckDB."""

from __future__ import annotations

from goldpan.plans.feature_oracle import FEATURE_SQL
from goldpan.plans.oracle import ORGS_SQL, REFINED_SQL, SQL


def lcs(a: str, b: str) -> str:
    """Length of the longest common subsequence of two SQL texts: a fold over the characters of one, each step a running maximum."""
    step = (
        "list_prepend(0, list_transform(range(1, len(l_row)), lambda l_j: list_max(list_transform(range(1, l_j + 1), "
        f"lambda l_i: CASE WHEN substring({b}, CAST(l_i AS INT), 1) = chr(l_c[1]) THEN l_row[l_i] + 1 ELSE l_row[l_i + 1] END))))"
    )
    letters = f"list_transform(string_split({a}, ''), lambda l_x: [ascii(l_x)])"
    return f"list_reduce({letters}, lambda l_row, l_c: {step}, list_transform(range(0, length({b}) + 1), lambda l_z: 0))[-1]"


def ratio(a: str, b: str) -> str:
    return f"(2.0 * {lcs(a, b)} / (length({a}) + length({b})))"


def token_sorted(x: str) -> str:
    return f"array_to_string(list_sort(string_split({x}, ' ')), ' ')"


def partial(short: str, long: str) -> str:
    """Best ratio with a window of the longer text; ``short`` mustn't be longer."""
    window = f"substring({long}, CAST(greatest(0, l_w) AS INT) + 1, CAST(l_w + length({short}) - greatest(0, l_w) AS INT))"
    return f"list_max(list_transform(range(1 - length({short}), length({long})), lambda l_w: {ratio(short, window)}))"


_LISTS = lambda *columns: ", ".join(f"coalesce(string_agg({c}, '|' ORDER BY pos) FILTER (WHERE {c} IS NOT NULL), '') AS {n}" for n, c in columns)
_PAD = lambda k: f"lpad(CAST({k} % 10000000 AS VARCHAR), 7, '0')"
_SUMS = "o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderpriority"
_kinds = lambda *kinds: " UNION ALL ".join(f"SELECT '{k}' AS kind, {_SUMS}" for k in kinds)
_CHECK = lambda name, ok, n, mostly=1.0: f"SELECT '{name}' AS expectation, {n} AS n, count(*) FILTER (WHERE NOT ({ok})) AS n_bad, CASE WHEN {n} > 0 THEN round(1 - count(*) FILTER (WHERE NOT ({ok})) / {n}, 6) ELSE 1.0 END AS share, count(*) FILTER (WHERE NOT ({ok})) = 0 AS success FROM r"

TABLE_SQL: dict[str, str] = {
    "sheets_two": f"""WITH p AS (
  SELECT c_nationkey + 1 AS id, CASE WHEN c_custkey % 7 <> 0 THEN 'Ann ' ELSE '' END || c_name AS n, CASE WHEN c_custkey % 3 = 0 THEN 'Owner' END AS r,
    CASE WHEN c_custkey % 4 <> 0 THEN 'u' || c_custkey || '@ex.example' END AS e, CASE WHEN c_custkey % 2 = 0 THEN '+2782' ELSE '+2783' END || {_PAD('c_custkey')} AS ph, c_custkey AS pos FROM customer
), g AS (SELECT id, {_LISTS(("contact_names", "n"), ("contact_roles", "r"), ("contact_emails", "e"), ("contact_phones", "ph"))} FROM p GROUP BY id)
SELECT 'reachout:' || s_suppkey AS source_record_id, s_name AS organization_name, 'area ' || s_nationkey AS area, CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey || ' Dock' END AS address,
  nullif(concat_ws(' | ', CASE WHEN s_suppkey % 3 = 0 THEN 'School' END, CASE WHEN s_suppkey % 4 <> 0 THEN 'note ' || s_suppkey END), '') AS description,
  nullif(concat_ws(' | ', CASE WHEN s_suppkey % 4 <> 0 THEN 'note ' || s_suppkey END, CASE WHEN s_suppkey % 5 = 0 THEN 'why?' END), '') AS notes, 'https://s' || s_suppkey || '.example' AS website,
  coalesce(contact_names, '') AS contact_names, coalesce(contact_roles, '') AS contact_roles, coalesce(contact_emails, '') AS contact_emails, coalesce(contact_phones, '') AS contact_phones
FROM supplier LEFT JOIN g ON g.id = s_suppkey WHERE s_suppkey % 9 <> 0""",
    "sheets_four": f"""WITH p AS (SELECT c_nationkey + 1 AS id, count(*) AS n, '+2711' || lpad(CAST(min(c_custkey) % 10000000 AS VARCHAR), 7, '0') AS ph, 'Bo ' || arg_min(c_name, c_custkey) AS nm FROM customer GROUP BY 1),
a AS (SELECT c_nationkey + 1 AS id, arg_min(concat_ws(', ', CASE WHEN c_custkey % 3 = 0 THEN 'Field ' || c_custkey END, CASE WHEN c_custkey % 2 = 0 THEN 'Hangar ' || (c_custkey % 10) END), c_custkey) AS address FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 2 = 0 GROUP BY 1),
t AS (SELECT o_custkey % 50 + 1 AS id, arg_max('call ' || o_orderkey || ' | ' || o_orderpriority, o_orderkey) AS note FROM orders GROUP BY 1)
SELECT 'contact:' || s_suppkey AS source_record_id, s_name AS organization_name, address, CASE WHEN s_suppkey % 2 = 0 THEN 'Open' END AS status, note AS notes, p.n AS n_emails, ph AS first_phone, nm AS first_name
FROM supplier LEFT JOIN p ON p.id = s_suppkey LEFT JOIN a ON a.id = s_suppkey LEFT JOIN t ON t.id = s_suppkey""",
    "sheet_one": f"""SELECT 'sacaa:' || s_name AS source_record_id, CASE WHEN s_suppkey % 2 = 0 THEN 'KwaZulu-Natal' ELSE 'Gauteng' END AS province, CASE WHEN s_suppkey % 2 = 0 THEN 'KwaZulu-Natal' ELSE 'Gauteng' END AS area, 'Flight School' AS category,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Active' END AS status, 'https://s' || s_suppkey || '.example' AS website, CASE WHEN s_suppkey % 5 <> 0 THEN 'Cy ' || s_suppkey ELSE '' END AS contact_names,
  CASE WHEN s_suppkey % 4 = 0 THEN 'a' || s_suppkey || '@s.example|b' || s_suppkey || '@s.example' ELSE '' END AS contact_emails, '+2782' || {_PAD('s_suppkey')} AS contact_phones FROM supplier WHERE s_suppkey % 8 <> 0""",
    "formats_read": _kinds("ndjson", "csv", "orc", "parquet"),
    "lookups_read": _kinds("both", "plain", "newest"),
    "published": "WITH n AS (SELECT (SELECT count(*) FROM customer JOIN nation ON c_nationkey = n_nationkey) + (SELECT count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey) AS n) SELECT 'output' AS what, n, 0 AS n_wrong FROM n UNION ALL SELECT 'snapshot', n, 0 FROM n",
    "exported": _kinds("csv", "parquet", "json"),
    "compressed": _kinds("uncompressed", "snappy", "gzip", "lz4", "zstd"),
    "digest_written": "WITH g AS (SELECT user_id, count(*) AS signal_count, array_to_string(list_sort(list(DISTINCT event_type)), ';') AS signal_types FROM events GROUP BY 1) SELECT 'csv' AS kind, * FROM g UNION ALL SELECT 'json', * FROM g",
    "ledger": "SELECT event_type AS source, 'CC-BY' AS license, sha256('terms ' || (event_id % 2)) AS policy_hash, count(*) AS n, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY event_type, event_id % 2",
    "table_sql": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice > 50000 AND o_custkey <> 7 GROUP BY 1",
    "repeated_columns": "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS name__dup1, c_nationkey AS name__dup2 FROM customer",
    "header_matches": """WITH h AS (SELECT lower(n_name) AS target, length(n_name) AS n, n_nationkey % 3 AS k, CASE n_nationkey % 3 WHEN 0 THEN '  ' || upper(n_name[1]) || lower(n_name[2:]) || '?' WHEN 1 THEN n_name || 'x' ELSE '#' || repeat('z', 4 + n_nationkey) END AS header FROM nation)
SELECT header, CASE WHEN k = 2 THEN (SELECT max(target) FROM h) ELSE target END AS target, CASE k WHEN 0 THEN 1.0 WHEN 1 THEN round(2.0 * n / (2 * n + 1), 6) ELSE 0.0 END AS score, CASE WHEN k = 2 THEN 'unmapped' ELSE 'mapped' END AS outcome FROM h""",
    "mapped_columns": "SELECT c_custkey, c_name AS organization_name FROM customer",
    "semantic_types": """WITH c AS (SELECT 'u' || c_custkey || '@x.example' AS mail, '+27 82 ' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS cell, 'https://x.example/' || c_custkey AS site, strftime(DATE '2020-01-01' + CAST(c_custkey AS INT), '%Y-%m-%d') AS day,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE 'odd' END AS kind, c_name, CAST(NULL AS VARCHAR) AS nothing FROM customer),
l AS (SELECT unnest(['mail', 'cell', 'site', 'day', 'c_acctbal', 'kind', 'c_name', 'nothing']) AS column_name, unnest([mail, cell, site, day, c_acctbal, kind, c_name, nothing]) AS v FROM c)
SELECT column_name, CASE WHEN count(v) = 0 THEN 'empty' WHEN avg((v LIKE '%_@_%._%')::INT) > 0.7 THEN 'email' WHEN avg(regexp_matches(v, '^\\+[0-9 ]{7,}$')::INT) > 0.7 THEN 'phone' WHEN avg((v LIKE 'http%')::INT) > 0.7 THEN 'url'
  WHEN avg((try_strptime(v, '%Y-%m-%d') IS NOT NULL)::INT) > 0.7 THEN 'date' WHEN avg((TRY_CAST(v AS DOUBLE) IS NOT NULL)::INT) > 0.7 THEN 'numeric' WHEN count(DISTINCT v) < 10 THEN 'categorical' ELSE 'text' END AS semantic_type FROM l GROUP BY 1""",
    "row_provenance": "SELECT c_custkey, 'src' || c_nationkey AS provenance_source, 0.9 AS provenance_confidence, c_mktsegment AS source_datasets FROM customer WHERE c_custkey = 5",
    "cleaned_text": "WITH t AS (SELECT doc_id, nullif(nfc_normalize(substring(trim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))), 1, 10000)), '') AS t FROM documents) SELECT doc_id, length(t) AS n, sha256(t) AS sha FROM t",
    "row_positions": "SELECT count(*) AS n, 0 AS first, count(*) - 1 AS last, count(*) AS n_distinct FROM orders",
    "reviewer_decisions": "SELECT o_custkey AS l, o_orderkey AS r, CASE WHEN o_orderstatus = 'O' THEN 'match' ELSE 'reject' END AS decision, CASE WHEN o_orderkey % 3 = 0 THEN 0.8 ELSE 0.9 END AS high, CASE WHEN o_orderkey % 3 = 0 THEN 0.5 ELSE 0.7 END AS review FROM orders",
    "enriched_check": f"""WITH r AS (SELECT c_custkey % 10 <> 0 AS s, c_custkey % 12 / 10 AS c, c_custkey % 4 AS k FROM customer)
{_CHECK("provenance_source not_null", "s", "count(*)")} UNION ALL {_CHECK("provenance_confidence between", "c <= 1", "count(*)")} UNION ALL {_CHECK("provenance_network_status in_set", "k <> 2", "count(*) FILTER (WHERE k <> 3)")}""",
    "consent_gate": """WITH c AS (SELECT count(*) FILTER (WHERE c_name IS NOT NULL) AS n, count(*) FILTER (WHERE c_custkey % 3 = 0) AS bad FROM customer)
SELECT 'granted' AS part, n - bad AS n, 'passed' AS said FROM c UNION ALL SELECT 'all', n, bad || ' records require consent but consent is not granted' FROM c""",
    "compliance_columns": "SELECT c_custkey, 'customers' AS data_source, '2024-02-01 00:00:00' AS processed_at, CASE WHEN c_custkey % 3 = 0 THEN 'granted' ELSE 'pending' END AS consent_status, CAST(NULL AS VARCHAR) AS consent_date, '2024-03-02' AS retention_until FROM customer",
    "audit_trail": "SELECT 'export' AS event, '2024-02-01' AS day, CAST(count(*) AS VARCHAR) AS rows, CAST(count(DISTINCT o_custkey) AS VARCHAR) AS customers, count(*) AS n_rows, true AS same FROM orders",
    "archived": "SELECT '20240201' AS snapshot, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers, true AS intact FROM orders",
    "star_written": f"""WITH m AS ({SQL['party_methods']}) SELECT 'contact_methods' AS table_name, CAST(sum(n) AS BIGINT) AS n FROM m WHERE what LIKE 'method:%' UNION ALL SELECT 'aliases', CAST(sum(n) AS BIGINT) FROM m WHERE what LIKE 'alias:%'
UNION ALL SELECT 'roles', CAST(sum(n) AS BIGINT) FROM m WHERE what = 'role' UNION ALL SELECT 'parties', CAST(sum(n) AS BIGINT) FROM ({SQL['party_parties']})""",
    "sql_similarity": f"""WITH p AS (SELECT p_partkey, 'North Air ' || (p_partkey % 90) AS a, CASE p_partkey % 3 WHEN 0 THEN (p_partkey % 90) || ' Air North' WHEN 1 THEN 'South Air ' || (p_partkey % 90) END AS b FROM part),
u AS (SELECT a, b, {ratio(token_sorted('a'), token_sorted('b'))} AS token_sort, {partial('a', 'b')} AS partial FROM (SELECT DISTINCT a, b FROM p WHERE b IS NOT NULL)),
-- Sets of tokens: equal sets give 1; else the number and Air are common, North and South are left.
v AS (SELECT a, b, token_sort, partial, CASE WHEN b LIKE '%North' THEN 1.0 ELSE list_max([{ratio("(c || ' North')", "(c || ' South')")}, 2.0 * length(c) / (2 * length(c) + 6)]) END AS token_set FROM (SELECT *, regexp_extract(b, '[0-9]+') || ' Air' AS c FROM u))
SELECT p_partkey, round(coalesce(token_sort, 0), 6) AS token_sort, round(coalesce(partial, 0), 6) AS partial, round(coalesce(token_set, 0), 6) AS token_set FROM p LEFT JOIN v ON p.a = v.a AND p.b = v.b""",
}

_LINKABLE = """c AS (SELECT c_custkey AS id, c_custkey % 97 AS b, c_custkey % 31 AS e, c_custkey % 11 AS p, '+2782' || lpad(CAST(c_custkey % 11 AS VARCHAR), 7, '0') AS phone,
  'acme ' || CASE WHEN c_custkey % 2 = 0 THEN 'trading ' || (c_custkey % 97) ELSE (c_custkey % 97) || ' trading' END AS name FROM customer),
ph AS (SELECT DISTINCT p, phone FROM c),
pr AS (SELECT x.p AS p1, y.p AS p2, CASE WHEN x.p = y.p THEN 1.0 ELSE """ + partial("x.phone", "y.phone") + """ END AS r FROM ph x, ph y)"""
#: Names of one block have the same tokens, so both name ratios are 1. Sums are in the order of the score's terms, in doubles.
_RULES = f"""{_LINKABLE}, scored AS (
  SELECT l.id AS l, r.id AS r, least(1e0, 45e-2 * 1e0 + 2e-1 * (l.e = r.e)::INT::DOUBLE + 15e-2 * pr.r::DOUBLE + 1e-1 * 1e0 + 5e-2 * 1e0 + 5e-2 * 1e0) AS s
  FROM c l JOIN c r ON l.b = r.b AND l.id < r.id JOIN pr ON pr.p1 = l.p AND pr.p2 = r.p
)"""
_class = lambda high, review: f"CASE WHEN s >= {high}::DOUBLE THEN 'match' WHEN s >= {review}::DOUBLE THEN 'review' ELSE 'reject' END"
_sorted_part = "array_to_string(list_sort(string_split_regex(trim(concat_ws(' ', p_name, p_brand, p_partkey % 50)), '\\s+')), ' ')"
_weight = lambda column, *levels: "CASE " + column + "".join(f" WHEN {i} THEN log2({m}::DOUBLE / {u})" for i, (m, u) in enumerate(levels)) + " ELSE 0 END"
_PLACES = "p AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 <> 9 THEN (s_suppkey * 37 % 1400) / 10 - 70 END AS y, (s_suppkey * 73 % 3600) / 10 - 180 AS x FROM supplier)"
_km = "2 * 6371.0088 * asin(sqrt(least(1.0, pow(sin(radians(b.y - a.y) / 2), 2) + cos(radians(a.y)) * cos(radians(b.y)) * pow(sin(radians(b.x - a.x) / 2), 2))))"

LINK_SQL: dict[str, str] = {
    "rule_linkage": f"WITH {_RULES} SELECT l, r, round(s, 6) AS match_probability, {_class(0.9, 0.8)} AS classification FROM scored",
    "review_queue": f"WITH {_RULES} SELECT l, r, 'Acme ' || CASE WHEN l % 2 = 0 THEN 'Trading ' || (l % 97) ELSE (l % 97) || ' Trading' END AS left_name FROM scored WHERE {_class(0.95, 0.8)} = 'review'",
    "linkage_written": f"WITH {_RULES} SELECT {_class(0.9, 0.8)} AS classification, count(*) AS n FROM scored GROUP BY 1",
    "fellegi_sunter": f"""WITH {_LINKABLE}, g AS (SELECT b, name, e, p, min(id) AS id, count(*) AS n FROM c GROUP BY 1, 2, 3, 4),
nm AS (SELECT DISTINCT name, CAST(b AS VARCHAR) AS b FROM c), nb AS (SELECT DISTINCT b FROM nm),
-- Sorted names are a number and " acme trading", so they share those 13 letters and what the numbers share.
br AS (SELECT x.b AS b1, y.b AS b2, 2.0 * (13 + {lcs('x.b', 'y.b')}) / (26 + length(x.b) + length(y.b)) AS r FROM nb x, nb y),
nr AS (SELECT x.name AS n1, y.name AS n2, CASE WHEN x.name = y.name THEN 0 WHEN x.b = y.b OR r >= 0.96 THEN 1 WHEN greatest(r, 24.0 / (25 + length(x.b)), 24.0 / (25 + length(y.b))) >= 0.9 THEN 2 ELSE 3 END AS k
  FROM nm x JOIN br ON b1 = x.b JOIN nm y ON b2 = y.b),
pairs AS (SELECT l.name AS n1, r.name AS n2, l.e = r.e AS same, l.p AS p1, r.p AS p2, l.n * r.n AS n FROM g l JOIN g r ON l.id < r.id AND (l.b = r.b OR l.e = r.e)
  UNION ALL SELECT name, name, true, p, p, n * (n - 1) // 2 FROM g WHERE n > 1),
v AS (SELECT nr.k AS gn, CASE WHEN same THEN 0 ELSE 1 END AS ge, CASE WHEN pairs.p1 = pairs.p2 THEN 0 WHEN pr.r >= 0.95 THEN 1 ELSE 2 END AS gp, n FROM pairs JOIN nr ON nr.n1 = pairs.n1 AND nr.n2 = pairs.n2 JOIN pr ON pr.p1 = pairs.p1 AND pr.p2 = pairs.p2)
SELECT gn AS gamma_link_name, ge AS gamma_link_email, gp AS gamma_link_phone, CAST(sum(n) AS BIGINT) AS n, round(max(log2(1e-4 / (1 - 1e-4)) + {_weight('gn', (0.97, 0.001), (0.86, 0.002), (0.75, 0.01), (0.05, 0.987))} + {_weight('ge', (0.98, 0.01), (0.01, 0.99))}
  + {_weight('gp', (0.9, 0.01), (0.7, 0.02), (0.05, 0.97))} + log2(0.85::DOUBLE / 0.2) + log2(0.96::DOUBLE / 0.05)), 5) AS match_weight FROM v GROUP BY 1, 2, 3""",
    "fuzzy_parts": f"""WITH s AS (SELECT p_partkey AS id, {_sorted_part} AS s FROM part), d AS (SELECT DISTINCT s FROM s),
near AS (SELECT x.s AS x, y.s AS y FROM d x JOIN d y ON x.s < y.s AND abs(length(x.s) - length(y.s)) <= 0.04 * (length(x.s) + length(y.s)) AND levenshtein(x.s, y.s) <= 0.04 * (length(x.s) + length(y.s))),
ok AS (SELECT x, y FROM near WHERE {ratio('x', 'y')} >= 0.96),
pairs AS (SELECT least(a.id, b.id) AS l, greatest(a.id, b.id) AS r FROM ok JOIN s a ON a.s = x JOIN s b ON b.s = y UNION ALL SELECT a.id, b.id FROM s a JOIN s b ON a.s = b.s AND a.id < b.id)
SELECT count(*) AS n_pairs, CAST(sum(l) AS BIGINT) AS sum_l, CAST(sum(r) AS BIGINT) AS sum_r FROM pairs""",
    "fuzzy_phones": f"""WITH s AS (SELECT c_custkey AS id, '+27' || lpad(CAST(c_custkey * 7919 % 1000003 AS VARCHAR), 7, '0') || CASE WHEN c_custkey % 3 = 0 THEN ' x' ELSE '' END AS s FROM customer), d AS (SELECT DISTINCT s FROM s),
near AS (SELECT x.s AS x, y.s AS y FROM d x JOIN d y ON length(x.s) < length(y.s) OR length(x.s) = length(y.s) AND x.s < y.s
  WHERE levenshtein(x.s, y.s[1:length(x.s)]) <= 2 OR levenshtein(x.s, y.s[-length(x.s):]) <= 2),
ok AS (SELECT x, y FROM near WHERE {partial('x', 'y')} >= 0.92),
pairs AS (SELECT least(a.id, b.id) AS l, greatest(a.id, b.id) AS r FROM ok JOIN s a ON a.s = x JOIN s b ON b.s = y UNION ALL SELECT a.id, b.id FROM s a JOIN s b ON a.s = b.s AND a.id < b.id)
SELECT count(*) AS n_pairs, CAST(sum(l) AS BIGINT) AS sum_l, CAST(sum(r) AS BIGINT) AS sum_r FROM pairs""",
    "entity_registry": """WITH s AS (SELECT s_suppkey AS k, s_suppkey % 2 = 0 AND s_suppkey % 3 <> 0 AS known FROM supplier), m AS (SELECT max(k) AS m FROM s WHERE k % 3 <> 0)
SELECT CASE WHEN known THEN k ELSE m + row_number() OVER (PARTITION BY known ORDER BY k) END AS entity_id, CASE WHEN k % 2 = 0 THEN 'Old Firm ' ELSE 'New Firm ' END || k AS organization_name, 1 AS n_variants, CASE WHEN known AND k % 4 = 0 THEN 2 ELSE 1 END AS n_statuses FROM s, m
UNION ALL SELECT k, 'Firm ' || k, 1, 1 FROM s WHERE k % 3 <> 0 AND NOT known""",
    "supplier_clusters": f"""WITH RECURSIVE {_PLACES}, e AS (SELECT b.id, list(a.id) AS nb FROM p a JOIN p b ON a.id < b.id WHERE {_km} <= 1500 GROUP BY 1),
o AS (SELECT p.id, coalesce(nb, []) AS nb, row_number() OVER (ORDER BY p.id) AS i FROM p LEFT JOIN e USING (id) WHERE y IS NOT NULL),
r AS (SELECT 0::BIGINT AS i, []::BIGINT[] AS leaders UNION ALL SELECT o.i, CASE WHEN list_has_any(leaders, nb) THEN leaders ELSE list_append(leaders, id) END FROM r JOIN o ON o.i = r.i + 1),
l AS (SELECT leaders FROM r ORDER BY i DESC LIMIT 1)
SELECT p.id, CASE WHEN y IS NULL THEN -1 ELSE coalesce(list_min(list_filter(nb, lambda x: list_contains(leaders, x))), p.id) END AS leader FROM p LEFT JOIN o USING (id), l""",
    "stream_scores": f"WITH s AS ({SQL['intent_scores']}) SELECT s.seq, 'user-' || user_id AS target_slug, signal_type, score FROM s JOIN events ON event_id = seq JOIN customer ON c_custkey = user_id",
}

_SCORED = f"""{REFINED_SQL}, q AS (SELECT *, ((contact_primary_email IS NOT NULL)::INT + (contact_primary_phone IS NOT NULL)::INT + (website IS NOT NULL)::INT + (province IS NOT NULL)::INT + (address_primary IS NOT NULL)::INT) / 5 AS s FROM refined)"""
_COUNTS = {
    "organization_name not_null": ("count(*)", 1.0), "organization_slug not_null": ("count(*)", 1.0), "data_quality_score between": ("count(*)", 1.0), "contact_primary_email matches": ("count(contact_primary_email)", 0.85),
    "contact_primary_phone matches": ("count(contact_primary_phone)", 0.85), "website matches": ("count(website)", 0.75), "country in_set": ("count(*)", 1.0), "contact_primary_email_status in_set": ("count(contact_primary_email)", 1.0),
    "contact_primary_phone_status in_set": ("count(contact_primary_phone)", 1.0), "contact_primary_email_confidence between": ("count(contact_primary_email)", 1.0), "contact_primary_phone_confidence between": ("count(contact_primary_phone)", 1.0),
    "contact_email_confidence_avg between": ("count(contact_primary_email)", 1.0), "contact_phone_confidence_avg between": ("count(contact_primary_phone)", 1.0), "contact_verification_score_avg between": ("count(coalesce(contact_primary_email, contact_primary_phone))", 1.0),
}

REFINED_QUERIES_SQL: dict[str, str] = {
    "refined_expectations": f"WITH {_SCORED} " + " UNION ALL ".join(f"SELECT '{name}' AS expectation, {n} AS n, 0 AS n_bad, 1.0 AS share, {mostly} AS mostly, true AS success FROM q" for name, (n, mostly) in _COUNTS.items()),
    "refined_report": f"WITH {_SCORED} SELECT count(*) AS total_records, round(avg(s), 6) AS mean_quality, min(s) AS min_quality, max(s) AS max_quality, true AS expectations_passed, 0 AS n_failures, (SELECT count(*) FROM orgs WHERE source_dataset = 'Customers') AS customers, (SELECT count(*) FROM orgs WHERE source_dataset = 'Suppliers') AS suppliers, 0 AS conflicts FROM q",
    "refined_advice": f"""WITH {_SCORED}, m AS (SELECT avg(s) AS s, count(*) FILTER (WHERE s < 0.4) AS poor, avg((contact_primary_email IS NULL)::INT) AS e, avg((contact_primary_phone IS NULL)::INT) AS p FROM q)
SELECT 'Average data quality is ' || format('{{:.2f}}', s) || ': complete missing fields' AS recommendation FROM m WHERE s < 0.7 UNION ALL SELECT poor || ' records have poor quality' FROM m WHERE poor > 0
UNION ALL SELECT 'More than half of the records lack an e-mail' FROM m WHERE e > 0.5 UNION ALL SELECT 'More than half of the records lack a phone number' FROM m WHERE p > 0.5""",
    "quality_distribution": f"WITH {_SCORED} SELECT round(avg(s), 6) AS mean, min(s) AS min, max(s) AS max FROM q",
    "refined_contract": f"""WITH {_SCORED}, n AS (SELECT count(*) FILTER (WHERE province IS NULL) AS n FROM q)
SELECT 'missing_column' AS "check", 'notes' AS field, 1 AS n UNION ALL SELECT 'extra_column', 'spare', 1 UNION ALL SELECT 'null', 'source_datasets', n FROM n WHERE n > 0""",
    "refined_schema": f"WITH {_SCORED} SELECT 'valid' AS part, count(*) AS n, round(sum(s), 4) AS score FROM q WHERE province IS NOT NULL UNION ALL SELECT 'invalid', count(*), NULL FROM q WHERE province IS NULL",
    "feature_order": """WITH f AS (SELECT min(c_custkey) AS id FROM customer GROUP BY c_custkey % 97)
SELECT id, 'rows>linkage>geography>enrichment>compliance' AS trail, coalesce('f' || s_suppkey, 'none') AS region, CASE WHEN s_suppkey IS NULL THEN 'default' ELSE 'geocoder' END AS provenance_source, 'pending' AS consent_status FROM f LEFT JOIN supplier ON s_suppkey = id % 50""",
}

ALL_SQL: dict[str, str] = SQL | TABLE_SQL | LINK_SQL | REFINED_QUERIES_SQL | FEATURE_SQL
