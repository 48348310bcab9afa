"""SQL for DuckDB that gives the rows of the queries."""

from __future__ import annotations

from goldpan.plans.tables import ORGS_SQL

_PII = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "URL": r"https?://[^\s<>\"'']+",
    "IBAN_CODE": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    "CREDIT_CARD": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
    "ID_NUMBER": r"\b[0-9]{13}\b",
    "IP_ADDRESS": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
    "PHONE_NUMBER": r"\+[0-9][0-9 ()-]{7,14}[0-9]",
}


def _luhn(x: str) -> str:
    """Whether digits pass the Luhn test."""
    d = f"replace(replace({x}, ' ', ''), '-', '')"
    digit = f"CAST(substring({d}, len({d}) - i + 1, 1) AS INT)"
    return f"list_sum(list_transform(range(1, len({d}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN {digit} * 2 - 9 ELSE {digit} * 2 END)) % 10 = 0"


def _has(kind: str, text: str) -> str:
    if kind in ("CREDIT_CARD", "ID_NUMBER"):
        return f"len(list_filter(regexp_extract_all({text}, '{_PII[kind]}'), lambda x: {_luhn('x')})) > 0"
    return f"regexp_matches({text}, '{_PII[kind]}')"


def _types(text: str) -> str:
    return "list_sort(list_filter([" + ", ".join(f"CASE WHEN {_has(k, text)} THEN '{k}' END" for k in _PII) + "], lambda x: x IS NOT NULL))"


def _replaced(text: str) -> str:
    out = text
    for k, p in _PII.items():
        if k in ("CREDIT_CARD", "ID_NUMBER"):  # hit by hit: what stands between them, and each that fails the test, stays
            hit, i = f"regexp_extract_all({out}, '{p}')", f"l_{k}"
            new = f"CASE WHEN {_luhn(f'{hit}[{i}]')} THEN '<{k}>' ELSE {hit}[{i}] END"
            joined = f"array_to_string(list_transform(range(1, len({hit}) + 2), lambda {i}: string_split_regex({out}, '{p}')[{i}] || CASE WHEN {i} <= len({hit}) THEN {new} ELSE '' END), '')"
            out = f"(CASE WHEN {_has(k, out)} THEN {joined} ELSE {out} END)"
        else:
            out = f"regexp_replace({out}, '{p}', '<{k}>', 'g')"
    return out


def _logistic(x: str) -> str:
    return f"(CASE WHEN ({x}) <= 0 THEN 0.0 WHEN ({x}) >= 1 THEN 1.0 ELSE 1 / (1 + exp(-12 * (({x}) - 0.5))) END)"


_best = lambda c, name=None: f"arg_min({c}, rnk) FILTER (WHERE {c} IS NOT NULL) AS {name or c}"

REFINED_SQL = f"""{ORGS_SQL},
seconds AS (
  SELECT slug, string_agg(email, ';' ORDER BY r) AS more FROM (
    SELECT slug, email, min(rnk) AS r, row_number() OVER (PARTITION BY slug ORDER BY min(rnk)) AS n FROM ranked WHERE email IS NOT NULL GROUP BY slug, email
  ) WHERE n > 1 GROUP BY slug
),
refined AS (
  SELECT slug AS organization_slug, arg_min(organization_name, pos) AS organization_name, {_best('province')}, {_best('address', 'address_primary')}, {_best('status')}, {_best('website')},
    {_best('email', 'contact_primary_email')}, {_best('phone', 'contact_primary_phone')}, min(rnk) FILTER (WHERE email IS NOT NULL) AS email_rank, min(rnk) FILTER (WHERE phone IS NOT NULL) AS phone_rank,
    array_to_string(list_sort(list(DISTINCT source_dataset)), '; ') AS source_datasets, max(seen) AS last_interaction_date
  FROM ranked GROUP BY slug
),
people AS (
  SELECT f.*, coalesce(p.contact, (SELECT arg_min(contact, rnk) FROM ranked x WHERE x.slug = f.organization_slug)) AS person,
    coalesce(p.role, (SELECT arg_min(role, rnk) FILTER (WHERE role IS NOT NULL) FROM ranked x WHERE x.slug = f.organization_slug)) AS person_role, coalesce(p.priority, 0) / 2.0 AS source_score
  FROM refined f LEFT JOIN ranked p ON p.slug = f.organization_slug AND p.rnk = coalesce(f.email_rank, f.phone_rank)
)"""

_CASCADE = """
s AS (SELECT s_name, s_nationkey FROM supplier QUALIFY row_number() OVER (PARTITION BY lower(s_name) ORDER BY s_suppkey) = 1),
c AS (
  SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'known' END AS region0, 's' || s_nationkey AS a, n_name AS b
  FROM customer LEFT JOIN s ON lower(s_name) = lower('Supplier#' || lpad(CAST(c_custkey % 150 AS VARCHAR), 9, '0'))
  LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey < 2
)"""

_SIGNALS = f"""
e AS (
  SELECT event_id AS seq, 'user-' || user_id AS target_slug, CASE event_type WHEN 'view' THEN 'news' WHEN 'click' THEN 'traffic' WHEN 'signup' THEN 'hiring' WHEN 'purchase' THEN 'tech' ELSE event_type END AS signal_type,
    value / 200 AS intent, value / 100 - 0.5 AS detail, event_id % 3 = 0 AS pilot, date_trunc('second', ts) AS observed_at, CASE WHEN event_id % 2 = 0 THEN 'h' || event_id END AS insight FROM events
), g AS (
  SELECT *, least(1, greatest(0, intent + CASE signal_type WHEN 'news' THEN 0.25 * greatest(detail, 0) WHEN 'hiring' THEN 0.2 * greatest(CASE WHEN detail = 0 THEN 0.6 ELSE detail END, 0)
    WHEN 'traffic' THEN 0.1 * greatest(detail, 0) WHEN 'tech' THEN CASE WHEN pilot THEN 0.25 ELSE 0.2 END ELSE 0 END)) AS score FROM e
)"""

_CONSENT = """
c AS (
  SELECT c_custkey, c_nationkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'granted' WHEN 'MACHINERY' THEN 'denied' WHEN 'FURNITURE' THEN 'maybe' WHEN 'HOUSEHOLD' THEN 'pending' END AS s0,
    (c_custkey % 3 = 0)::INT + (c_custkey % 2 = 0 AND c_name IS NOT NULL)::INT AS n_fields FROM customer
)"""
_REASON = "CASE WHEN s IS NULL THEN 'missing' WHEN s IN ('pending', 'unknown', 'review') THEN 'pending' WHEN s IN ('revoked', 'denied', 'withdrawn', 'expired') THEN 'denied' WHEN s NOT IN ('granted', 'approved', 'allowed') THEN 'unknown' END"

_NAMES = lambda table, columns: " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_distinct, round(100.0 * (count(*) - count({c})) / count(*), 2) AS pct_missing, round(100.0 * count(DISTINCT {c}) / count(*), 2) AS pct_distinct FROM {table}" for c in columns
)
_HAVERSINE = "2 * 6371.0088 * asin(sqrt(least(1, power(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude)) * cos(radians(b.latitude)) * power(sin(radians(b.longitude - a.longitude) / 2), 2))))"
_PLACES = "p AS (SELECT s_suppkey AS id, CASE WHEN s_suppkey % 10 <> 9 THEN (s_suppkey * 37 % 1400) / 10 - 70 END AS latitude, (s_suppkey * 73 % 3600) / 10 - 180 AS longitude FROM supplier)"
_MAIL_STATUS = lambda c, conf: f"CASE WHEN {c} IS NULL THEN NULL WHEN split_part({c}, '@', 2) IN ('example.com', 'example.org', 'example.net') THEN {('0.92' if conf else chr(39) + 'deliverable' + chr(39))} ELSE {('0.35' if conf else chr(39) + 'risky' + chr(39))} END"

SQL: dict[str, str] = {
    "entity_survivorship": f"""WITH {REFINED_SQL}
SELECT r.organization_slug, organization_name, province, address_primary, status, website, contact_primary_email, contact_primary_phone, coalesce(more, '') AS contact_secondary_emails, source_datasets, last_interaction_date,
  ((contact_primary_email IS NOT NULL)::INT + (contact_primary_phone IS NOT NULL)::INT + (website IS NOT NULL)::INT + (province IS NOT NULL)::INT + (address_primary IS NOT NULL)::INT) / 5 AS data_quality_score,
  coalesce(nullif(concat_ws(';', CASE WHEN contact_primary_email IS NULL THEN 'missing_contact_email' END, CASE WHEN contact_primary_phone IS NULL THEN 'missing_contact_phone' END, CASE WHEN website IS NULL THEN 'missing_website' END,
    CASE WHEN province IS NULL THEN 'missing_province' END, CASE WHEN address_primary IS NULL THEN 'missing_address' END), ''), 'none') AS data_quality_flags
FROM refined r LEFT JOIN seconds ON seconds.slug = r.organization_slug""",
    "entity_contacts": f"""WITH {REFINED_SQL}, v AS (
  SELECT *, CASE WHEN contact_primary_email IS NOT NULL THEN 0.35 ELSE 0 END AS ec, CASE WHEN contact_primary_phone IS NOT NULL THEN 0.85 ELSE 0 END AS pc FROM people
), w AS (
  SELECT *, CASE WHEN ec > 0 AND pc > 0 THEN (ec + pc) / 2 ELSE ec + pc END AS m FROM v
)
SELECT organization_slug, person AS contact_primary_name, person_role AS contact_primary_role, CASE WHEN contact_primary_email IS NOT NULL THEN 'risky' END AS contact_primary_email_status, CASE WHEN contact_primary_phone IS NOT NULL THEN 'deliverable' END AS contact_primary_phone_status,
  round(nullif({_logistic('m')} * CASE WHEN ec > 0 THEN 0.6 ELSE 1 END, 0), 6) AS verification,
  round({_logistic("0.3 * ((person IS NOT NULL)::INT + (contact_primary_email IS NOT NULL)::INT + (contact_primary_phone IS NOT NULL)::INT + (person_role IS NOT NULL)::INT) / 4 + 0.25 * ec + 0.15 * pc + 0.2 * CASE WHEN email_rank IS NULL AND phone_rank IS NULL THEN (SELECT arg_min(priority, rnk) FROM ranked x WHERE x.slug = organization_slug) / 2.0 ELSE source_score END")}, 6) AS lead_score
FROM w""",
    "entity_conflicts": f"""WITH {ORGS_SQL}, v AS (
  SELECT slug, 'province' AS field, province AS value, rnk, source_dataset FROM ranked UNION ALL SELECT slug, 'address', address, rnk, source_dataset FROM ranked UNION ALL SELECT slug, 'status', status, rnk, source_dataset FROM ranked
  UNION ALL SELECT slug, 'website', website, rnk, source_dataset FROM ranked UNION ALL SELECT slug, 'contact_emails', email, rnk, source_dataset FROM ranked UNION ALL SELECT slug, 'contact_phones', phone, rnk, source_dataset FROM ranked
  UNION ALL SELECT slug, 'contact_names', contact, rnk, source_dataset FROM ranked UNION ALL SELECT slug, 'contact_roles', role, rnk, source_dataset FROM ranked
), d AS (SELECT slug, field, value, min(rnk) AS r, arg_min(source_dataset, rnk) AS source FROM v WHERE value IS NOT NULL GROUP BY 1, 2, 3)
SELECT slug, field, arg_min(value, r) AS value, arg_min(source, r) AS chosen_source, count(*) - 1 AS n_alternatives FROM d GROUP BY slug, field HAVING count(*) > 1""",
    "source_breakdown": "SELECT 'Customers' AS source_dataset, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'Suppliers', count(*) FROM supplier JOIN nation ON s_nationkey = n_nationkey",
    "value_counts": "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1",
    "column_stats": "SELECT round(avg(l_extendedprice), 4) AS mean, min(l_extendedprice) AS min, max(l_extendedprice) AS max FROM lineitem",
    "latest_interaction": "SELECT o_custkey, strftime(max(o_orderdate) FILTER (WHERE o_orderkey % 4 < 3), '%Y-%m-%d') AS last_seen FROM orders GROUP BY o_custkey",
    "profile_customer": _NAMES("customer", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")),
    "completeness_documents": "WITH t AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) " + " UNION ALL ".join(f"SELECT '{c}' AS field, round(100 * avg((coalesce(trim(CAST({c} AS VARCHAR)), '') <> '')::INT), 2) AS pct_filled FROM t" for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")),
    "duplicate_documents": "SELECT count(*) AS n_rows, count(*) - count(DISTINCT (text, lang)) AS n_duplicates FROM documents",
    "first_document": "SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents GROUP BY text",
    "slug_dedup": """WITH k AS (SELECT s_suppkey, CASE WHEN s_suppkey % 7 <> 0 THEN 'supplier-sons-' || (s_suppkey % 20) END AS slug FROM supplier), j AS (SELECT *, coalesce(slug, 'entity-' || s_suppkey) AS key FROM k)
SELECT min(s_suppkey) AS s_suppkey, any_value(slug) AS slug, key FROM j GROUP BY key""",
    "daily_list": f"""WITH e AS (SELECT user_id, avg(least(1, greatest(0, value / 100))) AS i FROM events GROUP BY 1), c AS (
  SELECT c_custkey, c_nationkey || '-' || c_mktsegment AS slug, (0.3 * least(1, greatest(0, c_acctbal / 10000)) + 0.1 * coalesce(i, 0)) / 0.4 AS x FROM customer LEFT JOIN e ON c_custkey = user_id
), s AS (SELECT slug, c_custkey, {_logistic('x')} AS v FROM c), b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY slug ORDER BY v DESC, slug) = 1)
SELECT slug, c_custkey, round(v, 6) AS lead_score FROM b ORDER BY v DESC, slug LIMIT 50""",
    "expectation_suite": """SELECT 'o_comment exists' AS expectation, 0 AS n, 1 AS n_bad, 0.0 AS share, false AS success
UNION ALL SELECT 'o_custkey not_null', count(*), count(*) FILTER (WHERE o_custkey IS NULL), round(avg((o_custkey IS NOT NULL)::INT), 6), avg((o_custkey IS NOT NULL)::INT) >= 1 FROM orders
UNION ALL SELECT 'o_totalprice between', count(o_totalprice), count(*) FILTER (WHERE o_totalprice NOT BETWEEN 1000 AND 400000), round(avg((o_totalprice BETWEEN 1000 AND 400000)::INT), 6), avg((o_totalprice BETWEEN 1000 AND 400000)::INT) >= 0.9 FROM orders
UNION ALL SELECT 'o_orderstatus in_set', count(o_orderstatus), count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F')), round(avg((o_orderstatus IN ('O', 'F'))::INT), 6), avg((o_orderstatus IN ('O', 'F'))::INT) >= 0.95 FROM orders
UNION ALL SELECT 'o_orderpriority matches', count(o_orderpriority), count(*) FILTER (WHERE NOT regexp_matches(o_orderpriority, '^[1-5]-')), round(avg(regexp_matches(o_orderpriority, '^[1-5]-')::INT), 6), avg(regexp_matches(o_orderpriority, '^[1-5]-')::INT) >= 1 FROM orders""",
    "contract_check": """SELECT * FROM (SELECT 'missing_column' AS "check", 'c_phone' AS field, 1 AS n UNION ALL SELECT 'extra_column', 'c_nationkey', 1
UNION ALL SELECT 'type', 'c_acctbal', count(*) FILTER (WHERE c_acctbal <> floor(c_acctbal) OR c_acctbal IS NOT NULL) FROM customer
UNION ALL SELECT 'key', 'c_nationkey', count(*) - count(DISTINCT c_nationkey) FROM customer) WHERE n > 0""",
    "valid_orders": "SELECT concat_ws(',', CASE WHEN NOT coalesce(o_totalprice > 5000, false) THEN 'price' END, CASE WHEN NOT coalesce(o_orderstatus <> 'P', false) THEN 'status' END) AS errors, count(*) AS n FROM orders GROUP BY 1",
    "page_websites": r"""SELECT page_id, regexp_replace('https://' || regexp_replace(lower(regexp_extract(u, '^([^/?#]*)', 1)), '^www\.', '') || regexp_replace(regexp_extract(u, '^[^/?#]*(/[^?#;]*)?', 1), '/+$', ''), '/+$', '') AS website,
  regexp_matches(url, '(?i)^https?://(?:(?:[A-Z0-9](?:[A-Z0-9-]{0,61}[A-Z0-9])?\.)+[A-Z]{2,6}\.?|localhost|\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?::\d+)?(?:/?|[/?]\S+)$') AS is_valid
FROM (SELECT page_id, url, regexp_replace(trim(url), '(?i)^https?://', '') AS u FROM pages)""",
    "page_content": r"""WITH p AS (SELECT page_id, html, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS t FROM pages)
SELECT page_id, nullif(trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')), '') AS page_title, length(t) AS page_text_length, length(t) > 0 AS page_enriched,
  list_filter(string_split(t, ' '), lambda w: contains(w, '@') AND contains(w, '.'))[1] AS first_email FROM p""",
    "pii_documents": f"SELECT doc_id, len(t) > 0 AS text_has_pii, array_to_string(t, ',') AS text_pii_types FROM (SELECT doc_id, {_types('text')} AS t FROM documents)",
    "pii_redacted": f"SELECT conv_id || ':' || turn AS key, sha256({_replaced('text')}) AS redacted FROM conversations",
    "pii_events": f"SELECT entity, count(*) AS n FROM (SELECT unnest({_types('text')}) AS entity FROM conversations) GROUP BY entity",
    "consent_report": f"WITH {_CONSENT}, s AS (SELECT s0 AS s FROM c WHERE n_fields > 0) SELECT coalesce(s, 'untracked') AS consent, count(*) AS n, count({_REASON}) AS violations FROM s GROUP BY 1",
    "consent_violations": f"WITH {_CONSENT}, s AS (SELECT c_custkey, n_fields, CASE WHEN n_regionkey = 0 THEN 'approved' ELSE s0 END AS s FROM c LEFT JOIN nation ON c_nationkey = n_nationkey WHERE n_fields > 0) SELECT c_custkey, s AS consent, {_REASON} AS reason, n_fields FROM s WHERE {_REASON} IS NOT NULL",
    "lookup_cascade": f"WITH {_CASCADE} SELECT c_custkey, coalesce(region0, a, b) AS region, CASE WHEN a IS NOT NULL THEN 'lookup' WHEN b IS NOT NULL THEN 'derived' ELSE 'original' END AS provenance_source, CASE WHEN a IS NOT NULL THEN 0.95 WHEN b IS NOT NULL THEN 0.9 ELSE 1.0 END AS provenance_confidence, CASE WHEN coalesce(a, b) IS NULL THEN 'none' ELSE 'deterministic' END AS provenance_strategy FROM c",
    "cascade_entries": f"""WITH {_CASCADE}, t AS (
  SELECT 'lookup' AS source, CASE WHEN a IS NOT NULL THEN 'deterministic' ELSE 'none' END AS strategy, 'disabled' AS network_status FROM c
  UNION ALL SELECT 'derived', CASE WHEN b IS NOT NULL THEN 'deterministic' ELSE 'none' END, 'disabled' FROM c WHERE a IS NULL
  UNION ALL SELECT 'research', 'none', 'skipped: network disabled' FROM c
)
SELECT 'source' AS dimension, source AS value, count(*) AS n FROM t GROUP BY 2 UNION ALL SELECT 'strategy', strategy, count(*) FROM t GROUP BY 2 UNION ALL SELECT 'network_status', network_status, count(*) FROM t GROUP BY 2""",
    "intent_scores": f"WITH {_SIGNALS} SELECT seq, signal_type, round(score, 6) AS score FROM g",
    "intent_digest": f"""WITH {_SIGNALS}, u AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY target_slug, signal_type, observed_at ORDER BY seq DESC) = 1),
t AS (SELECT target_slug, string_agg(insight, ';' ORDER BY seq) AS top_insights FROM (SELECT * FROM u WHERE insight IS NOT NULL QUALIFY row_number() OVER (PARTITION BY target_slug ORDER BY seq) <= 5) GROUP BY 1),
m AS (SELECT target_slug, avg(score) AS x, count(*) AS signal_count, array_to_string(list_sort(list(DISTINCT signal_type)), ';') AS signal_types, strftime(max(observed_at), '%Y-%m-%d %H:%M:%S') AS last_observed_at FROM u GROUP BY 1)
SELECT m.target_slug, round({_logistic('x')}, 6) AS score, signal_count, signal_types, last_observed_at, top_insights FROM m LEFT JOIN t USING (target_slug)""",
    "intent_since": "SELECT event_type, count(*) AS n FROM events WHERE ts >= TIMESTAMP '2024-01-20' GROUP BY 1",
    "signal_cache": """WITH live AS (SELECT * FROM events WHERE event_id % 2 = 0 AND ts >= TIMESTAMP '2024-01-29 00:00:00'), u AS (
  SELECT event_type, event_id FROM live UNION ALL SELECT event_type, event_id FROM events f WHERE event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM live l WHERE l.user_id = f.user_id AND l.event_type = f.event_type)
) SELECT event_type AS signal_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM u GROUP BY 1""",
    "response_cache": """SELECT substring(sha256('kind:' || event_type || '|user:' || user_id), 1, 16) AS key, arg_max(value, (ts, -value)) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-21 00:00:00' GROUP BY 1""",
    "stream_dedup": "SELECT event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, date_trunc('hour', ts) FROM events) GROUP BY 1",
    "stream_windows": "SELECT user_id AS target_slug, strftime(ts, '%Y-%m-%d') AS day, round(avg(least(1, greatest(0, value / 100))), 6) AS mean_score, count(*) AS signal_count FROM events GROUP BY 1, 2",
    "stream_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT user_id, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g), n AS (SELECT user_id, s, count(*) AS c FROM s GROUP BY 1, 2)
SELECT user_id AS target_slug, count(*) AS sessions, max(c) AS longest FROM n GROUP BY 1""",
    "backfill_orders": """WITH days AS (SELECT CAST(unnest(generate_series(DATE '1998-01-01', DATE '1998-01-31', INTERVAL 1 DAY)) AS DATE) AS day), o AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1)
SELECT CAST(days.day AS VARCHAR) AS run_date, version, 'refined/' || version || '/' || days.day AS path, coalesce(n, 0) AS n FROM days CROSS JOIN (VALUES ('v1'), ('v2')) v(version) LEFT JOIN o USING (day)""",
    "linkage_clusters": """WITH c AS (SELECT c_custkey, c_nationkey, floor(c_acctbal / 20) AS b FROM customer WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL) SELECT c_custkey, min(c_custkey) OVER (PARTITION BY c_nationkey, b) AS cluster_id FROM c""",
    "near_suppliers": f"WITH {_PLACES} SELECT a.id AS l, b.id AS r, round({_HAVERSINE}, 3) AS km FROM p a JOIN p b ON a.id < b.id WHERE {_HAVERSINE} <= 900",
    "party_parties": f"""WITH {REFINED_SQL}, k AS (SELECT *, coalesce('email:' || lower(contact_primary_email), 'phone:' || contact_primary_phone, 'name:' || lower(person)) AS key FROM people)
SELECT kind, display_name, count(*) AS n FROM (SELECT 'organisation' AS kind, organization_name AS display_name FROM k UNION ALL SELECT 'person', arg_min(person, organization_slug) FROM k WHERE key IS NOT NULL GROUP BY key) GROUP BY 1, 2""",
    "party_methods": f"""WITH {REFINED_SQL}, k AS (SELECT p.*, coalesce(more, '') AS more, coalesce('email:' || lower(contact_primary_email), 'phone:' || contact_primary_phone, 'name:' || lower(person)) AS key FROM people p LEFT JOIN seconds ON seconds.slug = p.organization_slug),
ph AS (SELECT slug, greatest(count(DISTINCT phone) - 1, 0) AS n FROM ranked GROUP BY slug)
SELECT 'method:email' AS what, CAST(count(contact_primary_email) + sum(len(list_filter(string_split(more, ';'), lambda x: x <> ''))) AS BIGINT) AS n FROM k
UNION ALL SELECT 'method:phone', CAST(count(contact_primary_phone) + sum(ph.n) AS BIGINT) FROM k JOIN ph ON ph.slug = k.organization_slug
UNION ALL SELECT 'method:website', count(*) FROM k WHERE website IS NOT NULL HAVING count(*) > 0 UNION ALL SELECT 'method:physical_address', count(*) FROM k WHERE address_primary IS NOT NULL HAVING count(*) > 0
UNION ALL SELECT 'alias:legal', count(*) + (SELECT count(DISTINCT key) FROM k) FROM k UNION ALL SELECT 'alias:historic', CAST(sum(len(string_split(source_datasets, '; '))) AS BIGINT) FROM k
UNION ALL SELECT 'role', count(key) FROM k UNION ALL SELECT 'orphan', 0""",
    "contact_table": f"""WITH {ORGS_SQL} SELECT slug AS organization_slug, count(*) AS contacts, count(DISTINCT email) AS n_emails, count(DISTINCT phone) AS n_phones, round(nullif(avg(CASE WHEN email IS NULL THEN 0 ELSE 0.35 END), 0), 6) AS email_confidence_avg FROM orgs GROUP BY 1""",
    "email_checks": f"""WITH m AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 0 WHEN c_custkey % 5 = 1 THEN 1 ELSE 2 END AS n_mails, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN 'user' || c_custkey || '@example.com' ELSE 'u' || c_custkey || '@shop' || (c_custkey % 9) || '.example' END AS mail FROM customer)
SELECT c_custkey, n_mails, mail, split_part(mail, '@', 2) AS domain, {_MAIL_STATUS('mail', False)} AS status, {_MAIL_STATUS('mail', True)} AS confidence FROM m""",
    "phone_numbers": """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN '+2782' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') WHEN 1 THEN '+2711' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS phone,
  CASE c_custkey % 4 WHEN 0 THEN 'deliverable' WHEN 1 THEN 'deliverable' ELSE 'undeliverable' END AS status FROM customer""",
    "addresses": """SELECT s_suppkey, s_suppkey || ' Long Street Gauteng ' || CASE WHEN s_suppkey % 2 = 0 THEN 'Avenue' ELSE 'Road' END AS address, 'Gauteng' AS province, CASE WHEN s_suppkey % 3 = 2 THEN 'New-South Wales' ELSE 'KwaZulu-Natal' END AS named FROM supplier""",
    "company_names": """WITH c AS (SELECT c_custkey, 'class ' || c_nationkey AS n, 'Class ' || c_nationkey || CASE WHEN c_custkey % 2 = 0 THEN ' (Pty) Ltd' ELSE ', Inc.' END AS name FROM customer)
SELECT c_custkey, n || ' (' || arg_min(name, c_custkey) OVER (PARTITION BY n) || ')' AS duplicate_group FROM c QUALIFY count(*) OVER (PARTITION BY n) > 1""",
    "changed_prices": "SELECT p_partkey, 'p_size' AS field, CAST(p_size AS VARCHAR) AS old, CAST(p_size + 1 AS VARCHAR) AS new FROM part WHERE p_partkey % 10 = 0 UNION ALL SELECT p_partkey, 'p_brand', p_brand, NULL FROM part WHERE p_partkey % 15 = 0 AND p_brand IS NOT NULL",
    "backfill_plan": f"WITH {ORGS_SQL} SELECT source_record_id, concat_ws(',', CASE WHEN province IS NULL THEN 'province' END, CASE WHEN address IS NULL THEN 'address' END, CASE WHEN status IS NULL THEN 'status' END, CASE WHEN website IS NULL THEN 'website' END) AS backfill FROM orgs",
    "upserted": "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN 0.0 ELSE o_totalprice END AS o_totalprice FROM orders",
    "run_history": "SELECT o_orderpriority AS profile, count(*) AS runs, count(*) FILTER (WHERE o_orderstatus <> 'P') AS successes, round(avg((o_orderstatus <> 'P')::INT), 5) AS success_rate, round(avg(o_totalprice / 1000), 5) AS mean_seconds, round(min(o_totalprice / 1000), 5) AS min_seconds, round(max(o_totalprice / 1000), 5) AS max_seconds, round(avg(o_custkey), 5) AS mean_records FROM orders GROUP BY 1",
    "gate_history": "SELECT count(*) AS total, count(*) FILTER (WHERE event_type <> 'error') AS passed, count(*) FILTER (WHERE event_type = 'error') AS failed, round(avg((event_type <> 'error')::INT), 6) AS pass_rate, max(event_id) AS latest_at, arg_max(event_type <> 'error', event_id) AS latest_passed FROM events",
    "frameworks_due": "WITH r AS (SELECT lower(o_orderpriority) AS f, max(o_orderdate) AS l FROM orders WHERE o_orderpriority NOT LIKE '5%' GROUP BY 1) SELECT f0 AS framework, strftime(l, '%Y-%m-%d') AS last_run, coalesce(l < TIMESTAMP '1999-06-01' - INTERVAL 90 DAY, true) AS due FROM (SELECT DISTINCT lower(o_orderpriority) AS f0 FROM orders) LEFT JOIN r ON f = f0",
    "error_counts": "SELECT event_type AS category, count(*) AS n, count(*) FILTER (WHERE value > 10 AND value <= 50) AS errors, count(*) FILTER (WHERE value <= 10) AS warnings, count(*) FILTER (WHERE value > 50) AS critical, count(*) FILTER (WHERE event_id % 2 = 0) AS recoverable FROM events GROUP BY 1",
    "first_turns": "SELECT conv_id, sha256(string_agg(text, '|' ORDER BY turn)) AS said FROM (SELECT * FROM conversations WHERE role = 'user' QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn) <= 2) GROUP BY 1",
    "confidence_ranges": "SELECT user_id AS row_index, min(value) AS min_confidence, max(value) AS max_confidence, arg_max(event_type, (value, -event_id)) AS primary_source FROM events GROUP BY 1",
    "recent_orders": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20",
    "robots_pages": """WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, '/' || regexp_extract(url, '^https?://[^/]+/?(.*)$', 1) AS path FROM pages),
r AS (SELECT host, substring(path, 1, 2) AS prefix, bool_and(length(path) % 2 = 0) AS allow FROM p GROUP BY 1, 2), v AS (SELECT p.page_id, arg_max(r.allow, length(r.prefix)) AS ok FROM p JOIN r ON p.host = r.host AND starts_with(p.path, r.prefix) GROUP BY 1)
SELECT p.page_id, coalesce(ok, true) AS robots_ok FROM p LEFT JOIN v USING (page_id)""",
    "provider_join": """WITH t AS (SELECT c_custkey, c_custkey % 60 AS d FROM customer), j AS (
  SELECT c_custkey, s_suppkey, s_name FROM t JOIN supplier ON s_suppkey = c_custkey UNION ALL SELECT c_custkey, s_suppkey, s_name FROM t JOIN supplier ON s_suppkey = d AND s_suppkey < 60 WHERE NOT EXISTS (SELECT 1 FROM supplier x WHERE x.s_suppkey = t.c_custkey)
) SELECT 'registry:' || c_custkey || ':0' AS source_record_id, s_name AS organization_name, 'a' || s_suppkey || '@x.example' AS contact_email, '+27821234567' AS contact_phone FROM j""",
    "refined_pipeline": f"""WITH {REFINED_SQL}, q AS (SELECT *, ((contact_primary_email IS NOT NULL)::INT + (contact_primary_phone IS NOT NULL)::INT + (website IS NOT NULL)::INT + (province IS NOT NULL)::INT + (address_primary IS NOT NULL)::INT) / 5 AS s FROM refined)
SELECT organization_slug, organization_name, contact_primary_email, s AS data_quality_score, CASE WHEN s >= 0.8 THEN 'excellent' WHEN s >= 0.6 THEN 'good' WHEN s >= 0.4 THEN 'fair' ELSE 'poor' END AS band FROM q""",
    "registry_payloads": """SELECT s_suppkey, CASE WHEN s_suppkey % 11 <> 0 THEN s_name END AS name, CASE WHEN s_suppkey % 11 <> 0 THEN 'A' || s_suppkey || '07' END AS number, CASE WHEN s_suppkey % 11 <> 0 THEN 'In Business' END AS status,
  CASE WHEN s_suppkey % 11 = 0 THEN NULL WHEN s_suppkey % 3 < 2 THEN '2015-02-01' ELSE 'early 2015' END AS registered, CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey || ' Rd, JHB' END AS address FROM supplier""",
    "registry_join": """SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN 'cipc' END AS registry_type, CASE WHEN s_suppkey IS NOT NULL THEN 'open' END AS registry_status, 'N' || s_suppkey AS registry_number, s_suppkey IS NOT NULL AS registry_enriched
FROM customer LEFT JOIN supplier ON lower(replace(c_name, 'Customer', 'Supplier')) = lower(s_name)""",
    "geocoded": "SELECT c_custkey, CASE WHEN s_suppkey IS NOT NULL THEN s_suppkey::DOUBLE END AS latitude, 'f' || s_suppkey AS formatted_address, s_suppkey IS NOT NULL AS geocoded FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey % 50 AND s_suppkey % 2 = 0",
    "reverse_geocoded": f"WITH {_PLACES}, q AS (SELECT round(latitude, 3) AS y, round(longitude, 3) AS x, min(CASE WHEN id % 2 = 0 THEN 'Gauteng' ELSE 'Limpopo' END) AS v FROM p WHERE latitude IS NOT NULL AND id % 3 = 0 GROUP BY 1, 2) SELECT id, v AS province_inferred FROM p LEFT JOIN q ON round(latitude, 3) = y AND round(longitude, 3) = x",
    "research_plan": f"""WITH {ORGS_SQL}, u AS (SELECT slug, website IS NOT NULL AS w, email IS NOT NULL AS e, coalesce('https://' || split_part(email, '@', 2) = website, false) AS same, (province IS NULL)::INT + (status IS NULL)::INT AS b FROM orgs)
SELECT slug, count(*) AS n, CAST(sum(w::INT + e::INT - same::INT) AS BIGINT) AS urls, CAST(sum(b) AS BIGINT) AS backfill, count(*) FILTER (WHERE w OR e) AS crawls FROM u GROUP BY slug""",
    "new_targets": "SELECT DISTINCT 'i' || (c_custkey % 200) AS identifier, 'd' || (c_custkey % 200) AS domain FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey % 200)",
    "authority_hits": "SELECT 'firm-' || s_suppkey AS slug, r_name AS source, min('u' || c_custkey) AS url FROM supplier CROSS JOIN region JOIN customer ON c_custkey % 7 = r_regionkey AND c_custkey % 130 = s_suppkey GROUP BY 1, 2",
    "policy_warnings": "SELECT event_type, concat_ws(',', CASE WHEN event_id % 3 = 0 THEN 'robots_disallowed' END, CASE WHEN event_id % 5 = 1 THEN 'tos_not_accepted' END) AS reasons, count(*) AS n FROM events WHERE event_id % 3 = 0 OR event_id % 5 = 1 GROUP BY 1, 2",
    "allowed_providers": "SELECT o_orderpriority AS provider, count(*) AS n FROM orders WHERE lower(o_orderpriority) IN (SELECT lower(o_orderpriority) FROM orders) AND o_orderpriority NOT LIKE '5%' GROUP BY 1",
    "person_names": "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Dr.' END AS title, 'Ann' AS given, CASE WHEN c_custkey % 2 = 0 THEN 'Marie' END AS middle, 'Lee' || (c_custkey % 10) AS family FROM customer",
    "identifiers": f"""WITH v AS (SELECT p_partkey, '4' || lpad(CAST(p_partkey * 7919 % 1000000000 AS VARCHAR), 9, '0') AS vat FROM part)
SELECT p_partkey, 'P' || p_partkey || 'A' AS identifier, CASE WHEN {_luhn('vat')} THEN vat END AS vat, CASE WHEN p_partkey % 2 = 0 THEN lpad(CAST(p_partkey % 10000 AS VARCHAR), 4, '0') END AS postal FROM v""",
    "entity_priorities": """WITH c AS (SELECT c_custkey, c_acctbal, (1 + (c_custkey % 2 = 0)::INT + (c_custkey % 3 = 0)::INT) / 3 AS d, ((c_custkey % 5 = 0)::INT + (c_custkey % 2 = 0)::INT + (c_custkey % 3 = 0)::INT + 1) / 4 AS score FROM customer)
SELECT c_custkey, round(d, 6) AS completeness, round((d + c_acctbal / 10000) / 2, 8) AS priority, score, CASE WHEN d >= 0.8 THEN 'excellent' WHEN d >= 0.6 THEN 'good' WHEN d >= 0.4 THEN 'fair' ELSE 'poor' END AS band FROM c""",
    "party_confidence": """WITH c AS (SELECT c_custkey, least(1, greatest(0.05, greatest(0.5, CASE WHEN c_custkey % 4 <> 0 THEN least(1, 0.25 + 0.2 * (c_custkey % 4)) ELSE 0 END, CASE WHEN c_acctbal / 2000 > 1 THEN least(1, c_acctbal / 2000 / 5) ELSE c_acctbal / 2000 END))) AS x FROM customer)
SELECT c_custkey, round(x, 6) AS confidence, CASE WHEN x >= 0.75 THEN 'high' WHEN x >= 0.5 THEN 'medium' ELSE 'low' END AS band FROM c""",
    "resolved_intent": """WITH g AS (SELECT user_id % 30 AS k, round(avg(value), 4) AS score, count(*) AS signal_count FROM events GROUP BY 1)
SELECT n_nationkey, CASE WHEN (n_nationkey % 2 = 0 OR n_nationkey % 5 <> 0) AND k IS NOT NULL THEN g.score WHEN n_nationkey % 5 = 0 THEN 0.5 END AS score,
  CASE WHEN (n_nationkey % 2 = 0 OR n_nationkey % 5 <> 0) AND k IS NOT NULL THEN g.signal_count WHEN n_nationkey % 5 = 0 THEN 1 END AS signal_count FROM nation LEFT JOIN g ON g.k = n_nationkey""",
    "field_classes": "SELECT * FROM (VALUES ('c_custkey', 'internal', false, NULL, NULL), ('c_name', 'personal', true, 365, 'consent'), ('c_nationkey', 'internal', false, NULL, NULL), ('c_acctbal', 'internal', false, NULL, NULL), ('c_mktsegment', 'internal', false, NULL, NULL)) t(field, classification, requires_consent, retention_days, lawful_basis)",
    "order_checksum": "SELECT 'orders' AS dataset, 1 AS major, 0 AS minor, 0 AS patch, count(*) AS n_rows FROM orders",
    "target_signals": "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'USER-' || c_custkey ELSE 'user-' || c_custkey END AS target_slug, count(*) AS n FROM customer JOIN events ON user_id = c_custkey GROUP BY 1",
}
