"""Personal data by pattern, consent, retention and audit."""

from __future__ import annotations

import re
from bisect import bisect_left
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.scratch import written

#: Patterns of personal data, in the order they are replaced. Names of persons and places need a model and aren't covered.
PII = {
    "EMAIL_ADDRESS": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "URL": r"https?://[^\s<>\"']+",
    "IBAN_CODE": r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    "CREDIT_CARD": r"\b(?:[0-9]{4}[ -]?){3}[0-9]{4}\b",
    "ID_NUMBER": r"\b[0-9]{13}\b",
    "IP_ADDRESS": r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b",
    "PHONE_NUMBER": r"\+[0-9][0-9 ()-]{7,14}[0-9]",
}
#: What a text without has no hit of the kind, so that most texts spare a pattern.
NEEDED = {"EMAIL_ADDRESS": "@", "URL": "://", "IP_ADDRESS": ".", "PHONE_NUMBER": "+"}
#: Kinds whose hits must pass the Luhn test.
LUHN = ("CREDIT_CARD", "ID_NUMBER")


def _found(text: Column, kind: str) -> Column:
    hits = F.regexp_extract_all(text, F.lit(PII[kind]), F.lit(0))
    if kind in NEEDED:
        hits = F.when(F.contains(text, F.lit(NEEDED[kind])), hits).otherwise(F.array().cast("array<string>"))
    if kind in LUHN:
        hits = F.filter(hits, _passes_luhn)
    return hits


def pii_hits(c: Column) -> Column:
    """Array of struct(type, text) of all hits."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return F.flatten(F.array(*[F.transform(_found(text, k), _typed(k)) for k in PII]))


def _typed(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("type"), x.alias("text"))


def detect(df: DataFrame, columns: list[str]) -> DataFrame:
    """Adds {column}_has_pii and {column}_pii_types (distinct, sorted, joined by a comma)."""
    out = {}
    for c in columns:
        types = F.array_sort(F.array_distinct(F.transform(pii_hits(F.col(c)), lambda h: h["type"])))
        out |= {f"{c}_has_pii": F.size(types) > 0, f"{c}_pii_types": F.array_join(types, ",")}
    return df.withColumns(out)


def anonymise(c: Column, operation: str = "replace") -> Column:
    """Each hit as <TYPE> (replace), nothing (redact), its SHA-256 (hash) or stars (mask). Numbers that fail the Luhn test are no hits and stay."""
    changes = {"redact": lambda x: F.lit(""), "hash": lambda x: F.sha2(x, 256), "mask": lambda x: F.repeat(F.lit("*"), F.length(x))}
    out = c
    for kind, pattern in PII.items():
        checked = kind in LUHN
        if operation in ("replace", "redact") and not checked:
            new = F.regexp_replace(out, pattern, f"<{kind}>" if operation == "replace" else "")
            new = F.when(F.contains(out, F.lit(NEEDED[kind])), new).otherwise(out) if kind in NEEDED else new
        else:
            change = _each_hit(changes.get(operation) or _constant(f"<{kind}>"), checked)
            between, hits = F.split(out, pattern, -1), F.regexp_extract_all(out, F.lit(pattern), F.lit(0))
            new = F.array_join(F.zip_with(between, F.transform(hits, change), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
        out = F.when(c.isNotNull(), new)
    return out


def _constant(text: str):
    return lambda x: F.lit(text)


def _passes_luhn(x: Column) -> Column:
    return F.call_function("luhn_check", F.translate(x, " -", ""))


def _each_hit(change, checked: bool):
    return (lambda x: F.when(_passes_luhn(x), change(x)).otherwise(x)) if checked else change


#: How sure a pattern is that its hit is personal data, and what a test adds: a number that fails its test is no hit.
SCORES = {"EMAIL_ADDRESS": 1.0, "URL": 0.6, "IBAN_CODE": 0.5, "CREDIT_CARD": 0.3, "ID_NUMBER": 0.3, "IP_ADDRESS": 0.6, "PHONE_NUMBER": 0.4}
PASSED_TEST = 0.7
EVENT = "array<struct<type:string,start:int,stop:int,score:double>>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def found_spans(text: str, least: float = 0.0) -> list[tuple[str, int, int, float]]:
    """(type, start, stop, score) of what is replaced, in order and without overlaps.

    Hits of all patterns are found; where some overlap the one of the highest score stays, of equal ones the longest, then the
    first, and what it covers in part or whole goes.
    """
    hits = []
    for kind, pattern in _COMPILED.items():
        if kind not in NEEDED or NEEDED[kind] in text:
            for m in pattern.finditer(text):
                score = SCORES[kind]
                if kind in LUHN:
                    if not _luhn("".join(c for c in m[0] if c.isdigit())):
                        continue
                    score += PASSED_TEST
                if score >= least:
                    hits.append((kind, m.start(), m.end(), score))
    if len(hits) > 1:
        order, taken, ends = sorted(hits, key=lambda h: (-h[3], h[1] - h[2], h[1])), [], []
        for h in order:
            at = bisect_left(ends, h[1] + 1)  # the first one taken that ends behind this one's start
            if at == len(ends) or taken[at][1] >= h[2]:
                taken.insert(at, h)
                ends.insert(at, h[2])
        hits = taken
    return hits


_COMPILED = {k: re.compile(p, re.ASCII) for k, p in PII.items()}
_CHANGES = {
    "replace": lambda kind, x: f"<{kind}>", "redact": lambda kind, x: "", "hash": lambda kind, x: sha256(x.encode()).hexdigest(), "mask": lambda kind, x: "*" * len(x),
}


def _rewritten(text: str, spans: list, change) -> str:
    parts, end = [], 0
    for kind, start, stop, _ in spans:
        parts += (text[end:start], change(kind, text[start:stop]))
        end = stop
    return "".join((*parts, text[end:]))


def span_redactor(operation: str = "replace", least: float = 0.0):
    """A function of a text column that gives struct(text, events): the text with each hit changed and where they were, from one look at each text.

    Events: type, start, stop (code points of the text as it came, stop exclusive), score. Null stays null, with no events.
    """
    @F.pandas_udf(f"text string, events {EVENT}")
    def redacted(texts: pd.Series) -> pd.DataFrame:
        out, events = [], []
        for t in texts:
            spans = found_spans(t, least) if t else []
            out.append(_rewritten(t, spans, _CHANGES[operation]) if spans else t)
            events.append([{"type": k, "start": a, "stop": b, "score": s} for k, a, b, s in spans])
        return pd.DataFrame({"text": out, "events": events})

    return redacted


def redact(df: DataFrame, columns: list[str], key: str, operation: str = "redact", least: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """(redacted rows, events), both from one written pass over ``df``. Array columns are redacted value by value.

    Events: key, column_name, value_index (null for scalars), type, start, stop, score. Cells of an array travel as rows, so a
    cell of any length is one text. Rows that repeat a key are kept apart.
    """
    types, change = dict(df.dtypes), span_redactor(operation, least)
    listed = [c for c in columns if types[c].startswith("array")]
    marked = written(df.withColumn("_row", F.monotonically_increasing_id()), "redact-rows") if listed else df
    rows = marked.withColumns({f"_{c}": change(F.col(c).cast("string")) for c in columns if c not in listed})
    for c in listed:  # one row a value, and back by row and place
        values = marked.select("_row", F.posexplode(c).alias("at", "v")).withColumn("x", change(F.col("v")))
        lists = values.groupBy("_row").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "x"))), lambda v: v["x"]).alias(f"_{c}"))
        rows = rows.join(lists, "_row", "left")
    done = written(rows, "redacted")
    changed, events = {}, None
    for c in columns:
        if c in listed:
            empty = F.when(F.col(c).isNotNull(), F.array().cast(types[c]))
            changed[c] = F.coalesce(F.transform(f"_{c}", lambda v: v["text"]), empty)
            each = done.select(key, F.lit(c).alias("column_name"), F.posexplode(f"_{c}").alias("value_index", "v")).select(key, "column_name", "value_index", F.explode("v.events").alias("e"))
        else:
            changed[c] = F.col(f"_{c}.text")
            each = done.select(key, F.lit(c).alias("column_name"), F.lit(None).cast("int").alias("value_index"), F.explode(f"_{c}.events").alias("e"))
        found = each.select(key, "column_name", "value_index", "e.*")
        events = found if events is None else events.unionByName(found)
    return done.withColumns(changed).select(*df.columns), events


#: What a field needs consent for, and which statuses grant, await or deny it.
CONSENT_FIELDS = ("contact_primary_email", "contact_primary_phone", "contact_primary_name")
GRANTED, PENDING, DENIED = ("granted", "approved", "allowed"), ("pending", "unknown", "review"), ("revoked", "denied", "withdrawn", "expired")


def classify_fields(df: DataFrame, policy: DataFrame) -> DataFrame:
    """field, classification (internal unless the policy says), requires_consent, retention_days, lawful_basis of each column."""
    fields = df.sparkSession.createDataFrame([(c,) for c in df.columns], "field string")
    return fields.join(policy, "field", "left").select("field", F.coalesce("classification", F.lit("internal")).alias("classification"), F.coalesce("requires_consent", F.lit(False)).alias("requires_consent"), "retention_days", "lawful_basis")


def _status(status: str) -> Column:
    return F.nullif(F.lower(F.trim(F.col(status).cast("string"))), F.lit(""))


def consent_reason(status: str = "consent_status") -> Column:
    """Why a status grants nothing: missing, pending, denied or unknown; null if it does."""
    s = _status(status)
    return F.when(s.isNull(), "missing").when(s.isin(*PENDING), "pending").when(s.isin(*DENIED), "denied").when(~s.isin(*GRANTED), "unknown")


def consent_checks(df: DataFrame, fields: tuple[str, ...] = CONSENT_FIELDS, status: str = "consent_status") -> DataFrame:
    """Rows that hold a field that needs consent, with consent_fields, consent (status in lower case) and reason (null if granted)."""
    used = F.filter(F.array(*[F.when(F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "", F.lit(f)) for f in fields if f in df.columns]), lambda x: x.isNotNull())
    return df.withColumns({"consent_fields": used, "consent": _status(status), "reason": consent_reason(status)}).filter(F.size("consent_fields") > 0)


def consent_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy(F.coalesce("consent", F.lit("untracked")).alias("consent")).agg(F.count("*").alias("n"), F.count_if(F.col("reason").isNotNull()).alias("violations"))


class ConsentError(ValueError):
    """Some rows hold fields for which there is no consent."""


def enforce_consent(checks: DataFrame) -> None:
    n = checks.filter("reason is not null").count()
    if n:
        raise ConsentError(f"{n} records require consent but consent is not granted")


def with_consent(df: DataFrame, fields: tuple[str, ...] = CONSENT_FIELDS, status: str = "consent_status", key: str | None = None) -> DataFrame:
    """``df`` with the consent rule inside its plan: the job that writes or reads it fails at the first row that holds a field without consent, so no pass of its own is needed and nothing is written whole before the check.

    The message names the reason and, if given, the row's ``key``.
    """
    reason = consent_reason(status)
    used = F.greatest(*[F.coalesce(F.trim(F.col(f).cast("string")), F.lit("")) != "" for f in fields if f in df.columns], F.lit(False))
    who = F.coalesce(F.col(key).cast("string"), F.lit("?")) if key else F.lit("a record")
    text = F.concat(F.lit("consent of "), who, F.lit(" is "), reason)
    # The assertion is part of a column that is kept, as the optimiser drops columns that nobody reads.
    checked = F.when(used & reason.isNotNull(), F.raise_error(text).cast(df.schema[status].dataType)).otherwise(F.col(status))
    return df.withColumn(status, checked)


def apply_consent(df: DataFrame, overrides: DataFrame, key: str = "organization_slug", status: str = "consent_status") -> DataFrame:
    """Statuses of listed keys replaced; overrides: key, status."""
    new = overrides.groupBy(F.col(key).alias("_k")).agg(F.max("status").alias("_s"))
    return df.join(new, F.col(key) == F.col("_k"), "left").withColumn(status, F.coalesce("_s", status)).drop("_k", "_s")


def with_compliance_columns(df: DataFrame, source: str, now: Column, retention_days: int | None = None) -> DataFrame:
    """data_source, processed_at, consent_status (pending by default), consent_date, retention_until."""
    have = lambda c, default: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.lit(default)) if c in df.columns else F.lit(default).cast("string")
    until = F.date_add(F.to_date(now), retention_days) if retention_days is not None else F.lit(None).cast("date")
    return df.withColumns({"data_source": F.lit(source), "processed_at": now, "consent_status": have("consent_status", "pending"), "consent_date": F.col("consent_date") if "consent_date" in df.columns else F.lit(None).cast("string"), "retention_until": until})


def table_checksum(df: DataFrame) -> DataFrame:
    """n_rows and a checksum that doesn't depend on row order."""
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum"))


def audit_events(df: DataFrame, name: str, details: dict[str, Column], at: Column) -> DataFrame:
    """One event over ``df``: at, event, details (aggregates as text)."""
    one = df.agg(*[c.cast("string").alias(k) for k, c in details.items()])
    return one.select(at.alias("at"), F.lit(name).alias("event"), F.create_map(*[x for k in details for x in (F.lit(k), F.col(k))]).alias("details"))
