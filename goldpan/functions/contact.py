"""Validation and scores of contacts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, bind, clamp, logistic_scale, phone_parts, tidy

#: Domains that count as trusted, weights of roles in the order they are looked for, weights of lead scores.
TRUSTED_DOMAINS = ("example.com", "example.org", "example.net")
ROLE_WEIGHTS = {"ceo": 1.0, "director": 0.9, "manager": 0.8, "owner": 1.0, "chief": 0.95, "head": 0.85, "coordinator": 0.7, "admin": 0.6, "assistant": 0.5}
LEAD_WEIGHTS = {"completeness": 0.3, "email_confidence": 0.25, "phone_confidence": 0.15, "source_priority": 0.2, "intent": 0.1}

_EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def _result(status: str, confidence: float, reason: str | None) -> Column:
    return F.struct(F.lit(status).alias("status"), F.lit(confidence).alias("confidence"), F.lit(reason).cast("string").alias("reason"))


def validate_email(c: Column | str, has_mx: Column | None = None, trusted: tuple[str, ...] = TRUSTED_DOMAINS) -> Column:
    """struct(status, confidence, reason); ``has_mx``: whether the domain has a mail host in a supplied table."""
    mx = F.coalesce(has_mx, F.lit(False)) if has_mx is not None else F.lit(False)

    def judged(text: Column) -> Column:
        return (
            F.when(text.isNull(), F.lit(None)).when(~text.rlike(_EMAIL), _result("undeliverable", 0.0, "invalid_format"))
            .when(F.lower(F.regexp_extract(text, "@([^@]*)$", 1)).isin(*trusted), _result("deliverable", 0.92, None))
            .when(mx, _result("deliverable", 0.75, None)).otherwise(_result("risky", 0.35, "missing_mx_records"))
        )

    return bind(tidy(c), judged)


def validate_phone(c: Column | str, region: str = "ZA") -> Column:
    def judged(parts: Column) -> Column:
        return (
            F.when(parts.isNull(), _result("undeliverable", 0.0, "parse_error:not_a_number")).when(parts["e164"].isNotNull(), _result("deliverable", 0.85, None))
            .when(parts["possible"], _result("risky", 0.45, "number_possible")).otherwise(_result("undeliverable", 0.1, "number_invalid"))
        )

    return bind(tidy(c), lambda text: F.when(text.isNotNull(), bind(phone_parts(text, region), judged)))


def _bad(status: Column) -> Column:
    return status.isin("risky", "undeliverable")


def validation_flags(email_status: Column, phone_status: Column) -> Column:
    flags = F.array(F.when(_bad(email_status), F.concat(F.lit("email:"), email_status)), F.when(_bad(phone_status), F.concat(F.lit("phone:"), phone_status)))
    return F.filter(flags, lambda x: x.isNotNull())


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


#: What a status takes from a score (undeliverable, risky), for e-mails and phones.
DELIVERABILITY_EMAIL, DELIVERABILITY_PHONE = (0.2, 0.6), (0.35, 0.7)
VERIFICATION_EMAIL, VERIFICATION_PHONE = (0.3, 0.65), (0.4, 0.7)
#: What a checked e-mail or phone adds to or takes from completeness (deliverable, risky, undeliverable), and a verified contact adds.
COMPLETENESS_EMAIL, COMPLETENESS_PHONE, COMPLETENESS_VERIFIED = (0.12, 0.05, 0.2), (0.08, 0.04, 0.15), 0.05


def _times(status: Column, undeliverable: float, risky: float) -> Column:
    return F.when(status == "undeliverable", undeliverable).when(status == "risky", risky).otherwise(1.0)


def mean_confidence(email: Column, phone: Column) -> Column:
    """Mean of the confidences above zero; 0 if there is none."""
    e, p = _zero(email), _zero(phone)
    n = (e > 0).cast("int") + (p > 0).cast("int")
    return F.when(n > 0, (F.greatest(e, F.lit(0.0)) + F.greatest(p, F.lit(0.0))) / n).otherwise(0.0)


def deliverability(email: Column, phone: Column) -> Column:
    """``email`` and ``phone``: structs of status and confidence."""
    base = logistic_scale(mean_confidence(email["confidence"], phone["confidence"]))
    return clamp(base * _times(email["status"], *DELIVERABILITY_EMAIL) * _times(phone["status"], *DELIVERABILITY_PHONE))


def verification(email: Column, phone: Column) -> Column:
    base = logistic_scale(mean_confidence(email["confidence"], phone["confidence"]))
    return F.when((_zero(email["confidence"]) > 0) | (_zero(phone["confidence"]) > 0), base * _times(email["status"], *VERIFICATION_EMAIL) * _times(phone["status"], *VERIFICATION_PHONE)).otherwise(0.0)


def lead_score(inputs: dict[str, Column], weights: dict[str, float] = LEAD_WEIGHTS) -> Column:
    """Weighted mean of clamped inputs on the logistic scale; inputs without a positive weight don't count."""
    used = {k: w for k, w in weights.items() if w > 0 and k in inputs}
    if not used:
        return F.lit(0.0)
    total = sum((w * clamp(inputs[k]) for k, w in used.items()), F.lit(0.0))
    return logistic_scale(total / sum(used.values()))


def contact_completeness(fields: list[Column], email: Column, phone: Column, verified: Column) -> Column:
    filled = sum(((tidy(f).isNotNull()).cast("double") for f in fields), F.lit(0.0)) / len(fields)

    def adjust(result: Column, up: float, risky: float, down: float) -> Column:
        scaled = logistic_scale(result["confidence"])
        return (
            F.when(result["status"] == "deliverable", up * scaled).when(result["status"] == "risky", -risky * scaled)
            .when(result["status"] == "undeliverable", -down * F.greatest(F.lit(0.2), scaled)).otherwise(0.0)
        )

    extra = F.when(verified > 0, COMPLETENESS_VERIFIED * logistic_scale(verified)).otherwise(0.0)
    return clamp(filled + adjust(email, *COMPLETENESS_EMAIL) + adjust(phone, *COMPLETENESS_PHONE) + extra)


def role_weight(role: Column | str) -> Column:
    """Weight of the first keyword that the role contains, else one half."""
    text, out = F.lower(_col(role)), F.lit(0.5)
    for key, weight in reversed(ROLE_WEIGHTS.items()):
        out = F.when(text.contains(key), weight).otherwise(out)
    return out


def preference(source: Column, completeness: Column, role: Column, verified: Column, lead: Column, weights: tuple[float, ...] = (0.2, 0.25, 0.2, 0.2, 0.15)) -> Column:
    parts = (source, completeness, role, verified, lead)
    return sum((w * p for w, p in zip(weights, parts)), F.lit(0.0)) / sum(weights)


def _filled(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False)).cast("int")


def row_quality(emails: Column, phones: Column, website: Column, province: Column, address: Column) -> Column:
    """0 to 5: which of the five a source row has; e-mails and phones are arrays."""
    return F.greatest(F.size(emails), F.lit(0)).cast("boolean").cast("int") + F.greatest(F.size(phones), F.lit(0)).cast("boolean").cast("int") + _filled(website) + _filled(province) + _filled(address)


def record_quality(fields: dict[str, Column]) -> tuple[Column, Column]:
    """Score (share of filled fields, two decimals) and flags (missing_* joined by ;, or none) of a refined record."""
    score = F.round(sum((_filled(c) for c in fields.values()), F.lit(0)) / len(fields), 2)
    missing = F.array_join(F.filter(F.array(*[F.when(_filled(c) == 0, f"missing_{n}") for n, c in fields.items()]), lambda x: x.isNotNull()), ";")
    return score, F.when(missing == "", "none").otherwise(missing)


def entity_priority(fields: list[Column], quality: Column) -> tuple[Column, Column]:
    """Share of filled fields, and its mean with the quality score."""
    completeness = sum((_filled(c) for c in fields), F.lit(0)) / len(fields)
    return completeness, (completeness + F.coalesce(quality, F.lit(0.0))) / 2


def optimisation_score(website_ok: Column, province: Column, address: Column, email_ok: Column) -> Column:
    return (website_ok.cast("int") + province.isNotNull().cast("int") + address.isNotNull().cast("int") + email_ok.cast("int")) / 4


def confidence(default: float, priority: Column, quality: Column) -> Column:
    """Largest of the default, the priority's share and the quality (a quality above 1 is out of 5), within 0.05 and 1."""
    q = F.when(quality > 1, F.least(F.lit(1.0), quality / 5)).otherwise(quality)
    from_priority = F.when(priority != 0, F.least(F.lit(1.0), 0.25 + 0.2 * priority))
    return clamp(F.greatest(F.lit(default), F.coalesce(from_priority, F.lit(0.0)), F.coalesce(q, F.lit(0.0))), 0.05, 1.0)


def confidence_band(c: Column) -> Column:
    return F.when(c >= 0.75, "high").when(c >= 0.5, "medium").otherwise("low")
