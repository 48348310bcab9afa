"""Contacts of an organisation: one table of them, scored, and its flat summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions import contact as C
from goldpan.functions import text as T


def exploded(rows: DataFrame, key: str) -> DataFrame:
    """key, source_dataset, row, at, name, role, email, phone: the four lists of each row side by side; empty contacts go."""
    lists = {"name": "contact_names", "role": "contact_roles", "email": "contact_emails", "phone": "contact_phones"}
    some = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    zipped = F.arrays_zip(*[some(c).alias(n) for n, c in lists.items()])
    out = rows.select(key, "source_dataset", F.col("pos").alias("row"), F.posexplode(zipped).alias("at", "c"))
    tidy = out.select(key, "source_dataset", "row", "at", *[T.tidy(F.col("c").getField(n)).alias(n) for n in lists])
    return tidy.filter(F.coalesce(*lists).isNotNull())


def scored(contacts: DataFrame, priorities: dict[str, int], region: str = "ZA") -> DataFrame:
    """Adds email_check, phone_check, flags, completeness, verified, lead_score, preference."""
    table = F.create_map(*[F.lit(x) for kv in (priorities or {"": 0}).items() for x in kv])
    source = F.coalesce(table[F.col("source_dataset")], F.lit(0)) / max([1, *priorities.values()])
    out = contacts.withColumns({"email_check": C.validate_email("email"), "phone_check": C.validate_phone("phone", region), "source_score": source})
    e, p = F.col("email_check"), F.col("phone_check")
    out = out.withColumns({"verified": C.verification(e, p), "flags": C.validation_flags(e["status"], p["status"]), "completeness": C.contact_completeness([F.col(c) for c in ("name", "email", "phone", "role")] + [F.lit(None).cast("string")], e, p, F.lit(0.0))})
    lead = C.lead_score({"completeness": F.col("completeness"), "email_confidence": F.coalesce(e["confidence"], F.lit(0.0)), "phone_confidence": F.coalesce(p["confidence"], F.lit(0.0)), "source_priority": F.col("source_score"), "intent": F.lit(0.0)})
    return out.withColumn("lead_score", lead).withColumn("preference", C.preference(F.col("source_score"), F.col("completeness"), C.role_weight("role"), F.col("verified"), F.col("lead_score")))


def annotate(df: DataFrame, email: str, phone: str, region: str = "ZA") -> DataFrame:
    """Adds status and confidence of both channels."""
    e, p = C.validate_email(email), C.validate_phone(phone, region)
    return df.withColumns({"email_status": e["status"], "email_confidence": e["confidence"], "phone_status": p["status"], "phone_confidence": p["confidence"], "phone_type": T.phone_parts(phone, region)["type"]})


def _mean(c: Column) -> Column:
    """Mean, null if all are zero."""
    return F.when(F.max(F.abs(c)) > 0, F.avg(c))


def consolidated(contacts: DataFrame, key: str) -> DataFrame:
    """One row a key: primary contact (highest preference, the earlier one among equals), how many there are, all e-mails and phones, averages."""
    order = F.struct(F.col("preference"), -F.col("row"), -F.col("at"))
    many = lambda c: F.array_distinct(F.transform(F.sort_array(F.collect_list(F.when(F.col(c).isNotNull(), F.struct("row", "at", c)))), lambda x: x[c]))
    return contacts.groupBy(key).agg(
        F.max_by(F.struct("name", "role", "email", "phone", "preference"), order).alias("primary"), F.count("*").alias("contacts"), many("email").alias("emails"), many("phone").alias("phones"),
        _mean(F.coalesce("email_check.confidence", F.lit(0.0))).alias("email_confidence_avg"), _mean(F.coalesce("phone_check.confidence", F.lit(0.0))).alias("phone_confidence_avg"), _mean(F.col("verified")).alias("verification_avg"), _mean(F.col("lead_score")).alias("lead_score_avg"),
    )


def with_role(contacts: DataFrame, role: str) -> DataFrame:
    return contacts.filter(F.lower("role") == role.lower())
