"""The whole refinement: sources to refined table, with redaction, validation and later features."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions import text as T
from goldpan.operators import privacy, quality, survivorship
from goldpan.operators.dedup import union_sources
from goldpan.operators.enrich import Registry
from goldpan.operators.mapping import canonical
from goldpan.scratch import written


@dataclass(frozen=True)
class Profile:
    """What an industry sets: priorities of sources (each its own), thresholds, columns to redact, and how much must be valid."""

    name: str = "aviation"
    priorities: dict[str, int] = field(default_factory=lambda: {"SACAA Cleaned": 3, "Reachout Database": 2, "Contact Database": 1})
    email_share: float = 0.85
    phone_share: float = 0.85
    website_share: float = 0.75
    redact: tuple[str, ...] = ()
    country: str = "South Africa"
    region: str = "ZA"

    def __post_init__(self) -> None:
        if len(set(self.priorities.values())) < len(self.priorities):
            raise ValueError("each source needs a priority of its own")


@dataclass(frozen=True)
class Refined:
    table: DataFrame
    invalid: DataFrame
    critical: bool
    expectations: DataFrame
    breakdown: DataFrame
    report: DataFrame


def ingest(sources: list[DataFrame]) -> DataFrame:
    """The union of canonical sources, Unicode settled once, with slug, province and a position over all."""
    rows = union_sources([canonical(s).withColumn("_s", F.lit(i)) for i, s in enumerate(sources)])
    clean = {c: T.clean_text(c) for c in ("organization_name", "province", "area", "address")}
    return rows.withColumns(clean).withColumns({"slug": T.slugify("organization_name"), "province": T.normalize_province("province"), "pos": F.col("_s").cast("long") * (1 << 48) + F.col("pos")}).drop("_s")


def run(sources: list[DataFrame], profile: Profile = Profile(), *, intent: DataFrame | None = None, features: Registry | None = None) -> Refined:
    """Features (linkage, geography, enrichment, compliance: see ``Registry``) are applied to the table before it is returned."""
    rows = ingest(sources)
    if profile.redact:
        rows, _ = privacy.redact(rows, list(profile.redact), "pos")
    # Written once: validation, expectations, report and result all read it.
    refined = written(survivorship.refine(rows, profile.priorities, intent=intent, country=profile.country, region=profile.region), "refined")
    checks = {"organization_name": F.col("organization_name").isNotNull(), "data_quality_score": F.col("data_quality_score").between(0, 1)}
    valid, invalid, critical = quality.split_valid(refined, checks)
    expectations = quality.run_suite(valid, quality.refined_suite(profile.email_share, profile.phone_share, profile.website_share, profile.country))
    breakdown = survivorship.source_breakdown(rows)
    table = features(valid) if features else valid
    return Refined(table, invalid, critical, expectations, breakdown, quality.quality_report(valid, expectations, breakdown))
