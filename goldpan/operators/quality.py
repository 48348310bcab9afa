"""Contracts and expectation suites, each compiled to one aggregation."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SPARK_TYPES = {"string": "string", "number": "double", "integer": "bigint", "boolean": "boolean"}


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "string"
    required: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()


def _fields(spec: str) -> tuple[Field, ...]:
    """``name:type!`` parts between |; string if no type is given, required with !."""
    out = []
    for part in spec.split("|"):
        name, _, kind = part.rstrip("!").partition("@")
        out.append(Field(name, kind or "string", part.endswith("!")))
    return tuple(out)


#: The contracts of source tables and of the refined one.
CONTRACTS = {
    c.name: c
    for c in (
        Contract("organisation", _fields("Organisation Name!|ID@number!|Reachout Date|Recent_Touch_Ind|Area|Distance|Type|Website|Address|Planes|Description Type|Notes|Open Questions"), ("ID",)),
        Contract("contact_info", _fields("ID@number!|Organisation Name!|Reachout Date|Firstname|Surname|Position|Phone|WhatsApp|Email|Invalid|Unnamed: 10"), ("ID", "Email", "Phone")),
        Contract("company_catalogue", _fields("C_ID@number!|Company!|QuickNooks_Name|Last_Order_Date|Category|Strat|Priority|Status|LoadDate|Checked|Website"), ("C_ID",)),
        Contract("company_contacts", _fields("C_ID@number!|Company!|Status|FirstName|Surname|Position|Cellnumber|Email|Landline"), ("C_ID", "Email", "Cellnumber", "Landline")),
        Contract("company_addresses", _fields("C_ID@number!|Company!|Type|Airport|Unnamed: 4"), ("C_ID", "Type")),
        Contract("capture_log", _fields("School!|Unnamed: 0|Contact person (role)|Phone|Email|Addresses|Planes|Website|Description|Type"), ("School",)),
        Contract("refined", _fields(
            "organization_name!|organization_slug!|province|country|area|address_primary|organization_category|organization_type|status|website|planes|description|notes|source_datasets!|source_record_ids!|"
            "contact_primary_name|contact_primary_role|contact_primary_email|contact_primary_phone|contact_secondary_emails|contact_secondary_phones|data_quality_score@number|data_quality_flags|"
            "selection_provenance|last_interaction_date|priority|privacy_basis"
        ), ("organization_slug",)),
        Contract("cleaned_registry", _fields("Name of Organisation!|Province|Status|Website URL|Contact Person|Contact Number|Contact Email Address"), ("Name of Organisation",)),
    )
}


def check_contract(df: DataFrame, contract: Contract) -> DataFrame:
    """One row for each issue: check (missing_column, extra_column, null, type, key), field, n.

    Names are compared on the driver, as they are schema; values in one aggregation, keys in one more.
    """
    spark, have, want = df.sparkSession, set(df.columns), {f.name for f in contract.fields}
    names = [("missing_column", c, 1) for c in sorted(want - have)] + [("extra_column", c, 1) for c in sorted(have - want)]
    out = spark.createDataFrame(names, "check string, field string, n long")
    tests = []
    for f in contract.fields:
        if f.name in have:
            c = F.col(f"`{f.name}`")
            if f.required:
                tests.append(F.struct(F.lit("null").alias("check"), F.lit(f.name).alias("field"), F.count_if(c.isNull()).alias("n")))
            if f.type != "string":
                tests.append(F.struct(F.lit("type").alias("check"), F.lit(f.name).alias("field"), F.count_if(c.isNotNull() & c.cast("string").try_cast(SPARK_TYPES[f.type]).isNull()).alias("n")))
    if tests:
        out = out.unionByName(df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*"))
    if contract.key and set(contract.key) <= have:
        repeated = df.groupBy(*[F.col(f"`{k}`") for k in contract.key]).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))
        out = out.unionByName(repeated.select(F.lit("key").alias("check"), F.lit(", ".join(contract.key)).alias("field"), "n"))
    return out.filter("n > 0")


@dataclass(frozen=True)
class Expectation:
    """kind: not_null, matches, in_set, between, exists. ``mostly``: the share that must hold among non-null values (for not_null: all)."""

    kind: str
    column: str
    mostly: float = 1.0
    options: dict = field(default_factory=dict)

    @property
    def label(self) -> str:
        return f"{self.column} {self.kind}"

    def holds(self) -> Column:
        c = F.col(f"`{self.column}`")
        if self.kind == "not_null":
            return c.isNotNull()
        if self.kind == "matches":
            return c.cast("string").rlike(self.options["pattern"])
        if self.kind == "in_set":
            return c.isin(*self.options["values"])
        low, high = self.options.get("low"), self.options.get("high")
        return (c >= low if low is not None else F.lit(True)) & (c <= high if high is not None else F.lit(True))


def suite_from_json(suite: dict) -> list[Expectation]:
    """Expectations of a suite in the usual JSON form."""
    kinds = {"expect_column_values_to_not_be_null": "not_null", "expect_column_values_to_match_regex": "matches", "expect_column_values_to_be_in_set": "in_set", "expect_column_values_to_be_between": "between", "expect_column_to_exist": "exists"}
    names = {"regex": "pattern", "value_set": "values", "min_value": "low", "max_value": "high"}
    out = []
    for x in suite["expectations"]:
        kwargs = dict(x["kwargs"])
        out.append(Expectation(kinds[x.get("expectation_type", x.get("type"))], kwargs.pop("column"), kwargs.pop("mostly", 1.0), {names.get(k, k): v for k, v in kwargs.items()}))
    return out


def run_suite(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """expectation, n (values judged), n_bad, share, mostly, success: all rules in one aggregation. No values: success."""
    spark, have = df.sparkSession, set(df.columns)
    exists = [(e.label, 0, int(e.column not in have), 1.0 if e.column in have else 0.0, 1.0, e.column in have) for e in suite if e.kind == "exists" or e.column not in have]
    out = spark.createDataFrame(exists, "expectation string, n long, n_bad long, share double, mostly double, success boolean")
    tests = []
    for e in suite:
        if e.kind != "exists" and e.column in have:
            judged = F.lit(True) if e.kind == "not_null" else F.col(f"`{e.column}`").isNotNull()
            tests.append(F.struct(F.lit(e.label).alias("expectation"), F.count_if(judged).alias("n"), F.count_if(judged & ~e.holds()).alias("n_bad"), F.lit(e.mostly).alias("mostly")))
    if tests:
        found = df.agg(F.array(*tests).alias("t")).select(F.explode("t").alias("t")).select("t.*").withColumn("share", F.when(F.col("n") > 0, 1 - F.col("n_bad") / F.col("n")).otherwise(1.0))
        out = out.unionByName(found.withColumn("success", F.col("share") >= F.col("mostly")))
    return out


def suite_from_file(spark: SparkSession, path: str) -> list[Expectation]:
    """A suite from a JSON file in any file system that Spark reads. The file is one document, as suites are written by hand."""
    text = spark.read.text(path, wholetext=True).first()
    if text is None:
        raise ValueError(f"{path} is empty")
    return suite_from_json(json.loads(text[0]))


def checkpoint(df: DataFrame, suite: list[Expectation], position: str | None = None, n: int = 3) -> DataFrame:
    """``run_suite`` with ``unexpected``: the first ``n`` values that break each failed rule, by ``position`` or in the order of the files.

    Values that break a rule are unpivoted in one pass for all rules; a task keeps ``n`` of each rule before the shuffle, so
    neither it nor the list of a rule grows with the number of bad rows.
    """
    result = run_suite(df, suite)
    rules, have = [], set(df.columns)
    for e in suite:
        if e.kind != "exists" and e.column in have:
            c = F.col(f"`{e.column}`")
            bad = ~F.coalesce(e.holds(), F.lit(False)) if e.kind == "not_null" else c.isNotNull() & ~F.coalesce(e.holds(), F.lit(True))
            rules.append(F.when(bad, F.struct(F.lit(e.label).alias("expectation"), c.cast("string").alias("value"))))
    if not rules:
        return result.withColumn("unexpected", F.array().cast("array<string>"))
    placed = df.withColumn("_at", F.col(f"`{position}`") if position else F.monotonically_increasing_id())
    broken = placed.select("_at", F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("x")).select("_at", "x.*")
    first = broken.withColumn("at", F.row_number().over(Window.partitionBy("expectation").orderBy("_at"))).filter(F.col("at") <= n)
    lists = first.groupBy("expectation").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]).alias("unexpected"))
    out = result.join(lists, "expectation", "left")
    return out.withColumn("unexpected", F.when(~F.col("success"), F.col("unexpected")).otherwise(F.array().cast("array<string>"))).withColumn("unexpected", F.coalesce("unexpected", F.array().cast("array<string>")))


def refined_suite(email: float = 0.85, phone: float = 0.85, website: float = 0.75, country: str = "South Africa") -> list[Expectation]:
    statuses = {"values": ["deliverable", "risky", "undeliverable", "unknown"]}
    unit = {"low": 0.0, "high": 1.0}
    return [
        Expectation("not_null", "organization_name"), Expectation("not_null", "organization_slug"), Expectation("between", "data_quality_score", 1.0, unit),
        Expectation("matches", "contact_primary_email", email, {"pattern": r"^[^@\s]+@[^@\s]+\.[^@\s]+$"}), Expectation("matches", "contact_primary_phone", phone, {"pattern": r"^\+\d{6,}$"}),
        Expectation("matches", "website", website, {"pattern": "^https?://"}), Expectation("in_set", "country", 1.0, {"values": [country]}),
        Expectation("in_set", "contact_primary_email_status", 1.0, statuses), Expectation("in_set", "contact_primary_phone_status", 1.0, statuses),
        *[Expectation("between", c, 1.0, unit) for c in ("contact_primary_email_confidence", "contact_primary_phone_confidence", "contact_email_confidence_avg", "contact_phone_confidence_avg", "contact_verification_score_avg")],
    ]


def provenance_suite() -> list[Expectation]:
    """Checks of an enriched table."""
    return [Expectation("not_null", "provenance_source"), Expectation("between", "provenance_confidence", 1.0, {"low": 0.0, "high": 1.0}), Expectation("in_set", "provenance_network_status", 1.0, {"values": ["enabled", "disabled", "offline", "skipped: network disabled"]})]


#: Columns of the refined table that are numbers, and those that are never null; all others are text and may be.
REFINED_NUMBERS = (
    "contact_primary_email_confidence", "contact_primary_phone_confidence", "contact_primary_lead_score", "contact_email_confidence_avg", "contact_phone_confidence_avg",
    "contact_verification_score_avg", "contact_lead_score_avg", "data_quality_score",
)
REFINED_REQUIRED = (
    "organization_name", "organization_slug", "country", "source_datasets", "source_record_ids", "data_quality_score", "data_quality_flags", "selection_provenance", "privacy_basis",
)


def refined_typed(df: DataFrame) -> DataFrame:
    """The refined table with its numbers as such, whatever they were stored as; what is no number is null, and a column that is absent stays so."""
    return coerce(df, dict.fromkeys(REFINED_NUMBERS, "double"))


def coerce(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Columns tried as their types; what doesn't fit is null."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})


def split_valid(df: DataFrame, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame, bool]:
    """(valid rows, invalid rows with their errors, critical). If every row is invalid all are kept, and that is critical."""
    errors = F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]), lambda x: x.isNotNull())
    marked = df.withColumn("errors", errors)
    counted = marked.agg(F.count("*").alias("n"), F.count_if(F.size("errors") > 0).alias("bad")).first()
    critical = counted["n"] > 0 and counted["bad"] == counted["n"]
    valid = marked if critical else marked.filter(F.size("errors") == 0)
    return valid.drop("errors"), marked.filter(F.size("errors") > 0), critical


def recommendations(refined: DataFrame, suite_result: DataFrame, *, good: float = 0.7) -> DataFrame:
    """recommendation: advice from the mean quality, rows without contacts and failed expectations."""
    share = lambda c: F.avg(F.col(c).isNull().cast("double"))
    m = refined.agg(F.count("*").alias("n"), F.avg("data_quality_score").alias("q"), F.count_if(F.col("data_quality_score") < 0.4).alias("poor"), share("contact_primary_email").alias("e"), share("contact_primary_phone").alias("p"))
    texts = F.array(
        F.when(F.col("n") == 0, "No records were refined"), F.when(F.col("q") < good, F.format_string("Average data quality is %.2f: complete missing fields", "q")),
        F.when(F.col("poor") > 0, F.format_string("%d records have poor quality", "poor")), F.when(F.col("e") > 0.5, "More than half of the records lack an e-mail"), F.when(F.col("p") > 0.5, "More than half of the records lack a phone number"),
    )
    failed = suite_result.filter(~F.col("success")).select(F.concat(F.lit("Expectation failed: "), "expectation").alias("recommendation"))
    return m.select(F.explode(F.filter(texts, lambda x: x.isNotNull())).alias("recommendation")).unionByName(failed)


def quality_report(refined: DataFrame, suite_result: DataFrame, breakdown: DataFrame, n_conflicts: Column | int = 0) -> DataFrame:
    """One row for a run: totals, expectation result and failures, records by source, quality figures, conflicts."""
    totals = refined.agg(F.count("*").alias("total_records"), F.avg("data_quality_score").alias("mean_quality"), F.min("data_quality_score").alias("min_quality"), F.max("data_quality_score").alias("max_quality"))
    rules = suite_result.agg(F.every("success").alias("expectations_passed"), F.sort_array(F.collect_list(F.when(~F.col("success"), F.col("expectation")))).alias("failures"))
    sources = breakdown.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("source_dataset", "n")))).alias("source_breakdown"))
    return totals.crossJoin(rules).crossJoin(sources).withColumn("conflicts", n_conflicts if isinstance(n_conflicts, Column) else F.lit(n_conflicts))
