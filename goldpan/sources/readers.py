"""Source tables to canonical rows. Sheets come as tables with a column ``pos``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.functions import text as T
from goldpan.operators.dedup import with_position
from goldpan.operators.mapping import canonical


def read_any(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """json, ndjson, csv, orc or parquet by the end of the name; blank text is null. A json file may hold one array or a record a line."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read if schema is None else spark.read.schema(schema)
    if kind in ("json", "ndjson", "jsonl"):
        head = spark.read.text(path).filter("trim(value) <> ''").first() if kind == "json" else None
        df = reader.option("multiLine", head is not None and (head[0].lstrip().startswith("[") or head[0].strip() == "{")).json(path)
    elif kind == "csv":
        df = reader.option("header", True).csv(path)
    elif kind in ("parquet", "orc"):
        df = reader.format(kind).load(path)
    else:
        raise ValueError(f"unknown format: {path}")
    return df.select(*[F.nullif(F.trim(F.col(f"`{c}`")), F.lit("")).alias(c) if t == "string" else F.col(f"`{c}`") for c, t in df.dtypes])


def read_lookup(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """table.parquet, else table.csv."""
    for kind in ("parquet", "csv"):
        try:
            return read_any(spark, f"{folder}/{table}.{kind}")
        except Exception as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
    raise FileNotFoundError(f"{folder}/{table}")


def read_newest(spark: SparkSession, pattern: str) -> DataFrame:
    """The file that was written last among those that match."""
    newest = spark.read.parquet(pattern).select("_metadata.file_path", "_metadata.file_modification_time").agg(F.max_by("file_path", F.struct("file_modification_time", "file_path"))).first()[0]
    return spark.read.parquet(newest)


def stage(df: DataFrame, folder: str, workbook: str, sheet: str) -> DataFrame:
    """The table as Parquet under a name made of workbook and sheet, read again."""
    import re

    path = f"{folder}/{workbook}__{re.sub('[^A-Za-z0-9]+', '_', sheet)}.parquet"
    (df if "pos" in df.columns else with_position(df)).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _list(column: str):
    """Values of a group in source order, nulls out."""
    return F.transform(F.sort_array(F.collect_list(F.when(F.col(column).isNotNull(), F.struct("pos", column)))), lambda x: x[column])


def organisation_source(orgs: DataFrame, contacts: DataFrame, dataset: str = "Reachout Database") -> DataFrame:
    """Organisations with the contacts of their ID as parallel lists; rows without a name go."""
    people = contacts.withColumns({
        "n": T.join_filled(["Firstname", "Surname"]), "r": T.tidy("Position"), "p": T.normalize_phone(F.coalesce(T.tidy("Phone"), T.tidy("WhatsApp"))), "e": T.normalize_email("Email"),
    }).groupBy("ID").agg(_list("n").alias("contact_names"), _list("r").alias("contact_roles"), _list("e").alias("contact_emails"), _list("p").alias("contact_phones"))
    rows = orgs.filter(T.tidy("`Organisation Name`").isNotNull()).join(people, "ID", "left")
    return canonical(rows.select(
        T.tidy("`Organisation Name`").alias("organization_name"), F.lit(dataset).alias("source_dataset"), F.concat(F.lit("reachout:"), F.col("ID").cast("long")).alias("source_record_id"), T.tidy("Area").alias("area"),
        T.tidy("Address").alias("address"), T.tidy("Type").alias("organization_type"), T.normalize_website("Website").alias("website"), T.tidy("Planes").alias("planes"), T.join_filled(["`Description Type`", "Notes"], " | ").alias("description"),
        T.join_filled(["Notes", "`Open Questions`"], " | ").alias("notes"), F.col("`Reachout Date`").alias("last_interaction_date"), "contact_names", "contact_roles", "contact_emails", "contact_phones", "pos",
    ))


def company_source(companies: DataFrame, contacts: DataFrame, addresses: DataFrame, captures: DataFrame, dataset: str = "Contact Database") -> DataFrame:
    """Companies with contacts by C_ID, the first filled address, and the last capture note of the school's name."""
    people = contacts.withColumns({
        "n": T.join_filled(["FirstName", "Surname"]), "r": T.tidy("Position"), "p": T.normalize_phone(F.coalesce(T.tidy("Cellnumber"), T.tidy("Landline"))), "e": T.normalize_email("Email"),
    }).groupBy("C_ID").agg(_list("n").alias("contact_names"), _list("r").alias("contact_roles"), _list("e").alias("contact_emails"), _list("p").alias("contact_phones"))
    full = T.join_filled(["Airport", "`Unnamed: 4`"], ", ")
    places = addresses.withColumn("a", full).filter("a is not null").groupBy("C_ID").agg(F.min_by("a", "pos").alias("address"))
    notes = captures.groupBy(F.lower(T.tidy("School")).alias("school")).agg(F.max_by(T.join_filled(["Description", "Type"], " | "), "pos").alias("capture_note"))
    rows = companies.join(people, "C_ID", "left").join(places, "C_ID", "left").join(notes, F.lower(T.tidy("Company")) == F.col("school"), "left")
    return canonical(rows.filter(T.tidy("Company").isNotNull()).select(
        T.tidy("Company").alias("organization_name"), F.lit(dataset).alias("source_dataset"), F.concat(F.lit("contact:"), F.col("C_ID").cast("long")).alias("source_record_id"), "address", T.tidy("Category").alias("category"), T.tidy("Status").alias("status"),
        T.normalize_website("Website").alias("website"), F.col("capture_note").alias("notes"), T.tidy("Priority").alias("priority"), F.col("Last_Order_Date").alias("last_interaction_date"), "contact_names", "contact_roles", "contact_emails", "contact_phones", "pos",
    ))


def registry_source(rows: DataFrame, dataset: str = "SACAA Cleaned", category: str = "Flight School") -> DataFrame:
    """One contact a row; cells with several e-mails are split; the province is the area too."""
    some = lambda c: F.filter(F.array(c), lambda x: x.isNotNull())
    name = T.tidy("`Name of Organisation`")
    return canonical(rows.filter(name.isNotNull()).select(
        name.alias("organization_name"), F.lit(dataset).alias("source_dataset"), F.concat(F.lit("sacaa:"), name).alias("source_record_id"), T.normalize_province("Province").alias("province"), T.normalize_province("Province").alias("area"), F.lit(category).alias("category"),
        T.tidy("Status").alias("status"), T.normalize_website("`Website URL`").alias("website"), some(T.tidy("`Contact Person`")).alias("contact_names"), T.split_emails("`Contact Email Address`").alias("contact_emails"), some(T.normalize_phone("`Contact Number`")).alias("contact_phones"), "pos",
    ))
