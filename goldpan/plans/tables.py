"""Driver tables, and the organisations that are derived from them: customers and suppliers as two sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.functions.text import slugify_ascii
from goldpan.operators.mapping import canonical

PRIORITIES = {"Suppliers": 2, "Customers": 1}
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
SUPPLIERS_FROM = 1 << 40


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical rows with slug and pos."""
    nation = read(spark, sf_dir, "nation")
    last = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("seen"))
    c = read(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(last, F.col("c_custkey") == F.col("o_custkey"), "left")
    k = F.col("c_custkey")
    none = F.array().cast("array<string>")
    customers = c.select(
        F.concat(F.lit("Company "), k % 40, F.lit(" "), "c_mktsegment").alias("organization_name"), F.lit("Customers").alias("source_dataset"), F.concat(F.lit("c"), k).alias("source_record_id"),
        F.when(k % 3 != 0, F.col("n_name")).alias("province"), F.when(k % 4 != 1, F.concat(k % 7, F.lit(" Main St"))).alias("address"), F.when(F.col("c_acctbal") >= 0, "active").alias("status"),
        F.concat(F.lit("https://c"), k % 40, F.lit(".example")).alias("website"), F.when(k % 5 != 0, F.array(F.concat(F.lit("user"), k % 13, F.lit("@c"), k % 40, F.lit(".example")))).otherwise(none).alias("contact_emails"),
        F.when(k % 2 == 0, F.array(F.concat(F.lit("+2782"), F.lpad((k % 10_000_000).cast("string"), 7, "0")))).otherwise(none).alias("contact_phones"), F.array("c_name").alias("contact_names"),
        F.array(F.when(k % 6 == 0, "Manager").otherwise("Owner")).alias("contact_roles"), F.col("seen").alias("last_interaction_date"), k.alias("pos"),
    )
    s = read(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    j = F.col("s_suppkey")
    suppliers = s.select(
        F.concat(F.lit("Company "), j % 40, F.lit(" "), F.element_at(F.array(*map(F.lit, SEGMENTS)), (j % 5 + 1).cast("int"))).alias("organization_name"), F.lit("Suppliers").alias("source_dataset"), F.concat(F.lit("s"), j).alias("source_record_id"),
        F.when(j % 2 == 0, F.col("n_name")).alias("province"), F.concat(F.lit("Dock "), j % 3).alias("address"), F.when(F.col("s_acctbal") >= 0, "supplier").alias("status"), F.lit(None).cast("string").alias("website"),
        F.when(j % 4 == 0, F.array(F.concat(F.lit("sales@s"), j % 9, F.lit(".example")))).otherwise(none).alias("contact_emails"), none.alias("contact_phones"), F.array("s_name").alias("contact_names"), none.alias("contact_roles"),
        F.lit(None).cast("string").alias("last_interaction_date"), (j + SUPPLIERS_FROM).alias("pos"),
    )
    return canonical(customers.unionByName(suppliers)).withColumn("slug", slugify_ascii("organization_name"))


#: The same rows for DuckDB.
ORGS_SQL = f"""
last AS (SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS seen FROM orders GROUP BY o_custkey),
orgs0 AS (
  SELECT 'Company ' || (c_custkey % 40) || ' ' || c_mktsegment AS organization_name, 'Customers' AS source_dataset, 'c' || c_custkey AS source_record_id,
    CASE WHEN c_custkey % 3 <> 0 THEN n_name END AS province, CASE WHEN c_custkey % 4 <> 1 THEN (c_custkey % 7) || ' Main St' END AS address,
    CASE WHEN c_acctbal >= 0 THEN 'active' END AS status, 'https://c' || (c_custkey % 40) || '.example' AS website,
    CASE WHEN c_custkey % 5 <> 0 THEN 'user' || (c_custkey % 13) || '@c' || (c_custkey % 40) || '.example' END AS email,
    CASE WHEN c_custkey % 2 = 0 THEN '+2782' || lpad(CAST(c_custkey % 10000000 AS VARCHAR), 7, '0') END AS phone, c_name AS contact,
    CASE WHEN c_custkey % 6 = 0 THEN 'Manager' ELSE 'Owner' END AS role, seen, c_custkey AS pos
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN last ON c_custkey = o_custkey
  UNION ALL
  SELECT 'Company ' || (s_suppkey % 40) || ' ' || (['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'])[s_suppkey % 5 + 1], 'Suppliers', 's' || s_suppkey,
    CASE WHEN s_suppkey % 2 = 0 THEN n_name END, 'Dock ' || (s_suppkey % 3), CASE WHEN s_acctbal >= 0 THEN 'supplier' END, NULL,
    CASE WHEN s_suppkey % 4 = 0 THEN 'sales@s' || (s_suppkey % 9) || '.example' END, NULL, s_name, NULL, NULL, s_suppkey + {SUPPLIERS_FROM}
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
),
orgs AS (
  SELECT *, lower(replace(organization_name, ' ', '-')) AS slug, CASE source_dataset WHEN 'Suppliers' THEN 2 ELSE 1 END AS priority,
    (email IS NOT NULL)::INT + (phone IS NOT NULL)::INT + (website IS NOT NULL)::INT + (province IS NOT NULL)::INT + (address IS NOT NULL)::INT AS quality FROM orgs0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY priority DESC, quality DESC, seen DESC NULLS LAST, pos) AS rnk FROM orgs)
"""
