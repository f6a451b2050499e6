"""Input frames the queries share, all derived from whole tables.

``ACCOUNTS``    customers as nested records: who they are, their account, and
                where they are at home. Those with a negative balance have no
                home, so refined loads drop them.
``LABELLED``    documents left-joined to labels: most documents have none.
``TOTALS``      one measure per customer, with blank, null, zero and negative
                values in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.operators.enrich import flatten, struct_leaves
from siltstone.sources.scratch import scratch_path

LOADED_AT = "2025-01-15 10:30:00"

# customer -> nation -> region, each level with the columns its table has.
_REGION = StructType().add("r_regionkey", "integer").add("r_name", "string")
_NATION = StructType().add("n_nationkey", "integer").add("n_name", "string").add("region", _REGION)
_ACCOUNT = StructType().add("c_acctbal", "double").add("c_mktsegment", "string")
ACCOUNT_SCHEMA = (
    StructType().add("c_custkey", "long").add("c_name", "string").add("account", _ACCOUNT).add("nation", _NATION)
)
# Every leaf under its own name.
ACCOUNT_LEAVES = {
    path.replace("`", "").split(".")[-1]: path
    for path in struct_leaves(ACCOUNT_SCHEMA).values()
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    region = F.struct("r_regionkey", "r_name").alias("region")
    return (
        customers.join(nations, F.expr("c_nationkey = n_nationkey"))
        .join(regions, F.expr("n_regionkey = r_regionkey"))
        .select(
            "c_custkey", "c_name", F.struct("c_acctbal", "c_mktsegment").alias("account"),
            F.when(F.col("c_acctbal") >= 0, F.struct("n_nationkey", "n_name", region)).alias("nation"),
        )
    )


def landed_accounts(spark: SparkSession, sf_dir: str) -> str:
    """The accounts written as JSON lines; returns the folder."""
    path = scratch_path(spark, "landing")
    accounts(spark, sf_dir).write.json(path)
    return path


ACCOUNTS_SQL = """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
       CASE WHEN c_acctbal >= 0 THEN n_nationkey END AS n_nationkey,
       CASE WHEN c_acctbal >= 0 THEN n_name END AS n_name,
       CASE WHEN c_acctbal >= 0 THEN r_regionkey END AS r_regionkey,
       CASE WHEN c_acctbal >= 0 THEN r_name END AS r_name
FROM customer JOIN nation ON c_nationkey = n_nationkey
              JOIN region ON n_regionkey = r_regionkey
"""


def flat_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(accounts(spark, sf_dir), ACCOUNT_LEAVES)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


LABELLED_SQL = "SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)"

SLICE = ["lang", "source", "quality", "toxic"]


def label_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few enough distinct values that invalid rows repeat."""
    return labelled(spark, sf_dir).select(*SLICE)


SLICE_SQL = f"SELECT lang, source, quality, toxic FROM ({LABELLED_SQL})"


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'MACHINERY' THEN '  ' "
        "ELSE c_name END AS code",
        "CASE WHEN c_acctbal < 0 THEN -1L WHEN c_acctbal < 1000 THEN 0L "
        "WHEN c_acctbal > 9000 THEN NULL ELSE c_custkey + 1 END AS total",
    )


TOTALS_SQL = """
SELECT c_custkey AS id,
       CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
            WHEN c_mktsegment = 'MACHINERY' THEN '  ' ELSE c_name END AS code,
       CASE WHEN c_acctbal < 0 THEN -1 WHEN c_acctbal < 1000 THEN 0
            WHEN c_acctbal > 9000 THEN NULL ELSE c_custkey + 1 END AS total
FROM customer
"""


def status_sql(duplicates: str, invalid: str, quality: str) -> str:
    return (
        f"CASE WHEN {duplicates} = 0 AND {invalid} = 0 THEN 'SUCCESS' "
        f"WHEN {quality} >= 99 THEN 'WARNING' WHEN {quality} >= 95 THEN 'ERROR' "
        f"ELSE 'CRITICAL' END"
    )


def percent_sql(valid: str, total: str) -> str:
    return (
        f"CASE WHEN {total} > 0 THEN round(({valid})::DOUBLE / {total} * 100, 2) "
        "ELSE 0.0::DOUBLE END"
    )
