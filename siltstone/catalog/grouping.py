"""Grouped counts, roll-ups and ordered views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.catalog.inputs import LOADED_AT, ACCOUNTS_SQL, flat_accounts, table
from siltstone.operators import aggregate, enrich

GROUP_BY = ["n_name", "r_name"]


def count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregate.count_by(flat_accounts(spark, sf_dir), GROUP_BY, "c_custkey", "n_customers")


def total_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_by_group(spark, sf_dir)
    return aggregate.total_by(counted, ["r_name"], "n_customers", "n_customers")


def nations_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_by_group(spark, sf_dir)
    return aggregate.count_by(counted, ["r_name"], "n_name", "n_nations")


def run_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.with_run_stamp(count_by_group(spark, sf_dir), "0a1b2c3d", LOADED_AT)


def gold_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ordered rows, each with its place in the order it came in."""
    ordered = aggregate.in_order(count_by_group(spark, sf_dir), ["n_name"])
    numbered = ordered.withColumn("_at", F.monotonically_increasing_id())
    place = F.row_number().over(Window.orderBy("_at"))
    return numbered.withColumn("place", place).drop("_at")


def top_n_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten first rows by price, ties settled by the unique key."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return aggregate.first_rows(orders, ["o_totalprice", "o_orderkey"], 10)


QUERIES = {
    "count_by_group": count_by_group,
    "total_by_region": total_by_region,
    "nations_by_region": nations_by_region,
    "run_stamp": run_stamp,
    "gold_sorted": gold_sorted,
    "top_n_preview": top_n_preview,
}

COUNTED_SQL = f"""
SELECT n_name, r_name, count(c_custkey) AS n_customers
FROM ({ACCOUNTS_SQL}) GROUP BY ALL
"""

ORACLES = {
    "count_by_group": COUNTED_SQL,
    "total_by_region": f"""
        SELECT r_name, sum(n_customers)::BIGINT AS n_customers
        FROM ({COUNTED_SQL}) GROUP BY r_name""",
    "nations_by_region": f"""
        SELECT r_name, count(n_name) AS n_nations
        FROM ({COUNTED_SQL}) GROUP BY r_name""",
    "run_stamp": f"""
        SELECT *, '{LOADED_AT}' AS processed_at, '0a1b2c3d' AS run_id FROM ({COUNTED_SQL})""",
    "gold_sorted": f"""
        SELECT *, row_number() OVER (ORDER BY n_name NULLS FIRST)::INTEGER AS place
        FROM ({COUNTED_SQL})""",
    "top_n_preview": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders
        ORDER BY o_totalprice, o_orderkey LIMIT 10""",
}
