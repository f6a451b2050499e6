"""Merges: earlier and later orders per customer, line prices per order as a
target whose keys repeat, and keys of two names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.catalog.inputs import table
from siltstone.operators import merge, ranges

TURN = "1998-01-01"


def _customers(spark: SparkSession, sf_dir: str, period: Column) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(period)
        .groupBy("o_custkey")
        .agg(F.count(F.lit(1)).alias("n_orders"), F.max("o_totalprice").alias("top_price"))
    )


def _earlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, F.col("o_orderdate") < F.lit(TURN).cast("timestamp_ntz"))


def _later(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, F.col("o_orderdate") >= F.lit(TURN).cast("timestamp_ntz"))


def merge_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge(_earlier(spark, sf_dir), _later(spark, sf_dir), ["o_custkey"])


def merge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    earlier, later = _earlier(spark, sf_dir), _later(spark, sf_dir)
    return merge.merge(earlier, later, ["o_custkey"], delete_unmatched=False)


def merge_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_actions(_earlier(spark, sf_dir), _later(spark, sf_dir), ["o_custkey"])


def merge_update_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates that change the count of orders; a new price alone is ignored."""
    earlier, later = _earlier(spark, sf_dir), _later(spark, sf_dir)
    return merge.update_kinds(earlier, later, ["o_custkey"], ignore=["top_price"])


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("order_key"), F.col("l_extendedprice").alias("price")
    )


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price")
    )


def merge_repeated_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a repeated target key takes the source's values."""
    return merge.merge(_lines(spark, sf_dir), _orders(spark, sf_dir), ["order_key"])


def merge_cardinality_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.merge_conflicts(_orders(spark, sf_dir), _lines(spark, sf_dir), ["order_key"])


def _line_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, what its lines come to, under the lines' names."""
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("price"))


def merge_key_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is called order_key in the target and l_orderkey in the source."""
    orders, lines = _orders(spark, sf_dir), _line_totals(spark, sf_dir)
    return merge.merge(orders, lines, [("order_key", "l_orderkey")], delete_unmatched=False)


def merge_with_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders take their dearest line's price where that is below their own."""
    orders, lines = _orders(spark, sf_dir), _line_totals(spark, sf_dir)
    pair = [("order_key", "l_orderkey")]
    return merge.merge(orders, lines, pair, delete_unmatched=False, condition="source.price < target.price")


def merge_small_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest orders, one more for each, into all of them; the others are not shuffled."""
    orders = _orders(spark, sf_dir)
    raised = orders.filter("price > 400000").withColumn("price", F.col("price") + 1)
    new = raised.withColumn("order_key", -F.col("order_key"))
    return merge.merge_delta(orders, raised.unionByName(new), ["order_key"])


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_key"), F.col("o_orderdate").alias("ordered"), F.col("o_totalprice").alias("price")
    )


def merge_date_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of every other quarter take the number, last date and top price of their quarter; each range is of
    many weekly bins, and a range a year on, which no order falls into, is inserted."""
    orders = _dated(spark, sf_dir)
    quarter = (F.year("ordered") * 4 + F.quarter("ordered")).cast("long")
    quarters = orders.groupBy(quarter.alias("order_key")).agg(
        F.min("ordered").alias("starts"), F.max("ordered").alias("ordered"), F.max("price").alias("price")
    )
    even = quarters.filter("order_key % 2 = 0").withColumn("ends", F.col("ordered"))
    year = F.expr("INTERVAL 1 YEAR")
    late = orders.agg(
        F.lit(-1).cast("long").alias("order_key"), (F.max("ordered") + year).alias("starts"), (F.max("ordered") + year).alias("ordered"),
        F.lit(0.0).alias("price"), (F.max("ordered") + year + year).alias("ends"),
    )
    return ranges.merge_ranges(
        orders, even.unionByName(late), "ordered", ("starts", "ends"), width=7, delete_unmatched=False
    )


QUERIES = {
    "merge_sync": merge_sync,
    "merge_upsert": merge_upsert,
    "merge_actions": merge_actions,
    "merge_update_kinds": merge_update_kinds,
    "merge_repeated_targets": merge_repeated_targets,
    "merge_key_pairs": merge_key_pairs,
    "merge_with_condition": merge_with_condition,
    "merge_cardinality_conflicts": merge_cardinality_conflicts,
    "merge_small_delta": merge_small_delta,
    "merge_date_ranges": merge_date_ranges,
}

_GROUPED = """
    SELECT o_custkey, count(*) AS n_orders, max(o_totalprice) AS top_price FROM orders
    WHERE o_orderdate {} TIMESTAMP '{}' GROUP BY o_custkey"""
_WITH = f"WITH earlier AS ({_GROUPED.format('<', TURN)}), later AS ({_GROUPED.format('>=', TURN)})"

ORACLES = {
    "merge_sync": f"{_WITH} SELECT * FROM later",
    "merge_upsert": f"""
        {_WITH} SELECT * FROM later
        UNION ALL
        SELECT * FROM earlier WHERE o_custkey NOT IN (SELECT o_custkey FROM later)""",
    "merge_actions": f"""
        {_WITH},
        sided AS (
            SELECT e.o_custkey AS e, l.o_custkey AS l
            FROM earlier e FULL JOIN later l ON e.o_custkey = l.o_custkey)
        SELECT 'update' AS action, count(*) AS n_rows FROM sided
        WHERE e IS NOT NULL AND l IS NOT NULL
        UNION ALL SELECT 'insert', count(*) FROM sided WHERE e IS NULL
        UNION ALL SELECT 'delete', count(*) FROM sided WHERE l IS NULL""",
    "merge_update_kinds": f"""
        {_WITH},
        matched AS (
            SELECT e.n_orders = l.n_orders AS same
            FROM earlier e JOIN later l ON e.o_custkey = l.o_custkey)
        SELECT 'changed' AS kind, count(*) FILTER (NOT same) AS n_rows FROM matched
        UNION ALL SELECT 'same', count(*) FILTER (same) FROM matched""",
    "merge_repeated_targets": """
        SELECT o_orderkey AS order_key, o_totalprice AS price
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "merge_key_pairs": """
        SELECT o_orderkey AS order_key, coalesce(price, o_totalprice) AS price
        FROM orders LEFT JOIN (
            SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey)
        ON l_orderkey = o_orderkey
        UNION ALL
        SELECT l_orderkey, max(l_extendedprice) FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey""",
    "merge_with_condition": """
        WITH lines AS (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem GROUP BY l_orderkey),
        sided AS (
            SELECT o_orderkey, o_totalprice, l_orderkey, price, price < o_totalprice AS met
            FROM orders FULL JOIN lines ON l_orderkey = o_orderkey)
        SELECT o_orderkey AS order_key, CASE WHEN met THEN price ELSE o_totalprice END AS price
        FROM sided WHERE o_orderkey IS NOT NULL
        UNION ALL
        SELECT l_orderkey, price FROM sided WHERE l_orderkey IS NOT NULL AND NOT coalesce(met, FALSE)""",
    "merge_cardinality_conflicts": """
        SELECT l_orderkey AS order_key, count(*) AS copies FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
        GROUP BY l_orderkey HAVING count(*) > 1""",
    "merge_small_delta": """
        SELECT o_orderkey AS order_key, o_totalprice + CASE WHEN o_totalprice > 400000 THEN 1 ELSE 0 END AS price
        FROM orders
        UNION ALL
        SELECT -o_orderkey, o_totalprice + 1 FROM orders WHERE o_totalprice > 400000""",
    "merge_date_ranges": """
        WITH dated AS (SELECT *, year(o_orderdate) * 4 + quarter(o_orderdate) AS q FROM orders),
        quarters AS (
            SELECT q, max(o_orderdate) AS last, max(o_totalprice) AS price FROM dated WHERE q % 2 = 0 GROUP BY q)
        SELECT coalesce(quarters.q, o_orderkey)::BIGINT AS order_key, coalesce(last, o_orderdate) AS ordered,
               coalesce(price, o_totalprice) AS price
        FROM dated LEFT JOIN quarters ON dated.q = quarters.q
        UNION ALL
        SELECT -1, max(o_orderdate) + INTERVAL 1 YEAR, 0.0 FROM orders""",
}
