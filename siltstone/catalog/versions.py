"""Snapshot tables: versions, time travel, merge, history, maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.catalog.inputs import table
from siltstone.sources import snapshots, tables
from siltstone.sources.scratch import scratch_path

MONDAY = "2025-01-06 08:00:00"
TUESDAY = "2025-01-07 08:00:00"
WEDNESDAY = "2025-01-08 08:00:00"


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer")


def _solvent(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _customers(spark, sf_dir).filter(F.col("c_acctbal") >= 0)
    return customers.withColumn("c_acctbal", F.col("c_acctbal") + 1)


def _two_versions(spark: SparkSession, sf_dir: str) -> str:
    """All customers on Monday, those without debts on Tuesday."""
    path = scratch_path(spark, "customers")
    by = ["c_mktsegment"]
    snapshots.write_snapshot(_customers(spark, sf_dir), path, by, ["c_custkey"], MONDAY)
    snapshots.write_snapshot(_solvent(spark, sf_dir), path, by, ["c_custkey"], TUESDAY)
    return path


def snapshot_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both versions, the replaced one included."""
    path = _two_versions(spark, sf_dir)
    versions = [
        snapshots.read_snapshot(spark, path, version=v).withColumn("version", F.lit(v))
        for v in (0, 1)
    ]
    return versions[0].unionByName(versions[1])


def snapshot_read_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read_snapshot(spark, _two_versions(spark, sf_dir))


def time_travel_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read_snapshot(spark, _two_versions(spark, sf_dir), version=0)


def time_travel_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monday evening: Tuesday's version is not there yet."""
    path = _two_versions(spark, sf_dir)
    return snapshots.read_snapshot(spark, path, timestamp="2025-01-06 20:00:00")


def detect_format_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier")
    plain, versioned = scratch_path(spark, "plain"), scratch_path(spark, "versioned")
    tables.write_partitioned(suppliers, plain)
    snapshots.write_snapshot(suppliers, versioned)
    read = [
        tables.read_table(spark, path).withColumn(
            "format", F.lit(tables.detect_format(spark, path))
        )
        for path in (plain, versioned)
    ]
    return read[0].unionByName(read[1])


def write_or_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First run creates, second merges; suppliers in debt are gone."""
    path = scratch_path(spark, "suppliers")
    suppliers = table(spark, sf_dir, "supplier")
    later = suppliers.filter(F.col("s_acctbal") >= 0).withColumn(
        "s_acctbal", F.col("s_acctbal") * 2
    )
    for rows, at in ((suppliers, MONDAY), (later, TUESDAY)):
        snapshots.write_or_merge(rows, path, ["s_suppkey"], ["s_nationkey"], at=at)
    return snapshots.read_snapshot(spark, path)


def write_or_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of a later date merged without deletes, over a table of lines."""
    path = scratch_path(spark, "upsert")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_key"), F.col("l_extendedprice").alias("price")
    )
    orders = table(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    )
    later = orders.select(
        F.col("o_orderkey").alias("order_key"), F.col("o_totalprice").alias("price")
    )
    for rows, at in ((lines, MONDAY), (later, TUESDAY)):
        snapshots.write_or_merge(rows, path, ["order_key"], delete_unmatched=False, at=at)
    return snapshots.read_snapshot(spark, path)


def write_or_merge_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers with twice their balance: taken where that is more than is stored, and inserted where it is less."""
    path = scratch_path(spark, "conditional")
    suppliers = table(spark, sf_dir, "supplier")
    later = suppliers.withColumn("s_acctbal", F.col("s_acctbal") * 2).withColumnRenamed("s_suppkey", "key")
    pair, condition = [("s_suppkey", "key")], "source.s_acctbal > target.s_acctbal"
    snapshots.write_snapshot(suppliers, path, ["s_nationkey"], at=MONDAY)
    snapshots.write_or_merge(later, path, pair, delete_unmatched=False, condition=condition, at=TUESDAY)
    rows = snapshots.read_snapshot(spark, path)
    recorded = snapshots.current_commit(spark, path)["parameters"]["condition"]
    return rows.withColumn("condition", F.lit(recorded))


def _scattered_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders written by many tasks, each with a file for every status, and
    then compacted."""
    path = scratch_path(spark, "orders")
    orders = table(spark, sf_dir, "orders").repartition(24, "o_orderkey")
    snapshots.write_snapshot(orders, path, ["o_orderstatus"], at=MONDAY, cluster=False)
    # Whatever the sizes are: these queries are about what a rewrite leaves.
    snapshots.compact(spark, path, small_files=0, at=TUESDAY)
    return path


def compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.read_snapshot(spark, _scattered_orders(spark, sf_dir))


def file_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per version its folders, whether all its files hold rows, and the rows in them.

    How many files there are depends on the session, and the tests look at that.
    """
    path = _scattered_orders(spark, sf_dir)
    files = snapshots.file_inventory(spark, path).groupBy("version").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.countDistinct(F.regexp_replace("file_path", "/[^/]*$", "")).alias("n_folders"),
    )
    read = [
        snapshots.read_snapshot(spark, path, version=v)
        .select(F.lit(v).cast("bigint").alias("version"), F.input_file_name().alias("file"))
        for v in (0, 1)
    ]
    held = read[0].unionByName(read[1]).groupBy("version").agg(
        F.countDistinct("file").alias("n_files_with_rows"), F.count(F.lit(1)).alias("n_rows")
    )
    all_hold = (F.col("n_files") == F.col("n_files_with_rows")).alias("all_hold_rows")
    return files.join(held, "version", "left").select("version", "n_rows", all_hold, "n_folders")


def _history(spark: SparkSession, sf_dir: str) -> str:
    path = _two_versions(spark, sf_dir)
    snapshots.merge_snapshot(_customers(spark, sf_dir), path, ["c_custkey"], at=WEDNESDAY)
    return path


def history_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _history(spark, sf_dir)
    newest = snapshots.history_view(spark, path, limit=2)
    details = snapshots.commits(spark, path).select("version", "n_rows", "parameters.keys")
    at = F.date_format("commit_ts", "yyyy-MM-dd HH:mm:ss").alias("committed")
    return newest.join(details, "version").select("version", "operation", at, "n_rows", "keys")


def expired_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A week and an hour after Tuesday: Monday's version may go."""
    path = _history(spark, sf_dir)
    expired = snapshots.expired_versions(spark, path, now="2025-01-14 09:00:00")
    counted = snapshots.commits(spark, path).select("version", "n_rows", "operation")
    return expired.join(counted, "version").select("version", "n_rows", "operation")


QUERIES = {
    "snapshot_overwrite": snapshot_overwrite,
    "snapshot_read_current": snapshot_read_current,
    "time_travel_version": time_travel_version,
    "time_travel_timestamp": time_travel_timestamp,
    "detect_format_scan": detect_format_scan,
    "write_or_merge": write_or_merge,
    "write_or_upsert": write_or_upsert,
    "write_or_merge_where": write_or_merge_where,
    "compact": compact,
    "file_inventory": file_inventory,
    "history_view": history_view,
    "expired_versions": expired_versions,
}

_SOLVENT = """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal + 1 AS c_acctbal, c_mktsegment
    FROM customer WHERE c_acctbal >= 0"""

ORACLES = {
    "snapshot_overwrite": f"""
        SELECT *, 0 AS version FROM customer UNION ALL SELECT *, 1 AS version FROM ({_SOLVENT})""",
    "snapshot_read_current": _SOLVENT,
    "time_travel_version": "SELECT * FROM customer",
    "time_travel_timestamp": "SELECT * FROM customer",
    "detect_format_scan": """
        SELECT *, 'parquet' AS format FROM supplier
        UNION ALL SELECT *, 'snapshot' AS format FROM supplier""",
    "write_or_merge": """
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal * 2 AS s_acctbal
        FROM supplier WHERE s_acctbal >= 0""",
    "write_or_upsert": """
        WITH later AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
        SELECT o_orderkey AS order_key, o_totalprice AS price
        FROM later LEFT JOIN lineitem ON l_orderkey = o_orderkey
        UNION ALL
        SELECT l_orderkey, l_extendedprice FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM later)""",
    "write_or_merge_where": """
        SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal > 0 THEN s_acctbal * 2 ELSE s_acctbal END AS s_acctbal,
               'source.s_acctbal > target.s_acctbal' AS condition
        FROM supplier
        UNION ALL
        SELECT s_suppkey, s_name, s_nationkey, s_acctbal * 2, 'source.s_acctbal > target.s_acctbal'
        FROM supplier WHERE NOT s_acctbal > 0""",
    "compact": "SELECT * FROM orders",
    "file_inventory": """
        SELECT unnest([0, 1])::BIGINT AS version, count(*) AS n_rows, TRUE AS all_hold_rows,
               count(DISTINCT o_orderstatus) AS n_folders FROM orders""",
    "history_view": f"""
        SELECT 2::BIGINT AS version, 'MERGE' AS operation, '{WEDNESDAY}' AS committed,
               (SELECT count(*) FROM customer) AS n_rows, 'c_custkey' AS keys
        UNION ALL
        SELECT 1::BIGINT, 'OVERWRITE', '{TUESDAY}', (SELECT count(*) FROM ({_SOLVENT})), NULL""",
    "expired_versions": """
        SELECT 0::BIGINT AS version, count(*) AS n_rows, 'CREATE' AS operation FROM customer""",
}
