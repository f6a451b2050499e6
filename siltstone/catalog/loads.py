"""The layered loads over the nested accounts, and the whole chain."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.catalog.grouping import GROUP_BY
from siltstone.catalog.inputs import (
    ACCOUNT_LEAVES,
    ACCOUNT_SCHEMA,
    ACCOUNTS_SQL,
    LOADED_AT,
    accounts,
    landed_accounts,
)
from siltstone.operators.contract import ContractError
from siltstone.plans import (
    AggregateSpec,
    RawSpec,
    RefinedSpec,
    Run,
    load_aggregate,
    load_chain,
    load_raw,
    load_refined,
)
from siltstone.plans.medallion import regional_views
from siltstone.sources import ledger, snapshots, tables
from siltstone.sources.scratch import scratch_path

LATER = "2025-02-15 10:30:00"
LOAD_COLUMNS = {"ingestion_timestamp": "ingestion_timestamp", "source_system": "source_system"}

RAW = RawSpec(ACCOUNT_SCHEMA, "accounts")
REFINED = RefinedSpec(
    columns=ACCOUNT_LEAVES | LOAD_COLUMNS,
    required=["n_name"],
    key=["c_custkey"],
    contract=[*ACCOUNT_SCHEMA.fieldNames(), *LOAD_COLUMNS],
    partition_by=["r_name"],
)
AGGREGATE = AggregateSpec(
    group_by=GROUP_BY,
    counted="c_custkey",
    key="n_name",
    measure="n_customers",
    partition_by=["r_name"],
)
RUN = Run("0a1b2c3d", LOADED_AT)


def _raw(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "raw")
    load_raw(spark, landed_accounts(spark, sf_dir), path, RAW, RUN)
    return path


def _refined(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "refined")
    load_refined(spark, _raw(spark, sf_dir), path, REFINED, RUN)
    return path


def bronze_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = tables.read_parquet(spark, _raw(spark, sf_dir))
    return raw.select(
        "c_custkey",
        F.col("nation.n_name").alias("n_name"),
        F.date_format("ingestion_timestamp", "yyyy-MM-dd HH:mm:ss").alias("loaded_at"),
        "source_system",
        (F.col("file_name") != "").alias("has_file"),
        "year",
        "month",
    )


def silver_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded twice; between the loads every third customer goes, every third
    gets another balance and every third comes back under a new key."""
    path = scratch_path(spark, "refined")
    load_refined(spark, _raw(spark, sf_dir), path, REFINED, RUN)
    changed = accounts(spark, sf_dir).filter("c_custkey % 3 <> 0").withColumns(
        {
            "c_custkey": F.expr("IF(c_custkey % 3 = 1, c_custkey, -c_custkey)"),
            "account": F.struct((F.col("account.c_acctbal") + 1).alias("c_acctbal"), "account.c_mktsegment"),
        }
    )
    landed, raw = scratch_path(spark, "landing"), scratch_path(spark, "raw")
    changed.write.json(landed)
    load_raw(spark, landed, raw, RAW, Run("4e5f", LATER))
    load_refined(spark, raw, path, REFINED, Run("4e5f", LATER))
    return snapshots.read_snapshot(spark, path).drop("ingestion_timestamp")


def silver_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month of raw rows merged without deletes, read by its partition alone and spread over more tasks."""
    path, raw = scratch_path(spark, "refined"), scratch_path(spark, "raw")
    spec = replace(REFINED, delete_unmatched=False, repartition=4)
    load_raw(spark, landed_accounts(spark, sf_dir), raw, RAW, RUN)
    load_refined(spark, raw, path, spec, RUN)
    landed = scratch_path(spark, "landing")
    later = accounts(spark, sf_dir).filter("c_custkey % 2 = 0").withColumn("c_name", F.upper("c_name"))
    later.write.json(landed)
    load_raw(spark, landed, raw, replace(RAW, mode="dynamic"), Run("4e5f", LATER))
    load_refined(spark, raw, path, replace(spec, raw_filter="year = 2025 AND month = 2"), Run("4e5f", LATER))
    return snapshots.read_snapshot(spark, path).select("c_custkey", "c_name", "n_name")


def _aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "aggregate")
    load_aggregate(spark, _refined(spark, sf_dir), path, AGGREGATE, RUN)
    return snapshots.read_snapshot(spark, path)


def gold_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aggregate(spark, sf_dir)


def gold_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both regional views of the loaded aggregate, in one grouping."""
    return regional_views(_aggregate(spark, sf_dir), ["r_name"], "n_customers", "n_name", "n_nations")


def medallion_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing, lake = landed_accounts(spark, sf_dir), scratch_path(spark, "lake")
    return load_chain(spark, landing, lake, RAW, REFINED, AGGREGATE, RUN)


def _ledgers(spark: SparkSession, sf_dir: str) -> str:
    """What a refined load without required fields leaves in its ledgers."""
    ledgers = scratch_path(spark, "ledger")
    spec = replace(REFINED, required=["c_name"], batch_by=["c_mktsegment"], store_rejects=True)
    load_refined(spark, _raw(spark, sf_dir), scratch_path(spark, "refined"), spec, RUN, ledgers)
    return ledgers


def load_ledgers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality report per batch, and the audit row, as a load wrote them."""
    ledgers = _ledgers(spark, sf_dir)
    batches = ledger.read_runs(
        spark, f"{ledgers}/batches", StructType.fromDDL("c_mktsegment string, records bigint, null_records bigint, status string")
    )
    audit = ledger.read_runs(spark, f"{ledgers}/audit", StructType.fromDDL("pipeline string, records bigint, status string, attempt int"))
    return batches.selectExpr("c_mktsegment AS what", "records", "status", "null_records AS n").unionByName(
        audit.selectExpr("pipeline AS what", "records", "status", "CAST(attempt AS bigint) AS n")
    )


def load_invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The invalid rows that a load named in its ledger."""
    schema = StructType.fromDDL("c_custkey bigint, null_columns string")
    return ledger.read_runs(spark, f"{_ledgers(spark, sf_dir)}/invalid", schema).select("c_custkey", "null_columns")


def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a load dropped and kept in its ledger."""
    ledgers = scratch_path(spark, "ledger")
    spec = replace(REFINED, store_rejects=True)
    load_refined(spark, _raw(spark, sf_dir), scratch_path(spark, "refined"), spec, RUN, ledgers)
    schema = StructType.fromDDL("c_custkey bigint, c_name string, c_acctbal double")
    return ledger.read_runs(spark, f"{ledgers}/rejects", schema).select("c_custkey", "c_name", "c_acctbal")


def failed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that breaks its contract, and its retry: both are on record."""
    ledgers, raw = scratch_path(spark, "ledger"), _raw(spark, sf_dir)
    broken = replace(REFINED, contract=[*REFINED.contract, "c_phone"])
    try:
        load_refined(spark, raw, scratch_path(spark, "refined"), broken, RUN, ledgers)
    except ContractError:
        load_refined(spark, raw, scratch_path(spark, "refined"), REFINED, replace(RUN, attempt=2), ledgers)
    schema = StructType.fromDDL("pipeline string, records bigint, status string, attempt int")
    return ledger.read_runs(spark, f"{ledgers}/audit", schema).select("attempt", "pipeline", "status", "records")


QUERIES = {
    "bronze_load": bronze_load,
    "silver_load": silver_load,
    "silver_upsert": silver_upsert,
    "gold_load": gold_load,
    "gold_views": gold_views,
    "medallion_end_to_end": medallion_end_to_end,
    "load_ledgers": load_ledgers,
    "load_invalid_rows": load_invalid_rows,
    "load_rejects": load_rejects,
    "failed_load": failed_load,
}

_GOLD = f"""
    SELECT n_name, r_name, count(c_custkey) AS n_customers,
           '{LOADED_AT}' AS processed_at, '0a1b2c3d' AS run_id
    FROM ({ACCOUNTS_SQL}) WHERE n_name IS NOT NULL
    GROUP BY n_name, r_name"""
_HOME = f"SELECT * FROM ({ACCOUNTS_SQL}) WHERE n_name IS NOT NULL"

ORACLES = {
    "bronze_load": f"""
        SELECT c_custkey, n_name, '{LOADED_AT}' AS loaded_at,
               'accounts' AS source_system, TRUE AS has_file,
               2025::INTEGER AS year, 1::INTEGER AS month
        FROM ({ACCOUNTS_SQL})""",
    "silver_load": f"""
        SELECT CASE WHEN c_custkey % 3 = 1 THEN c_custkey ELSE -c_custkey END AS c_custkey,
               c_name, c_acctbal + 1 AS c_acctbal, c_mktsegment, n_nationkey, n_name, r_regionkey, r_name,
               'accounts' AS source_system
        FROM ({_HOME}) WHERE c_custkey % 3 <> 0""",
    "silver_upsert": f"""
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN upper(c_name) ELSE c_name END AS c_name, n_name
        FROM ({_HOME})""",
    "gold_load": _GOLD,
    "gold_views": f"""
        SELECT r_name, sum(n_customers)::BIGINT AS n_customers, count(n_name) AS n_nations
        FROM ({_GOLD}) GROUP BY r_name""",
    "medallion_end_to_end": _GOLD,
    "load_ledgers": f"""
        WITH counts AS (
            SELECT c_mktsegment AS what, count(*) AS records, count(*) FILTER (n_name IS NULL) AS n
            FROM ({ACCOUNTS_SQL}) GROUP BY c_mktsegment),
        everything AS (SELECT 'refined' AS what, sum(records)::BIGINT AS records, sum(n)::BIGINT AS n FROM counts),
        graded AS (
            SELECT *, round((records - n)::DOUBLE / records * 100, 2) AS quality
            FROM (SELECT * FROM counts UNION ALL SELECT * FROM everything)),
        named AS (
            SELECT *, CASE WHEN n = 0 THEN 'SUCCESS' WHEN quality >= 99 THEN 'WARNING'
                           WHEN quality >= 95 THEN 'ERROR' ELSE 'CRITICAL' END AS status
            FROM graded)
        SELECT what, records, status, CASE WHEN what = 'refined' THEN 1 ELSE n END::BIGINT AS n FROM named""",
    "load_invalid_rows": f"""
        SELECT c_custkey, 'n_nationkey, n_name, r_regionkey, r_name' AS null_columns
        FROM ({ACCOUNTS_SQL}) WHERE n_name IS NULL""",
    "load_rejects": f"SELECT c_custkey, c_name, c_acctbal FROM ({ACCOUNTS_SQL}) WHERE n_name IS NULL",
    "failed_load": f"""
        SELECT 1::INTEGER AS attempt, 'refined' AS pipeline, 'FAILED' AS status, 0::BIGINT AS records
        UNION ALL
        SELECT 2, 'refined', 'SUCCESS', count(*) FROM ({_HOME})""",
}
