"""Append-only report and audit tables.

Rows are kept under ``stage=.../run_id=...``. A run that is repeated replaces
its own rows and no others, so a retry leaves no second copy; two runs never
meet, however close in time. Audit rows are kept per attempt of a run as well:
a retry with the next attempt number leaves the failed one on record.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from siltstone.operators.enrich import STAMP_FORMAT, moment

# The parts of a quality report that are stored.
QUALITY_COLUMNS = (
    "records",
    "valid_records",
    "duplicates",
    "null_records",
    "quality",
    "status",
)
PARTITIONS = ("stage", "run_id")


def append_run(
    df: DataFrame,
    path: str,
    stage: str,
    run_id: str,
    file_format: str = "parquet",
    attempt: int | None = None,
) -> StructType:
    """Store the rows of one stage of one run; returns the table's schema."""
    rows = df.withColumns({"stage": F.lit(stage), "run_id": F.lit(run_id)})
    if attempt is not None:
        rows = rows.withColumn("attempt", F.lit(attempt))
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS, *([] if attempt is None else ["attempt"]))
        .format(file_format)
        .save(path)
    )
    return rows.schema


def read_runs(
    spark: SparkSession, path: str, schema: StructType, file_format: str = "parquet"
) -> DataFrame:
    """The stored rows, ``stage`` and ``run_id`` as the text they were."""
    for name in PARTITIONS:
        if name not in schema.fieldNames():
            schema = StructType([*schema.fields]).add(name, StringType())
    return spark.read.schema(schema).format(file_format).load(path)


def append_quality(
    report: DataFrame, path: str, stage: str, run_id: str, file_format: str = "parquet"
) -> StructType:
    """Store a quality report: its six stored columns, and the batch columns
    of a report per batch."""
    batch = report.columns[: report.columns.index("records")]
    return append_run(report.select(*batch, *QUALITY_COLUMNS), path, stage, run_id, file_format)


def append_rules(
    report: DataFrame, path: str, stage: str, run_id: str, file_format: str = "parquet"
) -> StructType:
    """Store a rule report, all its columns."""
    return append_run(report, path, stage, run_id, file_format)


def audit_rows(
    report: DataFrame,
    name: str,
    seconds: float,
    version: str,
    at: datetime | str | None = None,
    records: str = "records",
) -> DataFrame:
    """Audit rows of a load from its report, one per report row."""
    batch = report.columns[: report.columns.index(records)]
    return report.select(
        *batch,
        F.lit(name).alias("pipeline"),
        "status",
        F.col(records).alias("records"),
        "quality",
        F.round(F.lit(float(seconds)), 2).alias("execution_time"),
        F.lit(version).alias("version"),
        F.date_format(moment(at), STAMP_FORMAT).alias("timestamp"),
    )


def append_audit(
    audit: DataFrame,
    path: str,
    stage: str,
    run_id: str,
    file_format: str = "parquet",
    attempt: int = 1,
) -> StructType:
    """Store audit rows: version and timestamp are left out, and the time
    taken is called ``duration``."""
    stored = audit.drop("version", "timestamp").withColumnRenamed("execution_time", "duration")
    return append_run(stored, path, stage, run_id, file_format, attempt)
