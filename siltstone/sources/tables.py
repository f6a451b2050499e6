"""Plain Parquet tables, and reading a table of either kind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.sources import snapshots
from siltstone.sources.layout import clustered


def read_parquet(
    spark: SparkSession, path: str, schema: StructType | str | None = None, merge_schema: bool = False
) -> DataFrame:
    """A Parquet table with its partition columns, which come last.

    Partition values are text in the path; without a schema their types are
    guessed again, so that ``01`` returns as the integer 1. Without a schema
    the columns are those of one file; ``merge_schema`` takes those of all
    files, for tables whose later partitions brought new ones.
    """
    reader = spark.read.option("mergeSchema", merge_schema)
    return (reader if schema is None else reader.schema(schema)).parquet(path)


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "static",
    cluster: bool = False,
) -> int:
    """Overwrite a Parquet table and return the rows written.

    ``static`` replaces the whole table, ``dynamic`` only the partitions that
    ``df`` has rows for. ``cluster`` shuffles by the partition columns first;
    leave it off where each task holds few partition values, as at ingestion.
    The count is taken during the write, in its last stage.
    """
    written = Observation()
    rows = clustered(df, partition_by) if cluster else df
    (
        rows.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*partition_by)
        .parquet(path)
    )
    return written.get["rows"]


def detect_format(spark: SparkSession, path: str) -> str:
    """``snapshot`` for a path with a commit history, else ``parquet``."""
    return "snapshot" if snapshots.is_snapshot_table(spark, path) else "parquet"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The current state of a table of either kind."""
    if detect_format(spark, path) == "snapshot":
        return snapshots.read_snapshot(spark, path)
    return read_parquet(spark, path)
