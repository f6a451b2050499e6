"""Folders on whatever file system Spark is set up for.

The DataFrame API has no call for this, so it goes through the session's JVM;
a Spark Connect session has none, and the tables of this package need a
classic session.
"""

from __future__ import annotations

from datetime import UTC, datetime

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    files, folder = _resolve(spark, path)
    return files.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    files, folder = _resolve(spark, path)
    files.delete(folder, True)


def children(spark: SparkSession, path: str) -> dict[str, datetime]:
    """Names directly under a folder, with the time each was last changed."""
    files, folder = _resolve(spark, path)
    return {
        entry.getPath().getName(): datetime.fromtimestamp(entry.getModificationTime() / 1000, UTC)
        for entry in files.listStatus(folder)
    }


def parquet_files(spark: SparkSession, path: str) -> int:
    """Parquet files under a folder, in one pass over its listing."""
    files, folder = _resolve(spark, path)
    found, count = files.listFiles(folder, True), 0
    while found.hasNext():
        count += found.next().getPath().getName().endswith(".parquet")
    return count
