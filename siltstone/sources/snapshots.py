"""Versioned tables on Parquet: one folder per version, one history row each.

    <table>/data/<version>-<token>/<partition columns>/*.parquet
    <table>/history/version=<version>/*.parquet

Data is written first and its history row last. Readers take a version's
folder from the history, so an unfinished write is never seen, and reading one
version lists no other version's files. Every commit writes a whole version
under a new name; nothing is changed in place, so a table can be read while it
is merged into.

One writer at a time: two writers of the same version both write data, and the
second one's history row fails because it exists. That is a check and not a
transaction, and object stores do not make it atomic.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import quoted
from siltstone.operators import merge as merging
from siltstone.operators.enrich import moment
from siltstone.sources import folders
from siltstone.sources.layout import clustered
from siltstone.sources.rows import one_row

HISTORY_SCHEMA = (
    "version bigint, commit_ts timestamp, operation string, parameters map<string,string>, "
    "n_rows bigint, location string, columns string, partition_by array<string>, "
    "unique_keys array<string>"
)

# Hours a replaced version is kept, and commits the history shows.
RETENTION_HOURS = 168
HISTORY_ROWS = 10
# Defaults of ``compact``: a folder is worth it with so many files smaller than so much.
SMALL_FILE_BYTES = 8 * 1024 * 1024
SMALL_FILES = 4
MESSAGE_ROWS = 20


# -- history ------------------------------------------------------------------


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All history rows of a table: one small row per commit."""
    return spark.read.schema(HISTORY_SCHEMA).parquet(f"{path}/history")


def is_snapshot_table(spark: SparkSession, path: str) -> bool:
    return current_commit(spark, path) is not None


def history(spark: SparkSession, path: str, limit: int = HISTORY_ROWS) -> DataFrame:
    """The last ``limit`` commits, newest first."""
    return commits(spark, path).orderBy(F.col("version").desc()).limit(limit)


def history_view(spark: SparkSession, path: str, limit: int = HISTORY_ROWS) -> DataFrame:
    return history(spark, path, limit).select("version", "commit_ts", "operation")


def current_commit(spark: SparkSession, path: str) -> Row | None:
    """The newest history row, ``None`` where there is no snapshot table.

    The newest version is read off the folder names, so one file is opened
    however many commits there are.
    """
    folder = f"{path}/history"
    if not folders.exists(spark, folder):
        return None
    versions = [int(n.removeprefix("version=")) for n in folders.children(spark, folder) if n.startswith("version=")]
    return _commit_row(spark, path, max(versions)) if versions else None


def _commit_row(spark: SparkSession, path: str, version: int) -> Row | None:
    rows = spark.read.schema(HISTORY_SCHEMA).option("basePath", f"{path}/history")
    return rows.parquet(f"{path}/history/version={version}").first()


def _existing(spark: SparkSession, path: str) -> Row:
    commit = current_commit(spark, path)
    if commit is None:
        raise ValueError(f"{path} is not a snapshot table")
    return commit


def commit_as_of(spark: SparkSession, path: str, timestamp: datetime | str) -> Row:
    """The newest commit at or before a moment."""
    found = commits(spark, path).filter(F.col("commit_ts") <= moment(timestamp))
    commit = found.orderBy(F.col("version").desc()).first()
    if commit is None:
        raise ValueError(f"{path} has no version at or before {timestamp}")
    return commit


# -- reading ------------------------------------------------------------------


def _read_commit(spark: SparkSession, path: str, commit: Row) -> DataFrame:
    schema = StructType.fromJson(json.loads(commit["columns"]))
    location = f"{path}/{commit['location']}"
    if not folders.exists(spark, location):
        raise ValueError(f"version {commit['version']} of {path} was removed")
    data = spark.read.schema(schema).parquet(location)
    return data.select([quoted(c) for c in schema.fieldNames()])


def read_snapshot(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    timestamp: datetime | str | None = None,
) -> DataFrame:
    """The current state, a version, or the state at a moment.

    A version wins when both are given. Columns have the order and types they
    were written with, partition columns included.
    """
    if version is not None:
        if not folders.exists(spark, f"{path}/history/version={version}"):
            raise ValueError(f"{path} has no version {version}")
        commit = _commit_row(spark, path, version)
    elif timestamp is not None:
        commit = commit_as_of(spark, path, timestamp)
    else:
        commit = _existing(spark, path)
    return _read_commit(spark, path, commit)


# -- writing ------------------------------------------------------------------


def _write(df: DataFrame, path: str, version: int, partition_by: Sequence[str]) -> tuple[str, int]:
    """The rows in a folder no history row names yet: its place, and how many they are."""
    location = f"data/{version:08d}-{uuid.uuid4().hex[:12]}"
    written = Observation()
    # Observed behind the last shuffle: a retried task is then counted once.
    (
        df.observe(written, F.count(F.lit(1)).alias("rows"))
        .write.mode("errorifexists")
        .partitionBy(*partition_by)
        .parquet(f"{path}/{location}")
    )
    return location, written.get["rows"]


def _commit(
    df: DataFrame,
    path: str,
    version: int,
    operation: str,
    partition_by: Sequence[str],
    parameters: dict[str, str],
    unique_keys: Sequence[str] | None,
    at: datetime | str | None,
) -> int:
    location, n_rows = _write(df, path, version, partition_by)
    return _record(df, path, version, operation, partition_by, parameters, unique_keys, at, location, n_rows)


def _record(
    df: DataFrame,
    path: str,
    version: int,
    operation: str,
    partition_by: Sequence[str],
    parameters: dict[str, str],
    unique_keys: Sequence[str] | None,
    at: datetime | str | None,
    location: str,
    n_rows: int,
) -> int:
    """The history row of rows that are written; with it the version is there."""
    unique = None if unique_keys is None else json.dumps(list(unique_keys))
    entry = one_row(
        df.sparkSession,
        {
            "operation": (operation, "string"),
            "parameters": (json.dumps(parameters), "string"),
            "n_rows": (n_rows, "bigint"),
            "location": (location, "string"),
            "columns": (df.schema.json(), "string"),
            "partition_by": (json.dumps(list(partition_by)), "string"),
            "unique_keys": (unique, "string"),
        },
    ).withColumns(
        {
            "commit_ts": moment(at),
            "parameters": F.from_json("parameters", "map<string,string>"),
            "partition_by": F.from_json("partition_by", "array<string>"),
            "unique_keys": F.from_json("unique_keys", "array<string>"),
        }
    )
    entry.write.mode("errorifexists").parquet(f"{path}/history/version={version}")
    return version


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    unique_keys: Sequence[str] | None = None,
    at: datetime | str | None = None,
    cluster: bool = True,
) -> int:
    """Create a table (version 0) or replace its rows; returns the version.

    ``unique_keys`` states that no non-null key of these columns repeats in
    ``df``; later merges on them then need no look at the stored keys.
    ``cluster=False`` leaves out the shuffle by partition columns, for rows
    that are laid out already.
    """
    return _replace(
        current_commit(df.sparkSession, path), df, path, partition_by, unique_keys, at, cluster
    )


def _replace(
    commit: Row | None,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str],
    unique_keys: Sequence[str] | None,
    at: datetime | str | None,
    cluster: bool = True,
) -> int:
    version, operation = (0, "CREATE") if commit is None else (commit["version"] + 1, "OVERWRITE")
    rows = clustered(df, partition_by) if cluster else df
    return _commit(rows, path, version, operation, partition_by, {}, unique_keys, at)


def merge_snapshot(
    source: DataFrame,
    path: str,
    keys: Sequence[merging.Key],
    delete_unmatched: bool = True,
    source_keys_unique: bool = False,
    at: datetime | str | None = None,
    copies_per_block: int = merging.COPIES_PER_BLOCK,
    condition: str | None = None,
) -> int:
    """Merge into the current version and commit the result as the next one.

    Each side is read once, and whether several source rows match one target
    row is observed while the result is written. If so, ``MergeConflict`` is
    raised, the rows just written are removed and no history row is, so there
    is no such version. ``condition`` stands beside the keys, as in
    ``merge.merge``. A sync merge without one, where the history knows the
    stored keys as unique and the source's are (which a job over its key
    columns tells, unless ``source_keys_unique`` states it), is a plain write
    of the source.
    """
    commit = _existing(source.sparkSession, path)
    return _merge_into(commit, source, path, keys, delete_unmatched, source_keys_unique, at, copies_per_block, condition)


def _merge_into(
    commit: Row,
    source: DataFrame,
    path: str,
    keys: Sequence[merging.Key],
    delete_unmatched: bool,
    source_keys_unique: bool,
    at: datetime | str | None,
    copies_per_block: int = merging.COPIES_PER_BLOCK,
    condition: str | None = None,
) -> int:
    renamed, names = merging.paired(source, keys)
    target = _read_commit(source.sparkSession, path, commit)
    stored_unique = sorted(commit["unique_keys"] or []) == sorted(names)
    version, partition_by = commit["version"] + 1, commit["partition_by"]
    parameters = {"keys": ",".join(names), "delete_unmatched": str(delete_unmatched).lower()}
    rows = None
    if condition is not None:
        parameters["condition"] = condition
        rows = merging.decided_where(target, source, keys, delete_unmatched, condition, copies_per_block)
    elif not (
        delete_unmatched and stored_unique and (source_keys_unique or merging.repeated_keys(renamed, names).isEmpty())
    ):
        rows = merging.decided(target, renamed, names, delete_unmatched, copies_per_block, stored_unique)
    if rows is None:
        # Nothing to decide, or, with a condition over hot keys, a conflict fails the write itself.
        merged = merging.as_target(target, renamed) if condition is None else merging.merge(
            target, source, keys, delete_unmatched, condition=condition, copies_per_block=copies_per_block
        )
        unique = names if condition is None else None
        return _commit(_laid_out(merged, partition_by), path, version, "MERGE", partition_by, parameters, unique, at)

    verdict = Observation()
    watched = rows.observe(
        verdict, F.count_if("_conflict").alias("conflicts"), F.count_if("_repeats").alias("repeats")
    ).select([quoted(c) for c in target.columns])
    location, n_rows = _write(_laid_out(watched, partition_by), path, version, partition_by)
    if verdict.get["conflicts"]:
        folders.delete(source.sparkSession, f"{path}/{location}")
        raise _conflict(rows, target, renamed, names, condition, path)
    unique = None if verdict.get["repeats"] else names
    return _record(target, path, version, "MERGE", partition_by, parameters, unique, at, location, n_rows)


def _laid_out(rows: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    # Also without partition columns: what a merge leaves in each task may be a few rows.
    return clustered(rows, partition_by) if partition_by else rows.hint("rebalance")


def _conflict(
    rows: DataFrame, target: DataFrame, source: DataFrame, keys: Sequence[str], condition: str | None, path: str
) -> merging.MergeConflict:
    """The error that names some of the keys; they are looked up again, which only a failed merge pays for."""
    if condition is None:
        conflicts = merging.merge_conflicts(target, source, keys)
    else:
        found = [F.col(f"_key_{i}").alias(k) for i, k in enumerate(keys)]
        conflicts = rows.filter("_conflict").groupBy(*found).agg(F.count(F.lit(1)).alias("rows"))
    shown = conflicts.limit(MESSAGE_ROWS).collect()
    listed = ", ".join(str(row.asDict()) for row in shown)
    return merging.MergeConflict(
        f"several source rows match a row of {path}, {conflicts.count()} keys in all: {listed}"
    )


def write_or_merge(
    df: DataFrame,
    path: str,
    keys: Sequence[merging.Key],
    partition_by: Sequence[str] = (),
    delete_unmatched: bool = True,
    source_keys_unique: bool = False,
    at: datetime | str | None = None,
    condition: str | None = None,
) -> int:
    """Create the table on the first run, merge into it on later ones, by ``condition`` as well where one is given."""
    commit = current_commit(df.sparkSession, path)
    if commit is not None:
        return _merge_into(commit, df, path, keys, delete_unmatched, source_keys_unique, at, condition=condition)
    df, keys = merging.paired(df, keys)
    return _replace(None, df, path, partition_by, keys if source_keys_unique else None, at)


# -- maintenance --------------------------------------------------------------


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """Parquet files under a folder, from listings alone: contents unread."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(folder)
        .selectExpr("path AS file_path", "length AS file_size")
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Live files of all versions: ``(version, file_path, file_size)``.

    Files of unfinished writes are left out, as no history row names them.
    """
    location = F.regexp_extract("file_path", r"/(data/[0-9]{8}-[0-9a-f]{12})/", 1)
    files = _listed(spark, f"{path}/data").withColumn("location", location)
    versions = commits(spark, path).select("version", "location")
    return files.join(versions, "location").select("version", "file_path", "file_size")


def file_count(spark: SparkSession, path: str) -> int:
    """Files of the current version, from its listing."""
    return folders.parquet_files(spark, f"{path}/{_existing(spark, path)['location']}")


def crowded_folders(
    spark: SparkSession, path: str, small_bytes: int = SMALL_FILE_BYTES, small_files: int = SMALL_FILES
) -> DataFrame:
    """Folders of the current version with ``small_files`` or more files below
    ``small_bytes``: ``(folder, files, small)``."""
    return _crowded(spark, path, _existing(spark, path), small_bytes, small_files)


def _crowded(spark: SparkSession, path: str, commit: Row, small_bytes: int, small_files: int) -> DataFrame:
    return (
        _listed(spark, f"{path}/{commit['location']}")
        .groupBy(F.regexp_replace("file_path", "/[^/]*$", "").alias("folder"))
        .agg(F.expr("count(1) AS files"), F.expr(f"count_if(file_size < {small_bytes}) AS small"))
        .filter(F.col("small") >= small_files)
    )


def compact(
    spark: SparkSession,
    path: str,
    small_bytes: int = SMALL_FILE_BYTES,
    small_files: int = SMALL_FILES,
    at: datetime | str | None = None,
) -> int | None:
    """Rewrite the current version with fewer files, rows unchanged.

    A version is one folder, so all of it is rewritten. Nothing happens, and
    ``None`` is returned, unless some folder holds ``small_files`` or more
    files below ``small_bytes``; ``small_files=0`` always rewrites. Writes of
    this package are rebalanced and leave no such folder, so no load asks for
    it by itself. The size of the new files follows
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    commit = _existing(spark, path)
    if small_files and _crowded(spark, path, commit, small_bytes, small_files).isEmpty():
        return None
    rows = _read_commit(spark, path, commit)
    partition_by = commit["partition_by"]
    rows = clustered(rows, partition_by) if partition_by else rows.hint("rebalance")
    version = commit["version"] + 1
    return _commit(
        rows, path, version, "OPTIMIZE", partition_by, {}, commit["unique_keys"], at
    )


def expired_versions(
    spark: SparkSession,
    path: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | str | None = None,
) -> DataFrame:
    """Versions that were replaced more than ``retention_hours`` ago.

    ``(version, commit_ts, superseded_ts, location)``. The current version is
    never among them.
    """
    rows = commits(spark, path)
    successor = rows.select(
        (F.col("version") - 1).alias("version"), F.col("commit_ts").alias("superseded_ts")
    )
    age = F.make_dt_interval(secs=F.lit(retention_hours * 3600))
    return (
        rows.join(successor, "version")
        .filter(F.col("superseded_ts") < moment(now) - age)
        .select("version", "commit_ts", "superseded_ts", "location")
    )


def remove_expired(
    spark: SparkSession,
    path: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | str | None = None,
    dry_run: bool = True,
) -> list[int]:
    """Delete the folders of expired versions; returns their numbers.

    With ``dry_run``, the default, nothing is deleted. The history keeps its
    rows, so a removed version is named as such when it is asked for. The list
    is as long as the number of commits.
    """
    expired = expired_versions(spark, path, retention_hours, now).collect()
    removed = []
    for row in expired:
        location = f"{path}/{row['location']}"
        if folders.exists(spark, location):
            removed.append(row["version"])
            if not dry_run:
                folders.delete(spark, location)
    return sorted(removed)


def remove_unfinished(
    spark: SparkSession,
    path: str,
    retention_hours: float = RETENTION_HOURS,
    now: datetime | None = None,
    dry_run: bool = True,
) -> list[str]:
    """Delete data folders no history row names, left by writes that failed.

    Only those unchanged for ``retention_hours``, so that a write under way is
    left alone. Returns the folder names; with ``dry_run``, the default,
    nothing is deleted.
    """
    _existing(spark, path)
    named = {row["location"] for row in commits(spark, path).select("location").collect()}
    before = (now or datetime.now(UTC)) - timedelta(hours=retention_hours)
    found = [
        f"data/{name}"
        for name, changed in folders.children(spark, f"{path}/data").items()
        if f"data/{name}" not in named and changed < before
    ]
    if not dry_run:
        for location in found:
            folders.delete(spark, f"{path}/{location}")
    return sorted(found)
