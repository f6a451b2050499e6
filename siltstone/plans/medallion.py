"""The three layered loads and the chain of them.

raw        landing JSON + load columns        -> partitioned Parquet
refined    raw, flattened, required fields    -> snapshot table, merged by key
aggregate  refined, counted per group         -> snapshot table, merged by key

What the columns are called is in the specs; what is computed is here.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import named
from siltstone.operators.aggregate import count_by
from siltstone.operators.contract import check_contract
from siltstone.operators.enrich import enrich, flatten, with_run_stamp
from siltstone.operators.filters import check_not_empty, rejected_rows, require_fields
from siltstone.operators.profile import invalid_row_detail
from siltstone.operators.reports import check_gate, gate, quality_report, rule_report
from siltstone.sources import ledger, snapshots
from siltstone.sources.landing import MALFORMED, read_array, read_indented_array, read_json
from siltstone.sources.rows import as_frame, one_row
from siltstone.sources.tables import read_parquet, read_table, write_partitioned

log = logging.getLogger(__name__)

LINES, DOCUMENTS, INDENTED, ARRAY = "lines", "documents", "indented", "array"
_FILE = "_landing_file"


def _new_id() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class Run:
    """Identity of a run. ``at`` fixes its time; ``None`` is the clock. A retry
    keeps the id and counts ``attempt`` up. ``version`` is that of the caller's
    code, for the audit."""

    run_id: str = field(default_factory=_new_id)
    at: datetime | str | None = None
    attempt: int = 1
    version: str = ""


@dataclass(frozen=True)
class RawSpec:
    """``schema`` is a struct type or a DDL string. ``layout`` says how records stand in the
    landing files: ``lines``, ``documents`` (whole-document JSON, a task per
    file), ``indented`` (a pretty-printed array, split by record, with
    ``indent`` spaces) or ``array`` (one array per file in any layout, split by
    record, for a shuffle of the text). Text that is no record fails the load; in the first
    two layouts up to ``max_malformed`` such texts are left out and counted.
    ``mode`` is ``static`` (keep the last run only) or ``dynamic``."""

    schema: StructType | str
    source_system: str
    layout: str = LINES
    indent: int = 2
    max_malformed: int = 0
    mode: str = "static"


@dataclass(frozen=True)
class RefinedSpec:
    """How raw becomes refined.

    ``columns`` maps new names to dotted paths, ``required`` and ``key`` use
    the new names. ``contract`` lists the raw columns that must be there. The
    gates are off unless set; with ``batch_by`` they are also asked of every
    batch, and the reports per batch are stored. ``storage_level`` keeps the refined rows for the
    report and the write; without it both read raw Parquet, pruned to what
    they use. ``repartition`` spreads the rows of few large raw files over
    more tasks, once they are flat and filtered.
    ``retention_hours`` deletes versions replaced longer ago; ``None``, the
    default, deletes nothing. ``store_rejects`` writes the rows that lack a
    required field to ``<ledger>/rejects`` and the key and null columns of
    every invalid row to ``<ledger>/invalid``. ``raw_filter`` is a predicate
    on raw columns, its partition columns best, that says which rows this run
    is about; only for upserts, since a sync would delete all others.
    ``raw_schema`` are the raw columns to read, partition columns aside; without it the
    footers of all raw files are read for them in every run, whatever the
    filter is. The contract is then one with that schema.
    """

    columns: Mapping[str, str]
    required: Sequence[str]
    key: Sequence[str]
    contract: Sequence[str] = ()
    partition_by: Sequence[str] = ()
    delete_unmatched: bool = True
    fail_on_nulls: bool = False
    fail_on_duplicates: bool = False
    batch_by: Sequence[str] = ()
    storage_level: StorageLevel | None = None
    repartition: int | None = None
    retention_hours: float | None = None
    store_rejects: bool = False
    raw_filter: str | None = None
    raw_schema: StructType | str | None = None

    def __post_init__(self) -> None:
        if self.raw_filter and self.delete_unmatched:
            raise ValueError("raw_filter needs delete_unmatched=False")


@dataclass(frozen=True)
class AggregateSpec:
    """Groups, the column counted in them, and the merge key among them."""

    group_by: Sequence[str]
    counted: str
    key: str
    measure: str = "total"
    partition_by: Sequence[str] = ()
    stamp_column: str = "processed_at"
    delete_unmatched: bool = True
    retention_hours: float | None = None


@dataclass(frozen=True)
class LoadResult:
    """``report`` is the report's row, ``dropped`` the rows the required
    fields cost, ``version`` the committed table version, ``files`` the number
    of its files, ``extra_columns`` the raw columns that the contract does not
    name, and ``malformed`` the landing texts left out."""

    records: int
    report: Row | None = None
    dropped: int = 0
    version: int | None = None
    files: int | None = None
    extra_columns: tuple[str, ...] = ()
    malformed: int = 0


def _maintain(spark: SparkSession, path: str, retention_hours: float | None, run: Run) -> int:
    """Drop expired versions and count the current one's files."""
    if retention_hours is not None:
        snapshots.remove_expired(spark, path, retention_hours, run.at, dry_run=False)
        snapshots.remove_unfinished(spark, path, retention_hours, dry_run=False)
    return snapshots.file_count(spark, path)


def _audited(
    spark: SparkSession,
    name: str,
    run: Run,
    ledger_path: str | None,
    load: Callable[[], LoadResult],
) -> LoadResult:
    """Run a load and store what came of it; a failure is stored and raised."""
    start = time.monotonic()
    try:
        result = load()
    except Exception:
        if ledger_path:
            try:
                _append_audit(spark, name, run, ledger_path, start, ("FAILED", 0, 0.0))
            except Exception:
                # The load's own error is the one to raise.
                log.exception("the audit row of a failed load could not be stored")
        raise
    if ledger_path and result.report is not None:
        outcome = (result.report["status"], result.records, result.report["quality"])
        _append_audit(spark, name, run, ledger_path, start, outcome)
    return result


def _append_audit(
    spark: SparkSession,
    name: str,
    run: Run,
    ledger_path: str,
    start: float,
    outcome: tuple[str, int, float],
) -> None:
    status, records, quality = outcome
    frame = one_row(
        spark,
        {
            "records": (records, "bigint"),
            "quality": (quality, "double"),
            "status": (status, "string"),
        },
    )
    audit = ledger.audit_rows(frame, name, time.monotonic() - start, run.version, run.at)
    ledger.append_audit(audit, f"{ledger_path}/audit", name, run.run_id, attempt=run.attempt)


# -- raw ------------------------------------------------------------------------


class MalformedRecords(ValueError):
    """More landing texts are no records than the spec allows."""


def landed_rows(spark: SparkSession, landing: str, spec: RawSpec) -> DataFrame:
    """The landing records; with ``max_malformed``, other texts are among them."""
    if spec.layout == INDENTED:
        return read_indented_array(spark, landing, spec.schema, spec.indent)
    if spec.layout == ARRAY:
        return read_array(spark, landing, spec.schema, _FILE)
    if spec.layout not in (LINES, DOCUMENTS):
        raise ValueError(f"no landing layout {spec.layout!r}")
    return read_json(spark, landing, spec.schema, spec.layout == DOCUMENTS, spec.max_malformed > 0)


def _left_out(landed: DataFrame, landing: str, limit: int) -> int:
    """How many texts are no records; more than ``limit`` are an error, and so is nothing else."""
    # Spark does not read the text column alone, so another one is counted with it.
    first = named(landed.columns[0])
    counts = landed.agg(
        F.count(MALFORMED).alias("malformed"), F.count_if(F.col(MALFORMED).isNull() | first.isNotNull()).alias("records")
    ).first()
    if counts["malformed"] > limit:
        raise MalformedRecords(f"{counts['malformed']} malformed records in {landing}, {limit} are allowed")
    if not counts["records"]:
        raise ValueError(f"no records found in {landing}")
    return counts["malformed"]


def raw_rows(spark: SparkSession, landing: str, spec: RawSpec, run: Run) -> DataFrame:
    landed = landed_rows(spark, landing, spec)
    if MALFORMED in landed.columns:
        landed = landed.filter(f"{MALFORMED} IS NULL").drop(MALFORMED)
    return enrich(landed, spec.source_system, run.at, _FILE if spec.layout == ARRAY else None)


def load_raw(
    spark: SparkSession, landing: str, path: str, spec: RawSpec, run: Run | None = None
) -> LoadResult:
    """Landing JSON to Parquet by year and month.

    Each task writes the one partition of this run, so there is no shuffle;
    rows are counted while they are written. The files are parsed once, and
    once more to count malformed texts where the spec allows some.
    """
    malformed = 0
    rows = raw_rows(spark, landing, spec, run or Run())
    if spec.max_malformed and spec.layout != INDENTED:
        malformed = _left_out(landed_rows(spark, landing, spec), landing, spec.max_malformed)
    else:
        check_not_empty(rows, landing)
    return LoadResult(write_partitioned(rows, path, ("year", "month"), spec.mode), malformed=malformed)


# -- refined --------------------------------------------------------------------


def refined_rows(raw: DataFrame, spec: RefinedSpec) -> DataFrame:
    return require_fields(flatten(raw, spec.columns), spec.required)


def _check_batches(
    rows: DataFrame, spec: RefinedSpec, run: Run, ledger_path: str | None
) -> None:
    """Gate and store the reports per batch; only the report rows are kept."""
    report = quality_report(rows, spec.key, spec.batch_by)
    gated = gate(report, spec.fail_on_nulls, spec.fail_on_duplicates)
    gated = gated.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if ledger_path:
            ledger.append_quality(gated, f"{ledger_path}/batches", "refined", run.run_id)
        check_gate(gated)
    finally:
        gated.unpersist()


def _store_rejects(raw: DataFrame, rows: DataFrame, spec: RefinedSpec, run: Run, ledger_path: str) -> None:
    """Rows left out, and which columns are null in the invalid ones kept."""
    rejects = rejected_rows(flatten(raw, spec.columns), spec.required)
    ledger.append_run(rejects, f"{ledger_path}/rejects", "refined", run.run_id)
    detail = invalid_row_detail(rows, spec.key)
    ledger.append_run(detail, f"{ledger_path}/invalid", "refined", run.run_id)


def load_refined(
    spark: SparkSession,
    raw_path: str,
    path: str,
    spec: RefinedSpec,
    run: Run | None = None,
    ledger_path: str | None = None,
) -> LoadResult:
    """Raw to refined: contract, flatten, report, gate, merge, audit.

    The report runs before the write, so a gate keeps a bad load out, and its
    duplicate count answers whether the merge has to look for conflicts.
    """
    run = run or Run()

    def load() -> LoadResult:
        raw = read_parquet(spark, raw_path, spec.raw_schema, merge_schema=spec.raw_schema is None)
        extra = check_contract(raw, spec.contract) if spec.contract else []
        if spec.raw_filter:
            raw = raw.filter(spec.raw_filter)
        check_not_empty(raw, raw_path)
        rows = refined_rows(raw, spec)
        if spec.repartition:
            rows = rows.repartition(spec.repartition)
        if spec.storage_level is not None:
            rows = rows.persist(spec.storage_level)
        try:
            frame = quality_report(rows, spec.key)
            frame = gate(frame, spec.fail_on_nulls, spec.fail_on_duplicates)
            report = frame.first()
            stored = as_frame(spark, report, frame.schema)
            if ledger_path:
                ledger.append_quality(stored, f"{ledger_path}/quality", "refined", run.run_id)
            check_gate(stored)
            if spec.batch_by:
                _check_batches(rows, spec, run, ledger_path)
            if spec.store_rejects and ledger_path:
                _store_rejects(raw, rows, spec, run, ledger_path)
            version = snapshots.write_or_merge(
                rows,
                path,
                spec.key,
                spec.partition_by,
                spec.delete_unmatched,
                source_keys_unique=report["duplicates"] == 0,
                at=run.at,
            )
        finally:
            if spec.storage_level is not None:
                rows.unpersist()
        files = _maintain(spark, path, spec.retention_hours, run)
        # Rows in come from the Parquet footers: no column is read.
        dropped = raw.count() - report["records"]
        return LoadResult(report["records"], report, dropped, version, files, tuple(extra))

    return _audited(spark, "refined", run, ledger_path, load)


# -- aggregate ------------------------------------------------------------------


def aggregate_rows(refined: DataFrame, spec: AggregateSpec, run: Run) -> DataFrame:
    counted = count_by(refined, spec.group_by, spec.counted, spec.measure)
    return with_run_stamp(counted, run.run_id, run.at, spec.stamp_column)


def regional_views(aggregate: DataFrame, by: Sequence[str], measure: str, member: str, alias: str) -> DataFrame:
    """Per coarser group, a null one included: sum of the measure, and number of groups."""
    return aggregate.groupBy(*map(named, by)).agg(
        F.sum(named(measure)).alias(measure), F.count(named(member)).alias(alias)
    )


def load_aggregate(
    spark: SparkSession,
    refined_path: str,
    path: str,
    spec: AggregateSpec,
    run: Run | None = None,
    ledger_path: str | None = None,
) -> LoadResult:
    """Refined to aggregate: count, stamp, rule report, merge, audit.

    Only the grouped rows are kept for the report and the write; they are one
    row per group, and a lost block is counted again from the refined table.
    """
    run = run or Run()

    def load() -> LoadResult:
        rows = aggregate_rows(read_table(spark, refined_path), spec, run)
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            frame = rule_report(rows, spec.key, spec.measure)
            report = frame.first()
            if ledger_path:
                stored = as_frame(spark, report, frame.schema)
                ledger.append_rules(stored, f"{ledger_path}/rules", "aggregate", run.run_id)
            version = snapshots.write_or_merge(
                rows,
                path,
                (spec.key,),
                spec.partition_by,
                spec.delete_unmatched,
                source_keys_unique=report["duplicate_keys"] == 0,
                at=run.at,
            )
        finally:
            rows.unpersist()
        files = _maintain(spark, path, spec.retention_hours, run)
        return LoadResult(report["total"], report, 0, version, files)

    return _audited(spark, "aggregate", run, ledger_path, load)


# -- chain ----------------------------------------------------------------------


def load_chain(
    spark: SparkSession,
    landing: str,
    lake: str,
    raw: RawSpec,
    refined: RefinedSpec,
    aggregate: AggregateSpec,
    run: Run | None = None,
) -> DataFrame:
    """All three loads under one folder, each from what the last one wrote;
    returns the aggregate table as it then stands."""
    run = run or Run()
    raw_path, refined_path, path = f"{lake}/raw", f"{lake}/refined", f"{lake}/aggregate"
    ledgers = f"{lake}/ledger"
    load_raw(spark, landing, raw_path, raw, run)
    load_refined(spark, raw_path, refined_path, refined, run, ledgers)
    load_aggregate(spark, refined_path, path, aggregate, run, ledgers)
    return snapshots.read_snapshot(spark, path)
