"""Filters, profiles, reports, gate and their ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.catalog.inputs import (
    LABELLED_SQL,
    LOADED_AT,
    SLICE,
    SLICE_SQL,
    TOTALS_SQL,
    label_slice,
    labelled,
    percent_sql,
    status_sql,
    table,
    totals,
)
from siltstone.operators import contract, filters, profile, reports
from siltstone.sources import ledger, quarantine, states
from siltstone.sources.scratch import scratch_path


def required_field_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.require_fields(labelled(spark, sf_dir), ["quality"])


def dropped_row_accounting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.dropped_rows(labelled(spark, sf_dir), ["quality"])


def any_null_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rows_with_any_null(labelled(spark, sf_dir), ["quality", "toxic", "lang"])


def blank_key_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rows_with_blank_key(totals(spark, sf_dir), "code")


def invalid_rule_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.rows_breaking_rule(totals(spark, sf_dir), "code", "total")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_profile(labelled(spark, sf_dir))


def columns_with_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.columns_with_null(labelled(spark, sf_dir))


def invalid_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.invalid_row_count(label_slice(spark, sf_dir))


def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_rows(label_slice(spark, sf_dir))


def distinct_invalid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.distinct_invalid_rows(label_slice(spark, sf_dir))


def union_null_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.null_slices(label_slice(spark, sf_dir))


def invalid_row_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.invalid_row_detail(labelled(spark, sf_dir), ["doc_id"])


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.quality_report(labelled(spark, sf_dir), ["doc_id"])


def quality_report_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys and invalid rows that repeat: distinct and total counts differ."""
    return reports.quality_report(label_slice(spark, sf_dir), ["source"])


def quality_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.quality_report(labelled(spark, sf_dir), ["doc_id"], by=["source"])
    return report.select("source", "quality", "status")


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = reports.quality_report(label_slice(spark, sf_dir), ["quality"], by=["source"])
    gated = reports.gate(report, fail_on_nulls=True, fail_on_duplicates=True)
    return gated.select("source", "null_records", "duplicates", "violations")


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.rule_report(totals(spark, sf_dir), "code", "total")


def quality_report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs; the second is stored twice and still found once."""
    path = scratch_path(spark, "quality")
    whole = quality_report(spark, sf_dir)
    repeats = quality_report_repeats(spark, sf_dir)
    ledger.append_quality(whole, path, "refined", "0001", "json")
    for _ in range(2):
        schema = ledger.append_quality(repeats, path, "refined", "0002", "json")
    return ledger.read_runs(spark, path, schema, "json")


def rule_report_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "rules")
    report = rule_report(spark, sf_dir)
    ledger.append_rules(report, path, "aggregate", "0001")
    kept = filters.require_fields(totals(spark, sf_dir), ["code", "total"])
    schema = ledger.append_rules(
        reports.rule_report(kept, "code", "total"), path, "aggregate", "0002"
    )
    return ledger.read_runs(spark, path, schema)


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows per source, of two runs."""
    path = scratch_path(spark, "audit")
    whole = reports.quality_report(labelled(spark, sf_dir), ["doc_id"], by=["source"])
    kept = filters.require_fields(labelled(spark, sf_dir), ["quality"])
    graded = reports.quality_report(kept, ["doc_id"], by=["source"])
    for run_id, report in (("0001", whole), ("0002", graded)):
        audit = ledger.audit_rows(report, "labelled", 12.345, "1.0.0", LOADED_AT)
        schema = ledger.append_audit(audit, path, "refined", run_id)
    return ledger.read_runs(spark, path, schema)


def audit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = rule_report(spark, sf_dir)
    return ledger.audit_rows(report, "totals", 1.2345, "1.0.0", LOADED_AT, records="total")


def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers held against the columns of suppliers, under customer names."""
    customers, suppliers = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    declared = [name.replace("s_", "c_", 1) for name in suppliers.columns]
    return contract.contract_report(customers, declared)


def non_empty_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that pass the guard, and those no event is among, which do not."""
    events = table(spark, sf_dir, "events")
    counts = []
    for kind in ("known", "unknown"):
        rows = events.filter(F.col("event_id").isNotNull() if kind == "known" else F.col("event_id").isNull())
        try:
            filters.check_not_empty(rows, kind)
            passed = True
        except ValueError:
            passed = False
        counts.append(rows.agg(F.lit(kind).alias("kind"), F.lit(passed).alias("passed"), F.count(F.lit(1)).alias("n_rows")))
    return counts[0].unionByName(counts[1])


def quality_report_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three appends, the second stored twice; the report adds up what is stored of them and reads no row again."""
    path = scratch_path(spark, "states")
    rows = labelled(spark, sf_dir)
    for run in (0, 1, 1, 2):
        appended = rows.filter(F.col("doc_id") % 3 == run).select(*SLICE)
        states.add_quality_state(appended, path, f"{run:04}", ["source"])
    return states.stored_quality_report(spark, path)


def rule_report_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "states")
    for run in range(3):
        states.add_rule_state(totals(spark, sf_dir).filter(F.col("id") % 3 == run), path, f"{run:04}", "code", "total")
    return states.stored_rule_report(spark, path)


def gated_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events by type: errors lack their value, clicks come twice, and both types are set apart."""
    path = scratch_path(spark, "gated")
    events = table(spark, sf_dir, "events").select(
        "event_id", "event_type", F.when(F.col("event_type") != "error", F.col("value")).alias("value")
    )
    twice = events.unionByName(events.filter("event_type = 'click'"))
    routed = quarantine.write_gated(
        twice, path, "0001", ["event_id"], ["event_type"], fail_on_nulls=True, fail_on_duplicates=True
    )
    loaded = quarantine.read_loaded(spark, path).withColumn("violations", F.lit(""))
    both = loaded.unionByName(quarantine.read_quarantined(spark, path)).drop("run_id")
    return both.withColumns({"n_loaded": F.lit(routed.loaded).cast("long"), "n_apart": F.lit(routed.quarantined).cast("long")})


QUERIES = {
    "contract_columns": contract_columns,
    "non_empty_guard": non_empty_guard,
    "required_field_filter": required_field_filter,
    "dropped_row_accounting": dropped_row_accounting,
    "any_null_rows": any_null_rows,
    "blank_key_rows": blank_key_rows,
    "invalid_rule_rows": invalid_rule_rows,
    "duplicate_keys": duplicate_keys,
    "null_profile": null_profile,
    "columns_with_null": columns_with_null,
    "invalid_row_count": invalid_row_count,
    "distinct_rows": distinct_rows,
    "distinct_invalid_rows": distinct_invalid_rows,
    "union_null_slices": union_null_slices,
    "invalid_row_detail": invalid_row_detail,
    "quality_report": quality_report,
    "quality_report_repeats": quality_report_repeats,
    "quality_status": quality_status,
    "quality_gate": quality_gate,
    "rule_report": rule_report,
    "quality_report_sink": quality_report_sink,
    "rule_report_sink": rule_report_sink,
    "audit_append": audit_append,
    "audit_record": audit_record,
    "quality_report_appended": quality_report_appended,
    "rule_report_appended": rule_report_appended,
    "gated_load": gated_load,
}

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]


def _any_null_sql(columns: list[str]) -> str:
    return "(" + " OR ".join(f"{c} IS NULL" for c in columns) + ")"


def _quality_sql(rows: str, columns: list[str], key: str, by: str | None = None) -> str:
    """A quality report by one query per number, joined on the batch."""
    batch = f"{by} AS batch" if by else "0 AS batch"
    nulls = " + ".join(f"(count(*) > count({c}))::INTEGER" for c in columns)
    quality = percent_sql("records - null_records", "records")
    return f"""
        WITH rows_in AS (SELECT {batch}, * FROM ({rows})),
        sizes AS (
            SELECT batch, count(*) AS records, {nulls} AS columns_with_null,
                   count(*) FILTER ({_any_null_sql(columns)}) AS invalid_row_total
            FROM rows_in GROUP BY batch),
        doubled AS (
            SELECT batch, count(*) AS n FROM (
                SELECT batch, {key} FROM rows_in GROUP BY batch, {key} HAVING count(*) > 1)
            GROUP BY batch),
        broken AS (
            SELECT batch, count(*) AS n FROM (
                SELECT DISTINCT * FROM rows_in WHERE {_any_null_sql(columns)})
            GROUP BY batch),
        counts AS (
            SELECT batch, records, coalesce(broken.n, 0) AS null_records,
                   coalesce(doubled.n, 0) AS duplicates, columns_with_null, invalid_row_total
            FROM sizes LEFT JOIN broken USING (batch) LEFT JOIN doubled USING (batch)),
        graded AS (SELECT *, {quality} AS quality FROM counts)
        SELECT {f"batch AS {by}," if by else ""} records,
               records - null_records AS valid_records, null_records, duplicates, quality,
               {status_sql("duplicates", "null_records", "quality")} AS status,
               columns_with_null, invalid_row_total
        FROM graded"""


def _rule_sql(rows: str) -> str:
    blank = "(code IS NULL OR trim(code) = '')"
    quality = percent_sql("total - invalid_records", "total")
    return f"""
        WITH rows_in AS ({rows}),
        counts AS (
            SELECT (SELECT count(*) FROM rows_in) AS total,
                   (SELECT count(*) FROM (SELECT code FROM rows_in GROUP BY code
                                          HAVING count(*) > 1)) AS duplicate_keys,
                   (SELECT count(*) FROM rows_in WHERE {blank}) AS null_keys,
                   (SELECT count(*) FROM rows_in WHERE total < 0) AS negative_totals,
                   (SELECT count(*) FROM rows_in WHERE total = 0) AS zero_totals,
                   (SELECT count(*) FROM rows_in WHERE {blank} OR total <= 0) AS invalid_records),
        graded AS (SELECT *, {quality} AS quality FROM counts)
        SELECT *, {status_sql("duplicate_keys", "invalid_records", "quality")} AS status
        FROM graded"""


_REPORT = _quality_sql(LABELLED_SQL, DOCUMENT_COLUMNS, "doc_id")
_REPEATS = _quality_sql(SLICE_SQL, SLICE, "source")
_BY_SOURCE = _quality_sql(LABELLED_SQL, DOCUMENT_COLUMNS, "doc_id", by="source")
_LABELLED_ONLY = f"SELECT * FROM ({LABELLED_SQL}) WHERE quality IS NOT NULL"
_BY_SOURCE_LABELLED = _quality_sql(_LABELLED_ONLY, DOCUMENT_COLUMNS, "doc_id", by="source")
_GATED = _quality_sql(SLICE_SQL, SLICE, "quality", by="source")
_STORED = "records, valid_records, duplicates, null_records, quality, status"
_AUDIT = (
    "source, 'labelled' AS pipeline, status, records, quality, 12.35::DOUBLE AS duration, "
    "'refined' AS stage, 1::INTEGER AS attempt"
)

ORACLES = {
    "contract_columns": """
        SELECT unnest(['c_suppkey', 'c_custkey', 'c_mktsegment']) AS column_name,
               unnest(['missing', 'extra', 'extra']) AS side, count(*) AS n_rows
        FROM customer""",
    "non_empty_guard": """
        SELECT 'known' AS kind, TRUE AS passed, count(event_id) AS n_rows FROM events
        UNION ALL SELECT 'unknown', FALSE, count(*) - count(event_id) FROM events""",
    "required_field_filter": f"SELECT * FROM ({LABELLED_SQL}) WHERE quality IS NOT NULL",
    "dropped_row_accounting": f"""
        SELECT count(*) AS rows_in, count(quality) AS rows_kept,
               count(*) - count(quality) AS rows_dropped FROM ({LABELLED_SQL})""",
    "any_null_rows": f"""
        SELECT * FROM ({LABELLED_SQL})
        WHERE quality IS NULL OR toxic IS NULL OR lang IS NULL""",
    "blank_key_rows": f"SELECT * FROM ({TOTALS_SQL}) WHERE code IS NULL OR trim(code) = ''",
    "invalid_rule_rows": f"""
        SELECT * FROM ({TOTALS_SQL}) WHERE code IS NULL OR trim(code) = '' OR total <= 0""",
    "duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
        GROUP BY ALL HAVING count(*) > 1""",
    "null_profile": (
        "SELECT "
        + ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in DOCUMENT_COLUMNS)
        + f" FROM ({LABELLED_SQL})"
    ),
    "columns_with_null": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM ({LABELLED_SQL}) "
        f"WHERE {c} IS NULL HAVING count(*) > 0"
        for c in DOCUMENT_COLUMNS
    ),
    "invalid_row_count": f"""
        SELECT (SELECT count(*) FROM (SELECT DISTINCT * FROM ({SLICE_SQL})
                WHERE {_any_null_sql(SLICE)})) AS null_records,
               (SELECT count(*) FROM ({SLICE_SQL})
                WHERE {_any_null_sql(SLICE)}) AS invalid_row_total""",
    "distinct_rows": f"SELECT DISTINCT * FROM ({SLICE_SQL})",
    "distinct_invalid_rows": f"SELECT DISTINCT * FROM ({SLICE_SQL}) WHERE {_any_null_sql(SLICE)}",
    "union_null_slices": " UNION ALL ".join(
        f"SELECT *, '{c}' AS null_column FROM ({SLICE_SQL}) WHERE {c} IS NULL" for c in SLICE
    ),
    "invalid_row_detail": (
        "SELECT doc_id, concat_ws(', ', "
        + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in DOCUMENT_COLUMNS)
        + f") AS null_columns FROM (SELECT DISTINCT * FROM ({LABELLED_SQL}) "
        f"WHERE {_any_null_sql(DOCUMENT_COLUMNS)})"
    ),
    "quality_report": _REPORT,
    "quality_report_repeats": _REPEATS,
    "quality_status": f"SELECT source, quality, status FROM ({_BY_SOURCE})",
    "quality_gate": f"""
        SELECT source, null_records, duplicates,
               concat_ws(', ', CASE WHEN null_records > 0 THEN 'nulls' END,
                               CASE WHEN duplicates > 0 THEN 'duplicates' END) AS violations
        FROM ({_GATED})""",
    "rule_report": _rule_sql(TOTALS_SQL),
    "quality_report_sink": f"""
        SELECT {_STORED}, 'refined' AS stage, '0001' AS run_id FROM ({_REPORT})
        UNION ALL
        SELECT {_STORED}, 'refined' AS stage, '0002' AS run_id FROM ({_REPEATS})""",
    "rule_report_sink": f"""
        SELECT *, 'aggregate' AS stage, '0001' AS run_id FROM ({_rule_sql(TOTALS_SQL)})
        UNION ALL
        SELECT *, 'aggregate' AS stage, '0002' AS run_id FROM ({_rule_sql(
            f"SELECT * FROM ({TOTALS_SQL}) WHERE code IS NOT NULL AND total IS NOT NULL")})""",
    "audit_append": f"""
        SELECT {_AUDIT}, '0001' AS run_id FROM ({_BY_SOURCE})
        UNION ALL
        SELECT {_AUDIT}, '0002' AS run_id FROM ({_BY_SOURCE_LABELLED})""",
    "audit_record": f"""
        SELECT 'totals' AS pipeline, status, total AS records, quality,
               1.23::DOUBLE AS execution_time, '1.0.0' AS version,
               '{LOADED_AT}' AS "timestamp"
        FROM ({_rule_sql(TOTALS_SQL)})""",
    "quality_report_appended": _REPEATS,
    "rule_report_appended": _rule_sql(TOTALS_SQL),
    "gated_load": """
        WITH twice AS (
            SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events
            UNION ALL SELECT event_id, event_type, value FROM events WHERE event_type = 'click'),
        judged AS (
            SELECT *, CASE event_type WHEN 'error' THEN 'nulls' WHEN 'click' THEN 'duplicates' ELSE '' END AS violations
            FROM twice)
        SELECT *, count(*) FILTER (violations = '') OVER () AS n_loaded,
               count(*) FILTER (violations <> '') OVER () AS n_apart FROM judged""",
}
