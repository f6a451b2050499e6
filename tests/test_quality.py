import pytest
from pyspark.sql import functions as F

from siltstone.operators import filters, profile, reports
from siltstone.operators.contract import ContractError, check_contract, column_difference
from tests.literal import quality_of, rules_of

GOLD = "code string, name string, region string, total bigint"


def rule(spark, rows):
    return reports.rule_report(spark.createDataFrame(rows, GOLD), "code", "total").first()


def test_clean_rows_are_success(spark):
    report = rule(spark, [("VE", "Vell", "East", 645), ("MO", "Morn", "West", 853)])
    assert report.asDict() == {
        "total": 2,
        "duplicate_keys": 0,
        "null_keys": 0,
        "negative_totals": 0,
        "zero_totals": 0,
        "invalid_records": 0,
        "quality": 100.0,
        "status": "SUCCESS",
    }


@pytest.mark.parametrize(
    ("rows", "column", "count"),
    [
        ([("VE", "", "", 1), ("VE", "", "", 2), ("VE", "", "", 3)], "duplicate_keys", 1),
        ([(None, "", "", 1), (None, "", "", 2)], "duplicate_keys", 1),
        ([(None, "", "", 1), ("MO", "", "", 2)], "null_keys", 1),
        ([("  ", "", "", 1), ("", "", "", 2)], "null_keys", 2),
        ([("\t", "", "", 1)], "null_keys", 0),
        ([("VE", "", "", -1)], "negative_totals", 1),
        ([("VE", "", "", 0)], "zero_totals", 1),
        ([("VE", "", "", None)], "invalid_records", 0),
        ([(None, "", "", None)], "invalid_records", 1),
        ([("VE", "", "", 0), (" ", "", "", 0)], "invalid_records", 2),
    ],
)
def test_rules(spark, rows, column, count):
    assert rule(spark, rows)[column] == count


def test_duplicates_alone_are_a_warning_at_full_quality(spark):
    report = rule(spark, [("VE", "", "", 1), ("VE", "", "", 1)])
    assert (report["quality"], report["status"]) == (100.0, "WARNING")


@pytest.mark.parametrize(
    ("bad", "total", "status"),
    [(1, 100, "WARNING"), (2, 100, "ERROR"), (5, 100, "ERROR"), (6, 100, "CRITICAL")],
)
def test_status_by_percentage(spark, bad, total, status):
    df = spark.range(total).select(
        F.col("id").cast("string").alias("code"), F.expr(f"IF(id < {bad}, 0, 1)").alias("total")
    )
    assert reports.rule_report(df, "code", "total").first()["status"] == status


def test_empty_input_is_success_at_zero(spark):
    report = rule(spark, [])
    assert (report["total"], report["quality"], report["status"]) == (0, 0.0, "SUCCESS")
    empty = spark.createDataFrame([], GOLD)
    report = reports.quality_report(empty, ["code"]).first()
    assert (report["records"], report["quality"], report["status"]) == (0, 0.0, "SUCCESS")
    assert reports.quality_report(empty, ["code"], by=["region"]).isEmpty()


def test_rounding_ties_go_up(spark):
    df = spark.range(800).select(
        F.col("id").cast("string").alias("code"), F.expr("IF(id < 799, 0, 1)").alias("total")
    )
    assert reports.rule_report(df, "code", "total").first()["quality"] == 0.13


MIXED = [
    ("a", 1, "x"),
    ("a", 1, "x"),
    ("b", None, "y"),
    ("b", None, "y"),
    ("c", None, None),
    (None, 2, "z"),
    (None, 2, "z"),
    ("d", 3, "w"),
]


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame(MIXED, "k string, n int, t string")


def test_quality_report_counts_distinct_invalid_rows(mixed):
    assert reports.quality_report(mixed, ["k"]).first().asDict() == {
        "records": 8,
        "valid_records": 5,
        "null_records": 3,
        "duplicates": 3,
        "quality": 62.5,
        "status": "CRITICAL",
        "columns_with_null": 3,
        "invalid_row_total": 5,
    }


def test_reports_equal_a_plain_count(spark, mixed):
    wide = mixed.withColumns({"u": F.lit("v"), "long": F.repeat(F.col("t"), 200)})
    for df in (mixed, wide, mixed.filter("n IS NOT NULL AND k IS NOT NULL"), mixed.limit(0)):
        rows = [tuple(r) for r in df.collect()]
        assert reports.quality_report(df, ["k"]).first().asDict() == quality_of(rows, df.columns, ["k"])
        pairs = [tuple(r) for r in df.select("k", "n").collect()]
        assert reports.rule_report(df, "k", "n").first().asDict() == rules_of(pairs)


def test_report_per_batch_equals_reports_of_the_batches(mixed):
    df = mixed.withColumn("batch", F.expr("IF(t = 'y', NULL, 'b' || coalesce(n, 0) % 2)"))
    rows = {r["batch"]: r for r in reports.quality_report(df, ["k"], by=["batch"]).collect()}
    assert set(rows) == {None, "b0", "b1"}
    for batch, row in rows.items():
        alone = reports.quality_report(df.filter(F.col("batch").eqNullSafe(batch)), ["k"])
        assert row.asDict() == {"batch": batch, **alone.first().asDict()}
    ruled = {r["batch"]: r for r in reports.rule_report(df, "k", "n", by=["batch"]).collect()}
    for batch, row in ruled.items():
        alone = reports.rule_report(df.filter(F.col("batch").eqNullSafe(batch)), "k", "n")
        assert row.asDict() == {"batch": batch, **alone.first().asDict()}


def test_report_over_more_columns_than_one_mask_holds(spark):
    wide = spark.range(4).select(
        "id", *[F.expr(f"IF(id = {i % 5}, NULL, {i})").alias(f"c{i}") for i in range(130)]
    )
    row = reports.quality_report(wide, ["id"]).first()
    assert row["columns_with_null"] == sum(i % 5 < 4 for i in range(130))
    assert row["null_records"] == 4


def test_long_texts_are_told_apart(spark):
    long = "x" * 100
    rows = [(long + "a", None), (long + "b", None), (long + "a", None), (None, None), ("", None)]
    df = spark.createDataFrame(rows, "text string, label int")
    assert profile.invalid_row_count(df).first() == (4, 5)
    # A short text equal to the digest of a long one is another row.
    digest = df.selectExpr("unhex(sha2(text, 256)) AS text", "label").filter("text IS NOT NULL")
    both = df.selectExpr("CAST(text AS BINARY) AS text", "label").union(digest)
    assert profile.invalid_row_count(both).first()["null_records"] == 7


def test_rows_with_maps_can_be_counted(spark):
    df = spark.sql(
        "SELECT map('a', 1, 'b', 2) AS m, CAST(NULL AS INT) AS n UNION ALL "
        "SELECT map('b', 2, 'a', 1), NULL UNION ALL SELECT map('a', 2), NULL"
    )
    assert profile.invalid_row_count(df).first() == (2, 3)


def test_null_profile_and_columns(mixed):
    assert profile.null_profile(mixed).first() == (2, 3, 1)
    found = {tuple(r) for r in profile.columns_with_null(mixed.drop("k")).collect()}
    assert found == {("n", 3), ("t", 1)}


def test_invalid_row_detail_names_columns_in_order(mixed):
    found = sorted(map(tuple, profile.invalid_row_detail(mixed, ["k"]).collect()), key=str)
    assert found == [("b", "n"), ("c", "n, t"), (None, "k")]


def test_invalid_filter_reaches_the_scan(spark, mixed, tmp_path):
    mixed.write.parquet(str(tmp_path / "m"))
    df = spark.read.parquet(str(tmp_path / "m"))
    plan = reports.quality_report(df, ["k"])._jdf.queryExecution().toString()
    assert "PushedFilters: [Or(Or(IsNull(k),IsNull(n)),IsNull(t))]" in plan
    assert "ReadSchema: struct<k:string>" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names_that_need_quoting(spark):
    df = spark.createDataFrame([(1, None), (1, 2)], "`a.b` int, `c-d` int")
    row = reports.quality_report(df, ["a.b"]).first()
    assert (row["null_records"], row["duplicates"]) == (1, 1)
    assert profile.null_profile(df).columns == ["a.b", "c-d"]
    assert profile.invalid_row_detail(df, ["a.b"]).first() == (1, "c-d")


def test_dropped_rows_add_up(mixed):
    assert filters.dropped_rows(mixed, ["n", "t"]).first() == (8, 5, 3)
    rejected = filters.rejected_rows(mixed, ["n", "t"])
    kept = filters.require_fields(mixed, ["n", "t"])
    assert kept.union(rejected).exceptAll(mixed).isEmpty()


def test_gates_are_off_by_default(mixed):
    report = reports.quality_report(mixed, ["k"])
    reports.check_gate(reports.gate(report))
    gated = reports.gate(report, fail_on_nulls=True, fail_on_duplicates=True)
    assert gated.first()["violations"] == "nulls, duplicates"
    with pytest.raises(reports.QualityGateError, match="duplicates"):
        reports.check_gate(gated)


def test_empty_frames_are_refused(spark):
    with pytest.raises(ValueError, match="no records found in here"):
        filters.check_not_empty(spark.range(0), "here")
    filters.check_not_empty(spark.range(1), "here")


def test_contract(spark):
    df = spark.createDataFrame([(1, "a")], "id int, `odd-name` string")
    assert check_contract(df, ["id", "odd-name"]) == []
    assert check_contract(df, ["id"]) == ["odd-name"]
    with pytest.raises(ContractError, match="missing columns: other"):
        check_contract(df, ["id", "other"])
    difference = column_difference(df, ["id", "other"])
    assert (difference.missing, difference.extra) == (["other"], ["odd-name"])
    check_contract(df, df.schema)
    with pytest.raises(ContractError, match="id is int, not bigint"):
        check_contract(df, spark.range(1).schema)
