from collections import Counter
from dataclasses import replace

import pytest
from pyspark import StorageLevel
from pyspark.sql.types import IntegerType, StructField, StructType

from siltstone.catalog.inputs import ACCOUNT_LEAVES
from siltstone.catalog.loads import AGGREGATE, RAW, REFINED
from siltstone.operators.contract import ContractError
from siltstone.operators.reports import QualityGateError
from siltstone.plans import Run, load_aggregate, load_chain, load_raw, load_refined
from siltstone.plans.medallion import MalformedRecords, regional_views
from siltstone.sources import ledger, snapshots

HOME = '"nation": {"n_nationkey": %d, "n_name": "%s", "region": {"r_regionkey": 1, "r_name": "East"}}'
LINES = [
    '{"c_custkey": 1, "c_name": "a", "account": {"c_acctbal": 1.5, "c_mktsegment": "X"}, %s}' % (HOME % (1, "VELL")),
    '{"c_custkey": 2, "c_name": "b", "account": {"c_acctbal": 2.5, "c_mktsegment": "X"}, %s}' % (HOME % (1, "VELL")),
    '{"c_custkey": 3, "c_name": "c", "account": {"c_acctbal": null, "c_mktsegment": "X"}, %s}' % (HOME % (2, "MORN")),
    '{"c_custkey": 4, "c_name": "d", "account": {"c_acctbal": 0.5, "c_mktsegment": "Y"}, "nation": null}',
]
RUN = Run("0000beef", "2025-01-15 10:30:00")
AUDIT = (
    "pipeline string, status string, records bigint, quality double, duration double, "
    "attempt int, stage string, run_id string"
)


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "accounts.json").write_text("\n".join(LINES))
    return str(folder)


@pytest.fixture
def raw(spark, landing, tmp_path):
    path = str(tmp_path / "raw")
    assert load_raw(spark, landing, path, RAW, RUN).records == 4
    return path


def audits(spark, path):
    schema = StructType.fromDDL(AUDIT)
    found = ledger.read_runs(spark, f"{path}/audit", schema)
    return Counter(tuple(r) for r in found.select("pipeline", "status", "records").collect())


def test_raw_load_keeps_everything_and_stamps_it(spark, raw):
    rows = spark.read.parquet(raw).collect()
    assert {(r.year, r.month, r.source_system) for r in rows} == {(2025, 1, "accounts")}
    assert all(r.file_name.endswith("accounts.json") for r in rows)
    assert len(rows) == 4


def test_raw_load_refuses_an_empty_landing(spark, tmp_path):
    (tmp_path / "none.json").write_text("")
    with pytest.raises(ValueError, match="no records"):
        load_raw(spark, str(tmp_path / "none.json"), str(tmp_path / "raw"), RAW)


@pytest.mark.parametrize("level", [None, StorageLevel.MEMORY_AND_DISK])
def test_refined_load(spark, raw, tmp_path, level):
    path, ledgers = str(tmp_path / "refined"), str(tmp_path / "ledger")
    spec = replace(REFINED, storage_level=level, repartition=4)
    result = load_refined(spark, raw, path, spec, RUN, ledgers)
    assert (result.records, result.dropped, result.version, result.files) == (3, 1, 0, 1)
    assert result.report["null_records"] == 1 and result.report["quality"] == 66.67
    table = snapshots.read_snapshot(spark, path)
    assert table.columns == [*ACCOUNT_LEAVES, "ingestion_timestamp", "source_system"]
    assert sorted(r.c_custkey for r in table.collect()) == [1, 2, 3]
    assert audits(spark, ledgers) == Counter({("refined", "CRITICAL", 3): 1})
    # The second run merges into the table of the first.
    again = load_refined(spark, raw, path, spec, RUN, ledgers)
    assert again.version == 1
    assert snapshots.read_snapshot(spark, path).exceptAll(table).isEmpty()
    assert audits(spark, ledgers) == Counter({("refined", "CRITICAL", 3): 1})
    if level is not None:
        assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_refined_load_checks_its_contract(spark, raw, tmp_path):
    spec = replace(REFINED, contract=[*REFINED.contract, "c_phone"])
    with pytest.raises(ContractError, match="c_phone"):
        load_refined(spark, raw, str(tmp_path / "refined"), spec, RUN, str(tmp_path / "ledger"))
    assert not snapshots.is_snapshot_table(spark, str(tmp_path / "refined"))
    assert audits(spark, str(tmp_path / "ledger")) == Counter({("refined", "FAILED", 0): 1})


def test_a_gate_keeps_the_load_out(spark, raw, tmp_path):
    path = str(tmp_path / "refined")
    spec = replace(REFINED, fail_on_nulls=True)
    with pytest.raises(QualityGateError, match="nulls"):
        load_refined(spark, raw, path, spec, RUN)
    assert not snapshots.is_snapshot_table(spark, path)


def test_batches_are_reported_and_gated(spark, raw, tmp_path):
    path, ledgers = str(tmp_path / "refined"), str(tmp_path / "ledger")
    spec = replace(REFINED, batch_by=["n_name"])
    load_refined(spark, raw, path, spec, RUN, ledgers)
    schema = "n_name string, records bigint, null_records bigint, status string"
    schema = StructType.fromDDL(schema)
    found = ledger.read_runs(spark, f"{ledgers}/batches", schema).collect()
    assert {(r.n_name, r.records, r.null_records, r.status) for r in found} == {
        ("VELL", 2, 0, "SUCCESS"),
        ("MORN", 1, 1, "CRITICAL"),
    }
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_aggregate_load_and_views(spark, raw, tmp_path):
    refined, path = str(tmp_path / "refined"), str(tmp_path / "aggregate")
    load_refined(spark, raw, refined, REFINED, RUN)
    result = load_aggregate(spark, refined, path, AGGREGATE, RUN, str(tmp_path / "ledger"))
    assert (result.records, result.report["status"]) == (2, "SUCCESS")
    table = snapshots.read_snapshot(spark, path)
    assert set(table.columns) == {
        "n_name",
        "r_name",
        "n_customers",
        "processed_at",
        "run_id",
    }
    assert {(r.n_name, r.n_customers) for r in table.collect()} == {("VELL", 2), ("MORN", 1)}
    assert {(r.run_id, r.processed_at) for r in table.collect()} == {
        ("0000beef", "2025-01-15 10:30:00")
    }
    assert regional_views(table, ["r_name"], "n_customers", "n_name", "n").first() == ("East", 3, 2)
    assert audits(spark, str(tmp_path / "ledger")) == Counter({("aggregate", "SUCCESS", 2): 1})


def test_aggregate_reads_plain_parquet_too(spark, tmp_path):
    source = spark.createDataFrame(
        [(1, "VELL", "East")],
        "c_custkey bigint, n_name string, r_name string",
    )
    source.write.parquet(str(tmp_path / "plain"))
    result = load_aggregate(spark, str(tmp_path / "plain"), str(tmp_path / "a"), AGGREGATE, RUN)
    assert result.records == 1


def test_two_names_for_a_code_conflict_on_the_second_run(spark, tmp_path):
    source = spark.createDataFrame(
        [(1, "VELL", "East"), (2, "VELL", "West")],
        "c_custkey bigint, n_name string, r_name string",
    )
    refined, path = str(tmp_path / "refined"), str(tmp_path / "a")
    source.write.parquet(refined)
    first = load_aggregate(spark, refined, path, AGGREGATE, RUN)
    assert (first.report["duplicate_keys"], first.report["status"]) == (1, "WARNING")
    with pytest.raises(ValueError, match="several source rows"):
        load_aggregate(spark, refined, path, AGGREGATE, RUN)
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_retention_is_part_of_a_load_when_asked(spark, raw, tmp_path):
    path = str(tmp_path / "refined")
    load_refined(spark, raw, path, REFINED, Run("1", "2025-01-01"))
    spec = replace(REFINED, retention_hours=168)
    load_refined(spark, raw, path, spec, Run("2", "2025-01-02"))
    assert snapshots.read_snapshot(spark, path, version=0).count() == 3
    load_refined(spark, raw, path, spec, Run("3", "2025-01-20"))
    with pytest.raises(ValueError, match="was removed"):
        snapshots.read_snapshot(spark, path, version=0)


@pytest.mark.parametrize("layout", ["documents", "indented", "array"])
def test_chain_with_an_array_landing(spark, tmp_path, layout):
    (tmp_path / "a.json").write_text("[\n  " + ",\n  ".join(LINES) + "\n]\n")
    raw = replace(RAW, layout=layout)
    result = load_chain(
        spark, str(tmp_path / "a.json"), str(tmp_path / "lake"), raw, REFINED, AGGREGATE, RUN
    )
    assert {(r.n_name, r.n_customers) for r in result.collect()} == {("VELL", 2), ("MORN", 1)}
    assert audits(spark, f"{tmp_path}/lake/ledger") == Counter(
        {("refined", "CRITICAL", 3): 1, ("aggregate", "SUCCESS", 2): 1}
    )


def test_malformed_landing_fails_or_is_counted(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join([*LINES, LINES[0][:40], "nothing"]))
    path = str(tmp_path / "raw")
    with pytest.raises(Exception, match="MALFORMED"):
        load_raw(spark, str(tmp_path / "a.json"), path, RAW)
    with pytest.raises(MalformedRecords, match="2 malformed records"):
        load_raw(spark, str(tmp_path / "a.json"), path, replace(RAW, max_malformed=1))
    result = load_raw(spark, str(tmp_path / "a.json"), path, replace(RAW, max_malformed=2))
    assert (result.records, result.malformed) == (4, 2)
    (tmp_path / "b.json").write_text("nothing")
    with pytest.raises(ValueError, match="no records"):
        load_raw(spark, str(tmp_path / "b.json"), path, replace(RAW, max_malformed=2))
    with pytest.raises(ValueError, match="no landing layout"):
        load_raw(spark, str(tmp_path / "a.json"), path, replace(RAW, layout="csv"))


def test_rejects_and_invalid_rows_are_stored_on_request(spark, raw, tmp_path):
    ledgers = str(tmp_path / "ledger")
    spec = replace(REFINED, store_rejects=True)
    result = load_refined(spark, raw, str(tmp_path / "refined"), spec, RUN, ledgers)
    assert set(result.extra_columns) == {"file_name", "year", "month"}
    rejects = ledger.read_runs(spark, f"{ledgers}/rejects", StructType.fromDDL("c_custkey bigint"))
    assert [r.c_custkey for r in rejects.collect()] == [4]
    invalid = ledger.read_runs(spark, f"{ledgers}/invalid", StructType.fromDDL("c_custkey bigint, null_columns string"))
    assert [(r.c_custkey, r.null_columns) for r in invalid.collect()] == [(3, "c_acctbal")]


def test_a_retry_leaves_the_failed_attempt_on_record(spark, raw, tmp_path):
    path, ledgers = str(tmp_path / "refined"), str(tmp_path / "ledger")
    with pytest.raises(ContractError):
        load_refined(spark, raw, path, replace(REFINED, contract=["c_phone"]), RUN, ledgers)
    load_refined(spark, raw, path, REFINED, replace(RUN, attempt=2), ledgers)
    assert audits(spark, ledgers) == Counter({("refined", "FAILED", 0): 1, ("refined", "CRITICAL", 3): 1})


def test_a_failing_audit_does_not_hide_the_error(spark, raw, tmp_path):
    blocked = tmp_path / "ledger"
    blocked.write_text("a file where the folder should be")
    with pytest.raises(ContractError, match="c_phone"):
        load_refined(spark, raw, str(tmp_path / "refined"), replace(REFINED, contract=["c_phone"]), RUN, str(blocked))


def test_columns_that_came_later_are_read(spark, tmp_path):
    raw = str(tmp_path / "raw")
    for month, extra in ((1, {}), (2, {"more": 1})):
        line = LINES[0][:-1] + "".join(f', "{k}": {v}' for k, v in extra.items()) + "}"
        (tmp_path / f"{month}.json").write_text(line)
        schema = StructType([*RAW.schema.fields, *(StructField(k, IntegerType()) for k in extra)])
        spec = replace(RAW, mode="dynamic", schema=schema)
        load_raw(spark, str(tmp_path / f"{month}.json"), raw, spec, Run("1", f"2025-0{month}-01"))
    spec = replace(REFINED, columns={**REFINED.columns, "more": "more"})
    path = str(tmp_path / "refined")
    load_refined(spark, raw, path, spec, RUN)
    assert snapshots.read_snapshot(spark, path).columns[-1] == "more"


def test_part_of_raw_is_for_upserts_alone(spark, raw, tmp_path):
    with pytest.raises(ValueError, match="delete_unmatched"):
        replace(REFINED, raw_filter="month = 1")
    path = str(tmp_path / "refined")
    spec = replace(REFINED, raw_filter="c_custkey = 1", delete_unmatched=False)
    assert load_refined(spark, raw, path, spec, RUN).records == 1


def test_a_raw_schema_leaves_other_partitions_unopened(spark, raw, tmp_path):
    schema = spark.read.parquet(f"{raw}/year=2025/month=1").schema
    older = tmp_path / "raw" / "year=2001" / "month=1"
    older.mkdir(parents=True)
    (older / "part-0.parquet").write_bytes(b"damaged")
    spec = replace(REFINED, raw_filter="year = 2025", delete_unmatched=False)
    with pytest.raises(Exception, match="footer|FAILED_READ_FILE|CANNOT_READ"):
        load_refined(spark, raw, str(tmp_path / "failed"), spec, RUN)
    result = load_refined(spark, raw, str(tmp_path / "refined"), replace(spec, raw_schema=schema), RUN)
    assert result.records == 3
