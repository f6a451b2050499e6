from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from siltstone.catalog import versions
from siltstone.operators.merge import MergeConflict
from siltstone.sources import ledger, scratch, snapshots, tables

SCHEMA = "k int, part string, v string"
DAYS = [f"2025-01-0{d} 00:00:00" for d in range(1, 8)]


def rows(df):
    return Counter(map(tuple, df.collect()))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_two_runs_and_back(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, (1, "a", "x"), (2, "a", "x"), (3, "b", "x"))
    second = frame(spark, (2, "b", "y"), (3, "b", "y"), (4, "c", "y"))
    for df, at in ((first, DAYS[0]), (second, DAYS[1])):
        snapshots.write_or_merge(df, path, ["k"], ["part"], at=at)
    assert rows(snapshots.read_snapshot(spark, path)) == rows(second)
    assert rows(snapshots.read_snapshot(spark, path, version=0)) == rows(first)
    # A version wins over a moment.
    both = snapshots.read_snapshot(spark, path, version=0, timestamp=DAYS[3])
    assert rows(both) == rows(first)
    at_noon = snapshots.read_snapshot(spark, path, timestamp=datetime(2025, 1, 1, 12))
    assert rows(at_noon) == rows(first)
    assert rows(snapshots.read_snapshot(spark, path, timestamp=DAYS[1])) == rows(second)
    with pytest.raises(ValueError, match="no version at or before"):
        snapshots.read_snapshot(spark, path, timestamp="2024-12-31")
    with pytest.raises(ValueError, match="has no version 9"):
        snapshots.read_snapshot(spark, path, version=9)
    view = snapshots.history_view(spark, path)
    assert view.columns == ["version", "commit_ts", "operation"]
    assert [(r.version, r.operation) for r in view.collect()] == [(1, "MERGE"), (0, "CREATE")]
    assert [r.n_rows for r in snapshots.history(spark, path, 1).collect()] == [3]


def test_upsert_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(frame(spark, (1, "a", "x"), (2, "a", "x")), path, ["part"])
    source = frame(spark, (2, "b", "y"))
    snapshots.merge_snapshot(source, path, ["k"], delete_unmatched=False)
    expected = Counter({(1, "a", "x"): 1, (2, "b", "y"): 1})
    assert rows(snapshots.read_snapshot(spark, path)) == expected


def test_conflict_stops_before_the_write(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(frame(spark, (1, "a", "x")), path)
    twice = frame(spark, (1, "a", "y"), (1, "a", "z"))
    with pytest.raises(MergeConflict, match="1 keys in all: .'k': 1, 'copies': 2"):
        snapshots.write_or_merge(twice, path, ["k"])
    assert snapshots.commits(spark, path).count() == 1
    # Two source rows without a target row are both inserted ...
    snapshots.write_or_merge(frame(spark, (2, "a", "y"), (2, "a", "z")), path, ["k"])
    # ... repeat in the target, and then both take the source's values.
    snapshots.write_or_merge(frame(spark, (2, "b", "w")), path, ["k"])
    assert rows(snapshots.read_snapshot(spark, path)) == Counter({(2, "b", "w"): 2})


def test_known_unique_keys_are_recorded(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "a", "x"), (2, "a", "x"))
    snapshots.write_or_merge(df, path, ["k"], source_keys_unique=True)
    assert snapshots.current_commit(spark, path)["unique_keys"] == ["k"]
    snapshots.write_or_merge(df, path, ["k"])
    assert snapshots.current_commit(spark, path)["unique_keys"] == ["k"]
    snapshots.write_or_merge(frame(spark, (5, "a", "x"), (5, "a", "x")), path, ["k"])
    assert snapshots.current_commit(spark, path)["unique_keys"] is None


def test_reading_while_writing_is_safe(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(frame(spark, (1, "a", "x")), path)
    current = snapshots.read_snapshot(spark, path)
    snapshots.write_snapshot(current.withColumn("v", F.lit("new")), path)
    assert rows(snapshots.read_snapshot(spark, path)) == Counter({(1, "a", "new"): 1})


def test_columns_keep_order_and_types(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "01", "x"), (2, "02", None), (3, None, "x"))
    snapshots.write_snapshot(df, path, ["part"])
    back = snapshots.read_snapshot(spark, path)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert rows(back) == rows(df)


def test_empty_tables_are_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_or_merge(frame(spark), path, ["k"], ["part"])
    assert snapshots.is_snapshot_table(spark, path)
    assert snapshots.current_commit(spark, path)["n_rows"] == 0
    assert snapshots.read_snapshot(spark, path).isEmpty()
    snapshots.write_or_merge(frame(spark, (1, "a", "x")), path, ["k"])
    assert snapshots.read_snapshot(spark, path).count() == 1


def test_unfinished_writes_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "a", "x"))
    snapshots.write_snapshot(df, path)
    df.write.parquet(f"{path}/data/00000001-0123456789ab")
    assert snapshots.read_snapshot(spark, path).count() == 1
    assert {r.version for r in snapshots.file_inventory(spark, path).collect()} == {0}
    assert snapshots.write_snapshot(df, path) == 1
    orphan = ["data/00000001-0123456789ab"]
    assert snapshots.remove_unfinished(spark, path) == []
    later = datetime.now(UTC) + timedelta(hours=169)
    assert snapshots.remove_unfinished(spark, path, now=later) == orphan
    assert snapshots.remove_unfinished(spark, path, now=later, dry_run=False) == orphan
    assert snapshots.remove_unfinished(spark, path, now=later) == []
    assert snapshots.read_snapshot(spark, path, version=0).count() == 1


def test_a_version_is_committed_once(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "a", "x"))
    snapshots.write_snapshot(df, path)
    with pytest.raises(Exception, match="already exists"):
        snapshots._replace(None, df, path, (), None, None)
    assert snapshots.commits(spark, path).count() == 1


def test_compaction_only_where_it_helps(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(1000).selectExpr("id", "id % 3 AS part").repartition(12, "id")
    snapshots.write_snapshot(df, path, ["part"], ["id"], cluster=False)
    assert snapshots.file_count(spark, path) == 36
    assert snapshots.crowded_folders(spark, path).count() == 3
    assert snapshots.compact(spark, path, small_files=13) is None
    assert snapshots.compact(spark, path, small_bytes=10) is None
    assert snapshots.compact(spark, path) == 1
    assert snapshots.file_count(spark, path) == 3
    assert snapshots.compact(spark, path) is None
    assert snapshots.compact(spark, path, small_files=0) == 2
    assert rows(snapshots.read_snapshot(spark, path)) == rows(df)
    assert snapshots.current_commit(spark, path)["unique_keys"] == ["id"]
    counts = snapshots.file_inventory(spark, path).groupBy("version").count().collect()
    assert {r.version: r["count"] for r in counts} == {0: 36, 1: 3, 2: 3}


@pytest.mark.parametrize(("small_bytes", "advisory"), [(10, "64m"), (snapshots.SMALL_FILE_BYTES, "16k")])
def test_compaction_queries_hold_for_any_size(spark, monkeypatch, small_bytes, advisory):
    """Large tables stood for by a limit below their files, and by files cut to a size below a status."""
    monkeypatch.setattr(snapshots.compact, "__defaults__", (small_bytes, snapshots.SMALL_FILES, None))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(name, advisory)
    try:
        counted = versions.file_inventory(spark, "/root/testdata/sf0.01").collect()
        n = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").count()
        assert sorted(map(tuple, counted)) == [(0, n, True, 3), (1, n, True, 3)]
        path = versions._scattered_orders(spark, "/root/testdata/sf0.01")
        assert snapshots.current_commit(spark, path)["operation"] == "OPTIMIZE"
    finally:
        spark.conf.unset(name)


def test_a_clustered_write_is_not_compacted(spark, tmp_path):
    """Not even when a hot partition value came out as several files."""
    path = str(tmp_path / "t")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "1MB")
    try:
        df = spark.range(0, 120_000, 1, 8).selectExpr("1 AS part", "sha2(id || '', 512) AS v")
        snapshots.write_snapshot(df, path, ["part"])
        assert snapshots.file_count(spark, path) > 4
        assert snapshots.crowded_folders(spark, path, small_bytes=128 * 1024).isEmpty()
    finally:
        spark.conf.set(key, before)


def test_a_small_upsert_writes_once_and_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(0, 300_000, 1, 8).selectExpr("id AS k", "'x' AS v"), path, unique_keys=["k"])
    delta = spark.range(0, 800, 1, 8).selectExpr("id * 1000 AS k", "'y' AS v")
    snapshots.merge_snapshot(delta, path, ["k"], delete_unmatched=False)
    assert [r.operation for r in snapshots.history(spark, path).collect()] == ["MERGE", "CREATE"]
    assert snapshots.file_count(spark, path) == 1
    assert snapshots.read_snapshot(spark, path).filter("v = 'y'").count() == 800


def test_stored_keys_are_counted_once_for_a_merge(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "a", "x"), (1, "a", "x"), (2, "a", "x"))
    snapshots.write_snapshot(df, path)
    snapshots.merge_snapshot(frame(spark, (1, "b", "y"), (3, "b", "y")), path, ["k"], source_keys_unique=True)
    assert rows(snapshots.read_snapshot(spark, path)) == Counter({(1, "b", "y"): 2, (3, "b", "y"): 1})
    assert not spark.sparkContext._jsc.getPersistentRDDs()


def test_the_current_version_is_found_in_the_listing(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(12):
        snapshots.write_snapshot(frame(spark, (n, "a", "x")), path, at=f"2025-01-{n + 1:02d}")
    assert snapshots.current_commit(spark, path)["version"] == 11
    assert snapshots.read_snapshot(spark, path).first()["k"] == 11
    # The older commits are not opened: one that is damaged does no harm.
    for file in (tmp_path / "t" / "history" / "version=3").glob("*.parquet"):
        file.write_bytes(b"damaged")
    assert snapshots.read_snapshot(spark, path).first()["k"] == 11


def test_a_table_without_partitions_is_compacted(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshots.write_snapshot(spark.range(100).repartition(8), path)
    assert snapshots.compact(spark, path) == 1
    assert snapshots.file_count(spark, path) == 1


def test_a_hot_partition_value_is_written_by_several_tasks(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64KB")
    try:
        df = spark.range(0, 200_000, 1, 8).selectExpr(
            "id", "IF(id % 3 = 0, 'hot', 'cold' || id % 50) AS part", "sha2(id || '', 256) AS v"
        )
        tables.write_partitioned(df, str(tmp_path / "t"), ["part"], cluster=True)
        written = spark.read.parquet(str(tmp_path / "t"))
        files = written.withColumn("file", F.input_file_name()).groupBy("part").agg(
            F.countDistinct("file").alias("files")
        )
        per_part = {r.part: r.files for r in files.collect()}
        assert per_part["hot"] > 4
        assert written.count() == 200_000
    finally:
        spark.conf.set(key, before)


def test_expired_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = frame(spark, (1, "a", "x"))
    for at in DAYS[:4]:
        snapshots.write_snapshot(df, path, at=at)

    def expired(hours, now):
        found = snapshots.expired_versions(spark, path, hours, now)
        return sorted(r.version for r in found.collect())

    assert expired(168, DAYS[6]) == []
    assert expired(72, "2025-01-06 00:00:01") == [0, 1]
    assert expired(0, DAYS[6]) == [0, 1, 2]
    # Version 1 was replaced exactly 72 hours before this moment.
    assert expired(72, "2025-01-06 00:00:00") == [0]
    assert snapshots.remove_expired(spark, path, 72, "2025-01-06 00:00:01") == [0, 1]
    assert snapshots.read_snapshot(spark, path, version=0).count() == 1
    removed = snapshots.remove_expired(spark, path, 72, "2025-01-06 00:00:01", dry_run=False)
    assert removed == [0, 1]
    with pytest.raises(ValueError, match="version 0 of .* was removed"):
        snapshots.read_snapshot(spark, path, version=0)
    assert snapshots.read_snapshot(spark, path, version=2).count() == 1
    assert snapshots.remove_expired(spark, path, 72, "2025-01-06 00:00:01") == []
    assert snapshots.commits(spark, path).count() == 4


def test_not_a_table(spark, tmp_path):
    with pytest.raises(ValueError, match="is not a snapshot table"):
        snapshots.read_snapshot(spark, str(tmp_path))
    with pytest.raises(ValueError, match="is not a snapshot table"):
        snapshots.merge_snapshot(spark.range(1), str(tmp_path), ["id"])


def test_format_is_detected(spark, tmp_path):
    df = spark.range(3)
    df.write.parquet(str(tmp_path / "p"))
    snapshots.write_snapshot(df, str(tmp_path / "s"))
    assert tables.detect_format(spark, str(tmp_path / "p")) == "parquet"
    assert tables.detect_format(spark, str(tmp_path / "s")) == "snapshot"
    for name in "ps":
        assert tables.read_table(spark, str(tmp_path / name)).count() == 3


def test_overwrite_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    first = frame(spark, (1, "a", "x"), (2, "b", "x"))
    second = frame(spark, (3, "b", "y"))
    assert tables.write_partitioned(first, path, ["part"]) == 2
    assert tables.write_partitioned(second, path, ["part"], "dynamic") == 1
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 3]
    tables.write_partitioned(second, path, ["part"])
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [3]


def test_partition_types_are_guessed_without_a_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_partitioned(frame(spark, (1, "01", "x")), path, ["part"])
    assert tables.read_parquet(spark, path).first()["part"] == 1
    assert tables.read_parquet(spark, path, SCHEMA).first()["part"] == "01"


def test_ledger_keeps_runs_apart_and_repeats_once(spark, tmp_path):
    path = str(tmp_path / "l")
    for n, run_id in ((1, "0001"), (2, "0002"), (3, "0002")):
        df = spark.range(1).select(F.lit(n).alias("n"))
        schema = ledger.append_run(df, path, "refined", run_id)
    ledger.append_run(df, path, "raw", "0002")
    found = ledger.read_runs(spark, path, schema).select("n", "stage", "run_id")
    assert rows(found) == Counter(
        {(1, "refined", "0001"): 1, (3, "refined", "0002"): 1, (3, "raw", "0002"): 1}
    )


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch.scratch_path(spark, "x"), scratch.scratch_path(spark, "x")
    assert one.startswith(shared) and two.startswith(shared) and one != two


def test_scratch_of_an_application_can_be_removed(spark, tmp_path):
    path = scratch.scratch_path(spark, "x")
    spark.range(1).write.parquet(path)
    other = path.replace(spark.sparkContext.applicationId, "earlier-run")
    spark.range(1).write.parquet(other)
    assert scratch.remove_scratch(spark, "earlier-run")
    assert not scratch.remove_scratch(spark, "earlier-run")
    assert spark.read.parquet(path).count() == 1


def test_the_warehouse_stands_in_for_a_missing_setting():
    class Session:
        def __init__(self, **settings):
            self.conf = self
            self.settings = settings

        def get(self, key, default=None):
            return self.settings.get(key.removeprefix("spark.").replace(".", "_"), default)

    assert scratch.shared_folder(Session(sql_warehouse_dir="hdfs:/w")) == "hdfs:/w/scratch"
    assert scratch.shared_folder(Session(sql_warehouse_dir="hdfs:/w", checkpoint_dir="hdfs:/c/")) == "hdfs:/c"


def test_a_stored_merge_by_a_condition(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 5), (2, 5), (3, 5), (None, 5)], "k int, v int")
    snapshots.write_snapshot(df, path)
    delta = spark.createDataFrame([(1, 9), (2, 3), (4, 1), (None, 1)], "key int, v int")
    pair, condition = [("k", "key")], "source.v > target.v"
    assert snapshots.write_or_merge(delta, path, pair, delete_unmatched=False, condition=condition) == 1
    found = rows(snapshots.read_snapshot(spark, path))
    assert found == Counter({(1, 9): 1, (2, 5): 1, (2, 3): 1, (3, 5): 1, (None, 5): 1, (4, 1): 1, (None, 1): 1})
    assert snapshots.current_commit(spark, path)["parameters"]["condition"] == condition
    assert snapshots.current_commit(spark, path)["unique_keys"] is None
    assert snapshots.merge_snapshot(delta.limit(0), path, pair, condition=condition) == 2
    assert snapshots.read_snapshot(spark, path).isEmpty()


@pytest.mark.parametrize("condition", [None, "source.v > target.v"])
def test_a_conflict_leaves_no_version_and_no_rows(spark, tmp_path, condition):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 5), (2, 5)], "k int, v int")
    snapshots.write_snapshot(df, path)
    twice = spark.createDataFrame([(1, 9), (1, 8), (2, 9), (7, 1), (7, 1)], "k int, v int")
    for delete_unmatched in (True, False):
        with pytest.raises(MergeConflict, match="1 keys in all: .'k': 1"):
            snapshots.write_or_merge(twice, path, ["k"], delete_unmatched=delete_unmatched, condition=condition)
    assert [r.version for r in snapshots.history(spark, path).collect()] == [0]
    assert len(list((tmp_path / "t" / "data").iterdir())) == 1
    assert rows(snapshots.read_snapshot(spark, path)) == rows(df)
