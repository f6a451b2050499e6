from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators import merge

SCHEMA = "k int, v string"


def rows(df):
    return Counter(map(tuple, df.collect()))


def frames(spark, target, source):
    return spark.createDataFrame(target, SCHEMA), spark.createDataFrame(source, SCHEMA)


TARGET = [(1, "t"), (2, "t"), (2, "t2"), (3, "t"), (None, "t")]
SOURCE = [(2, "s"), (4, "s"), (4, "s2"), (None, "s"), (None, "s2")]


def test_sync_updates_inserts_and_deletes(spark):
    target, source = frames(spark, TARGET, SOURCE)
    assert rows(merge.merge(target, source, ["k"])) == Counter(
        {(2, "s"): 2, (4, "s"): 1, (4, "s2"): 1, (None, "s"): 1, (None, "s2"): 1}
    )


def test_upsert_keeps_unmatched_rows(spark):
    target, source = frames(spark, TARGET, SOURCE)
    assert rows(merge.merge(target, source, ["k"], delete_unmatched=False)) == Counter(
        {
            (2, "s"): 2,
            (4, "s"): 1,
            (4, "s2"): 1,
            (None, "s"): 1,
            (None, "s2"): 1,
            (1, "t"): 1,
            (3, "t"): 1,
            (None, "t"): 1,
        }
    )


def brute_force(target, source, delete_unmatched):
    result = Counter()
    for k, v in target:
        matches = [s for s in source if k is not None and s[0] == k]
        if matches:
            result[matches[0]] += 1
        elif not delete_unmatched:
            result[(k, v)] += 1
    for k, v in source:
        if k is None or not any(t[0] == k for t in target):
            result[(k, v)] += 1
    return result


@pytest.mark.parametrize("delete_unmatched", [True, False])
def test_against_brute_force(spark, delete_unmatched):
    target = [(i % 37 if i % 11 else None, f"t{i}") for i in range(120)]
    source = [(i, f"s{i}") for i in range(20, 60)] + [(None, "s")] * 3
    t, s = frames(spark, target, source)
    result = merge.merge(t, s, ["k"], delete_unmatched)
    assert rows(result) == brute_force(target, source, delete_unmatched)


def test_several_key_columns(spark):
    target = spark.createDataFrame([(1, 1, "t"), (1, None, "t")], "a int, b int, v string")
    source = spark.createDataFrame([(1, 1, "s"), (1, 2, "s"), (1, None, "s")], target.schema)
    assert rows(merge.merge(target, source, ["a", "b"])) == rows(source)


def test_a_hot_key_is_written_in_blocks(spark):
    """A third of the target has one key; its copies are dealt to all tasks."""
    target = spark.range(30_000).select(
        F.expr("IF(id % 3 = 0, 7, 1000 + id)").cast("int").alias("k"), F.lit("t").alias("v")
    )
    source = spark.createDataFrame([(7, "s"), (8, "s"), (None, "s")], SCHEMA)
    written = merge.merge(target, source, ["k"], copies_per_block=100)
    assert rows(written) == Counter({(7, "s"): 10_000, (8, "s"): 1, (None, "s"): 1})
    per_task = written.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) == 8
    assert max(r["count"] for r in per_task) < 5_000
    kept = merge.merge(target, source, ["k"], delete_unmatched=False, copies_per_block=100)
    assert rows(kept) == rows(written) + rows(target.filter("k <> 7"))


def test_hot_keys_on_either_side_change_nothing(spark):
    source = spark.createDataFrame([(k, "s") for k in range(1, 8)] + [(9, "s")] * 5 + [(None, "s")], SCHEMA)
    target = spark.createDataFrame([(k, "t") for k in range(0, 8) for _ in range(k + 1)] + [(None, "t")] * 3, SCHEMA)
    for delete_unmatched in (True, False):
        expected = brute_force(list(map(tuple, target.collect())), list(map(tuple, source.collect())), delete_unmatched)
        for size in (1, 2, 3, 100):
            assert rows(merge.merge(target, source, ["k"], delete_unmatched, copies_per_block=size)) == expected
    twice = source.union(spark.createDataFrame([(3, "s")] * 4, SCHEMA))
    for size in (1, 3, 100):
        with pytest.raises(Exception, match="several source rows match a target row"):
            merge.merge(target, twice, ["k"], copies_per_block=size).count()


@pytest.mark.parametrize("delete_unmatched", [True, False])
@pytest.mark.parametrize("condition", [None, "source.v > target.v"])
def test_each_side_is_read_once(spark, tmp_path, delete_unmatched, condition):
    target, source = frames(spark, TARGET, SOURCE)
    for name, side in (("t", target), ("s", source)):
        side.write.parquet(str(tmp_path / name))
    read = [spark.read.parquet(str(tmp_path / name)) for name in ("t", "s")]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        merged = merge.merge(*read, ["k"], delete_unmatched, condition=condition)
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 2
        assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def where_by_hand(target, source, delete_unmatched, met):
    """Rows match by equal first column and ``met``; sources match at most one per target row here."""
    result, taken = Counter(), set()
    for t in target:
        hits = [i for i, s in enumerate(source) if t[0] is not None and s[0] == t[0] and met(s, t)]
        assert len(hits) < 2
        taken.update(hits)
        if hits:
            result[source[hits[0]]] += 1
        elif not delete_unmatched:
            result[t] += 1
    for i, s in enumerate(source):
        if i not in taken:
            result[s] += 1
    return result


@pytest.mark.parametrize("size", [1, 1_000])
@pytest.mark.parametrize("delete_unmatched", [True, False])
def test_a_condition_over_repeated_keys(spark, size, delete_unmatched):
    """Several source rows of a key, each for other target rows; with a hot key it is a join."""
    target = [(i % 5 or None, i) for i in range(60)]
    source = [(k, low) for k in range(1, 7) for low in (0, 25, 50)] + [(None, 1)]
    t, s = spark.createDataFrame(target, "k int, v int"), spark.createDataFrame(source, "k int, v int")
    condition = "target.v >= source.v AND target.v < source.v + 20"
    merged = merge.merge(t, s, ["k"], delete_unmatched, condition=condition, copies_per_block=size)
    assert rows(merged) == where_by_hand(target, source, delete_unmatched, lambda a, b: a[1] <= b[1] < a[1] + 20)


def test_target_rows_without_a_source_are_not_shuffled(spark, tmp_path):
    target = spark.range(0, 50_000, 1, 8).selectExpr("IF(id % 100 = 0, NULL, id % 40000) AS k", "'t' AS v")
    source = spark.createDataFrame([(5, "s"), (39_999, "s"), (-1, "s"), (None, "s")], "k long, v string")
    asked = merge.may_match(target, source, ["k"])
    assert asked.filter("_may_match").select("k").distinct().count() < 20
    assert {r.k for r in asked.filter("_may_match").select("k").distinct().collect()} >= {5, 39_999}
    for bits in (8, merge.KEY_BITS):
        merged = merge.merge_delta(target, source, ["k"], bits=bits)
        assert rows(merged) == rows(merge.merge(target, source, ["k"], delete_unmatched=False))
    plan = merge.merge_delta(target, source, ["k"])._jdf.queryExecution().executedPlan().toString()
    untouched = plan[plan.index("Union") : plan.index("Filter", plan.index("Union") + 1) + 4_000]
    assert "SortMergeJoin" not in untouched
    assert rows(merge.merge_delta(target, source.limit(0), ["k"])) == rows(target)


def test_unique_targets_need_no_join_to_sync(spark):
    target, source = frames(spark, [(1, "t"), (2, "t")], [(2, "s"), (3, "s")])
    result = merge.merge(target, source, ["k"], target_keys_unique=True, source_keys_unique=True)
    assert "Join" not in result._jdf.queryExecution().toString()
    assert rows(result) == rows(source)


def test_sync_reads_only_the_keys_of_the_target(spark, tmp_path):
    target, source = frames(spark, TARGET, SOURCE)
    target.write.parquet(str(tmp_path / "t"))
    result = merge.merge(spark.read.parquet(str(tmp_path / "t")), source, ["k"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<k:int>" in plan
    assert "v:string" not in plan


def test_conflicts_are_repeated_source_keys_with_a_target(spark):
    target, source = frames(
        spark, [(1, "t"), (2, "t")], [(1, "s"), (2, "s"), (2, "s2"), (3, "s"), (3, "s2")]
    )
    assert rows(merge.merge_conflicts(target, source, ["k"])) == Counter({(2, 2): 1})
    nulls = spark.createDataFrame([(None, "a"), (None, "b")], SCHEMA)
    assert merge.merge_conflicts(nulls, nulls, ["k"]).isEmpty()


def test_actions_count_rows(spark):
    target, source = frames(spark, TARGET, SOURCE)
    counted = {r.action: r.n_rows for r in merge.merge_actions(target, source, ["k"]).collect()}
    assert counted == {"update": 2, "insert": 4, "delete": 3}
    empty = target.limit(0)
    counted = {r.action: r.n_rows for r in merge.merge_actions(empty, empty, ["k"]).collect()}
    assert counted == {"update": 0, "insert": 0, "delete": 0}


def test_update_kinds_ignore_stamps(spark):
    schema = "k int, v int, run_id string"
    target = spark.createDataFrame([(1, 1, "a"), (2, None, "a"), (3, 3, "a")], schema)
    source = spark.createDataFrame([(1, 1, "b"), (2, None, "b"), (3, 4, "b")], schema)
    kinds = merge.update_kinds(target, source, ["k"], ignore=["run_id"])
    assert {r.kind: r.n_rows for r in kinds.collect()} == {"changed": 1, "same": 2}
    assert {r.kind: r.n_rows for r in merge.update_kinds(target, source, ["k"]).collect()} == {
        "changed": 3,
        "same": 0,
    }


def test_source_takes_the_columns_and_types_of_the_target(spark):
    target = spark.createDataFrame([(1, "t")], "k bigint, v string")
    source = spark.createDataFrame([("new", 5, "s")], "extra string, k int, v string")
    result = merge.merge(target, source, ["k"])
    assert result.schema.simpleString() == "struct<k:bigint,v:string>"
    assert rows(result) == Counter({(5, "s"): 1})
    with pytest.raises(ValueError, match="lacks columns of the target: v"):
        merge.merge(target, source.drop("v"), ["k"])
    with pytest.raises(ValueError, match="at least one key"):
        merge.merge(target, source, [])


def test_a_frame_can_be_merged_into_itself(spark):
    target, _ = frames(spark, TARGET, SOURCE)
    keyed = target.filter("k <> 2")
    assert rows(merge.merge(keyed, keyed, ["k"], delete_unmatched=False)) == rows(keyed)


def _hot_source(spark):
    """Half of the rows have one key that the target lacks."""
    spread = F.expr("IF(id % 2 = 0, 7, 1000 + id)").cast("int").alias("k")
    return spark.range(0, 400_000, 1, 8).select(spread, F.expr("sha2(id || '', 256)").alias("v"))


def test_a_hot_source_key_is_spread_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        source = _hot_source(spark)
        target = spark.range(4000).selectExpr("CAST(1001 + id % 2000 * 2 AS int) AS k", "'t' AS v")
        written = merge.merge(target, source, ["k"], source_keys_unique=True)
        # The largest value keeps the second column in the join.
        counted = written.filter("k = 7").groupBy(F.spark_partition_id()).agg(F.count("v").alias("n"), F.max("v"))
        per_task = [r["n"] for r in counted.collect()]
        assert sum(per_task) == 200_000
        assert max(per_task) < 80_000
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@pytest.mark.parametrize("delete_unmatched", [True, False])
def test_a_conflict_fails_in_the_plan(spark, delete_unmatched):
    target, source = frames(spark, [(1, "t"), (1, "t"), (1, "t")], [(1, "s"), (1, "s2")])
    merged = merge.merge(target, source, ["k"], delete_unmatched)
    for action in (merged.collect, merged.count, lambda: merged.select("v").collect()):
        with pytest.raises(Exception, match="several source rows match a target row"):
            action()
    with pytest.raises(Exception, match="several source rows match"):
        merge.update_kinds(target, source, ["k"]).collect()


def test_keys_of_two_names(spark):
    target = spark.createDataFrame(TARGET, SCHEMA)
    source = spark.createDataFrame(SOURCE, "key int, v string")
    expected = merge.merge(target, source.withColumnRenamed("key", "k"), ["k"], delete_unmatched=False)
    assert rows(merge.merge(target, source, [("k", "key")], delete_unmatched=False)) == rows(expected)
    # A column of the target's key name that is no key gives way.
    both = source.withColumn("k", F.lit(99))
    assert rows(merge.merge(target, both, [("k", "key")], delete_unmatched=False)) == rows(expected)
    counted = merge.merge_actions(target, source, [("k", "key")])
    assert {r.action: r.n_rows for r in counted.collect()} == {"update": 2, "insert": 4, "delete": 3}


def test_a_condition_beside_the_key(spark):
    target = spark.createDataFrame([(1, 5), (2, 5), (2, 1), (3, 5), (None, 5)], "k int, v int")
    source = spark.createDataFrame([(1, 9), (2, 3), (4, 1), (None, 1)], "key int, v int")
    pair, condition = [("k", "key")], "source.v > target.v"
    synced = merge.merge(target, source, pair, condition=condition)
    assert rows(synced) == Counter({(1, 9): 1, (2, 3): 1, (4, 1): 1, (None, 1): 1})
    kept = merge.merge(target, source, pair, delete_unmatched=False, condition=condition)
    assert rows(kept) == rows(synced) + Counter({(2, 5): 1, (3, 5): 1, (None, 5): 1})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    twice = source.union(spark.createDataFrame([(1, 8)], source.schema))
    with pytest.raises(Exception, match="several source rows match a target row"):
        merge.merge(target, twice, pair, condition=condition).collect()
