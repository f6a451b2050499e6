import random
from collections import Counter
from datetime import date

import pytest

from siltstone.operators import ranges

SCHEMA = "low double, high double, v string"


def rows(df):
    return Counter(map(tuple, df.collect()))


def _random(n, seed, longest):
    dice = random.Random(seed)
    out = []
    for i in range(n):
        low = round(dice.uniform(-50, 50), 1)
        out.append((low, round(low + dice.uniform(0, longest), 1), f"{seed}-{i}"))
    return out + [(None, 3.0, "x"), (3.0, None, "y"), (5.0, 4.0, "z")]


def _overlap(a, b):
    if None in (*a[:2], *b[:2]) or a[0] > a[1] or b[0] > b[1]:
        return False
    return a[0] <= b[1] and b[0] <= a[1]


@pytest.mark.parametrize("width", [0.5, 7, 1000])
def test_pairs_equal_comparing_all(spark, width):
    left, right = _random(60, 1, 30), _random(40, 2, 3)
    found = ranges.overlapping(
        spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA), ("low", "high"), ("low", "high"), width
    )
    expected = Counter((a[2], b[2]) for a in left for b in right if _overlap(a, b))
    assert rows(found.select("left.v", "right.v").toDF("a", "b")) == expected and len(expected) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("delete_unmatched", [True, False])
def test_merge_equals_comparing_all(spark, delete_unmatched):
    target = [(i / 3, f"t{i}") for i in range(90)] + [(None, "n"), (4.0, "t12"), (4.0, "t12")]
    source = [(100.0 + a, f"s{a}", float(a), float(b)) for a, b in ((2, 5), (6, 6), (9, 25), (40, 41), (50, 45))]
    source += [(7.0, "none", None, 8.0)] * 2
    t = spark.createDataFrame(target, "at double, v string")
    s = spark.createDataFrame(source, "at double, v string, low double, high double")
    merged = ranges.merge_ranges(t, s, "at", ("low", "high"), 1, delete_unmatched)
    expected = Counter()
    for at, v in target:
        hits = [x for x in source if at is not None and x[2] is not None and x[2] <= at <= x[3]]
        if hits:
            expected[hits[0][:2]] += 1
        elif not delete_unmatched:
            expected[(at, v)] += 1
    for x in source:
        if x[2] is None or not any(at is not None and x[2] <= at <= x[3] for at, _ in target):
            expected[x[:2]] += 1
    assert rows(merged) == expected


def test_dates_keys_and_conditions(spark):
    t = spark.createDataFrame([(1, date(2024, 1, 10)), (2, date(2024, 1, 10)), (2, date(2024, 6, 1))], "k int, at date")
    s = spark.createDataFrame(
        [(2, date(2020, 1, 1), date(2024, 1, 1), date(2024, 12, 31))], "k int, at date, low date, high date"
    )
    merged = ranges.merge_ranges(t, s, "at", ("low", "high"), 30, False, keys=["k"])
    assert rows(merged) == Counter({(2, date(2020, 1, 1)): 2, (1, date(2024, 1, 10)): 1})
    some = ranges.merge_ranges(t, s, "at", ("low", "high"), 30, False, "target.at > DATE'2024-05-01' OR target.k = 1")
    assert rows(some) == Counter({(2, date(2020, 1, 1)): 2, (2, date(2024, 1, 10)): 1})


def test_conflicts_fail_and_empty_sides_do_not(spark):
    t = spark.createDataFrame([(5.0, "t")], "at double, v string")
    s = spark.createDataFrame([(1.0, "a", 4.0, 6.0), (2.0, "b", 5.0, 5.0)], "at double, v string, low double, high double")
    with pytest.raises(Exception, match="several source rows match a target row"):
        ranges.merge_ranges(t, s, "at", ("low", "high"), 1).count()
    assert rows(ranges.merge_ranges(t.limit(0), s, "at", ("low", "high"), 1)) == Counter({(1.0, "a"): 1, (2.0, "b"): 1})
    assert rows(ranges.merge_ranges(t, s.limit(0), "at", ("low", "high"), 1, False)) == Counter({(5.0, "t"): 1})
    with pytest.raises(ValueError, match="neither a number nor a time"):
        ranges.merge_ranges(t, s, "v", ("low", "high"), 1)
