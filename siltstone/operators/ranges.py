"""Merges whose rows match by ranges, without an equality between them.

Both sides are cut into bins of a width: a row stands in every bin its range
touches, and ranges that overlap share a bin. So the join is one by bin, and
the exact test comes after it. A pair that shares many bins is taken in the
first one only, so it is found once however long its ranges are.

Numbers are binned as they are, dates and timestamps by days. Ranges include
both ends. A null end matches nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from siltstone.functions import named, quoted
from siltstone.operators.merge import Key, as_target, failing

#: Begin and end of a row's range; one name for both where the range is a point.
Range = str | tuple[str, str]


def _ends(over: Range) -> tuple[str, str]:
    return (over, over) if isinstance(over, str) else over


def _bin(df: DataFrame, column: str, width: float) -> Column:
    """The bin of a value: never a lesser one for a greater value, which is all that the join relies on."""
    kind = df.schema[column].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        number = F.unix_date(named(column).cast("date"))
    elif isinstance(kind, NumericType):
        number = named(column)
    else:
        raise ValueError(f"{column} is neither a number nor a time: {kind.simpleString()}")
    return F.floor(number.cast("double") / F.lit(float(width))).cast("long")


def _binned(df: DataFrame, over: Range, width: float, name: str, payload: Column) -> DataFrame:
    """One row per bin that a row's range touches; a range without an end, or that ends before it begins, has one null bin."""
    low, high = _ends(over)
    first, last = _bin(df, low, width), _bin(df, high, width)
    numbered = df.select(
        payload.alias(name), F.monotonically_increasing_id().alias(f"_{name}_row"),
        F.when(named(low) <= named(high), F.sequence(first, last)).alias("_bins"),
    )
    return numbered.select(
        name, f"_{name}_row", F.explode_outer("_bins").alias("_bin"), F.element_at("_bins", 1).alias(f"_{name}_first")
    )


def _matched(
    left: DataFrame, right: DataFrame, names: tuple[str, str], over: dict[str, Range], on: str | None
) -> DataFrame:
    """Each left row with each right row it matches, and rows alone where it meets none in a bin."""
    bounds = {name: tuple(f"{name}.{quoted(c)}" for c in _ends(over[name])) for name in names}
    (a_low, a_high), (b_low, b_high) = (bounds[n] for n in names)
    a, b = names
    exact = f"{a_low} <= {b_high} AND {b_low} <= {a_high} AND _bin = greatest(_{a}_first, _{b}_first)"
    exact = exact if on is None else f"{exact} AND ({on})"
    right = right.withColumnRenamed("_bin", "_right_bin")
    return left.join(right, (F.col("_bin") == F.col("_right_bin")) & F.expr(exact), "left")


def overlapping(
    left: DataFrame, right: DataFrame, left_range: Range, right_range: Range, width: float, condition: str | None = None
) -> DataFrame:
    """Pairs of rows whose ranges overlap, once each, as structs ``left`` and ``right``.

    ``condition`` is a predicate over ``left.*`` and ``right.*`` columns that
    pairs meet as well. ``width`` is that of a bin; a range over many bins
    costs a row for each, and many rows in one bin meet each other there.
    """
    sides = _binned(left, left_range, width, "left", F.struct("*")), _binned(right, right_range, width, "right", F.struct("*"))
    met = _matched(*sides, ("left", "right"), {"left": left_range, "right": right_range}, condition)
    return met.filter(F.col("_right_row").isNotNull()).select("left", "right")


def merge_ranges(
    target: DataFrame,
    source: DataFrame,
    target_range: Range,
    source_range: Range,
    width: float,
    delete_unmatched: bool = True,
    condition: str | None = None,
    keys: Sequence[Key] = (),
) -> DataFrame:
    """``merge.merge`` where rows match because their ranges overlap.

    A target row takes the values of the source row whose range overlaps its
    own, source rows that overlap none are inserted, and target rows without
    one are deleted unless ``delete_unmatched=False``. Several source rows
    over one target row fail. ``keys`` must be equal besides, and ``condition``
    is over ``target.*`` and ``source.*`` columns; it may be any predicate.
    The source must have the target's columns, its range may be others. Rows
    that are alike each count, and an empty side matches nothing.
    """
    as_target(target, source)
    pairs = [key if isinstance(key, tuple) else (key, key) for key in keys]
    tests = [f"target.{quoted(t)} = source.{quoted(s)}" for t, s in pairs] + ([f"({condition})"] if condition else [])
    on = " AND ".join(tests) or None
    types = {f.name: f.dataType for f in target.schema}
    over = {"target": target_range, "source": source_range}
    held = _binned(target, target_range, width, "target", F.struct("*"))
    given = _binned(source, source_range, width, "source", F.struct("*"))
    written = F.struct(*[F.col("source")[c].cast(t).alias(c) for c, t in types.items()])

    met = _matched(held, given, ("target", "source"), over, on)
    once = met.groupBy("_target_row").agg(
        F.first("target").alias("target"),
        F.first(F.when(F.col("_source_row").isNotNull(), written), ignorenulls=True).alias("_written"),
        F.count("_source_row").alias("_sources"),
    )
    if delete_unmatched:
        once = once.filter("_sources > 0")
    kept = once.select(
        F.coalesce("_written", F.struct(*[F.col("target")[c].alias(c) for c in types])).alias("_out"),
        (F.col("_sources") > 1).alias("_conflict"),
        *[F.col("target")[c].alias(f"_key_{i}") for i, c in enumerate(_ends(target_range))],
    )
    rows = kept.select(*[F.col("_out")[c].alias(c) for c in types], "_conflict", *kept.columns[2:])
    alone = _matched(given, held, ("source", "target"), over, on)
    alone = alone.groupBy("_source_row").agg(F.first(written).alias("_out"), F.count("_target_row").alias("_targets"))
    inserted = alone.filter("_targets = 0").select(*[F.col("_out")[c].alias(c) for c in types])
    return failing(rows, target.columns).unionByName(inserted)
