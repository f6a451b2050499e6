"""Keyed merge of a source frame into a target frame.

Clauses of the *sync* merge: a matched target row takes the source row's
values, an unmatched source row is inserted, and a target row without a source
row is deleted. ``delete_unmatched=False`` keeps those rows (upsert).

Keys match by ``=``: a null key matches nothing, so null-key source rows are
inserted and null-key target rows count as unmatched. A key is a column name,
or a pair of the target's name and the source's. ``condition`` adds a
predicate over ``target.*`` and ``source.*`` columns that matching rows meet
as well; the join is still one by key. The result has the target's columns and
types; a source must bring them all.

Several source rows that match one target row are a conflict. ``merge`` fails
on one when its result is computed; ``merge_conflicts`` lists them beforehand.

A merge is one pass: the sides are tagged, put together and shuffled once, by
key, and each row is decided by what else has its key. A sync merge without a
condition never needs the target's values, so it sends its keys alone. Rows of
keys that are hot are dealt to many tasks, and the few rows of the other side
are copied to all of these.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.functions import any_null, named, quoted

#: A target key with more copies than this is written out by several tasks.
COPIES_PER_BLOCK = 100_000
#: So many of the most frequent keys are looked at for having more copies than that.
HOT_KEYS = 1_000
#: Bits of the bitmap of keys: two megabytes.
KEY_BITS = 1 << 24
#: Source rows of a key that its target rows are compared with in place; beyond it a join does.
CANDIDATES = 1_000

Key = str | tuple[str, str]


class MergeConflict(ValueError):
    """Several source rows match one target row."""


def paired(source: DataFrame, keys: Sequence[Key]) -> tuple[DataFrame, list[str]]:
    """The source with the target's key names, and those names."""
    for key in keys:
        if not isinstance(key, str) and key[0] != key[1]:
            if key[0] in source.columns:
                source = source.drop(named(key[0]))
            source = source.withColumnRenamed(key[1], key[0])
    return source, [key if isinstance(key, str) else key[0] for key in keys]


def _key_columns(keys: Sequence[str]) -> list[str]:
    if not keys:
        raise ValueError("a merge needs at least one key")
    return [f"_key_{i}" for i in range(len(keys))]


def _keys(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    return [named(k).alias(c) for k, c in zip(keys, _key_columns(keys), strict=True)]


def _counted(df: DataFrame, keys: Sequence[str], alias: str) -> DataFrame:
    return df.groupBy(*_keys(df, keys)).agg(F.count(F.lit(1)).alias(alias))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null keys found on several rows, as ``_key_0``..., ``_copies``."""
    return _counted(df.filter(~any_null(keys)), keys, "_copies").filter("_copies > 1")


def merge_conflicts(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Source keys that repeat and exist in the target, with their ``copies``.

    Both sides are reduced to one row per key before they are joined.
    """
    source, keys = paired(source, keys)
    columns = _key_columns(keys)
    present = _counted(target, keys, "_target_rows")
    return (
        repeated_keys(source, keys)
        .join(present, columns, "left_semi")
        .select(
            *[F.col(c).alias(k) for c, k in zip(columns, keys, strict=True)],
            F.col("_copies").alias("copies"),
        )
    )


def as_target(target: DataFrame, source: DataFrame) -> DataFrame:
    """The source in the target's columns and types; others are left out."""
    absent = [c for c in target.columns if c not in source.columns]
    if absent:
        raise ValueError("source lacks columns of the target: " + ", ".join(absent))
    types = {f.name: f.dataType for f in source.schema}
    return source.select(
        [
            quoted(f.name)
            if types[f.name] == f.dataType
            else named(f.name).cast(f.dataType).alias(f.name)
            for f in target.schema
        ]
    )


def hot_keys(df: DataFrame, keys: Sequence[str], least: int = COPIES_PER_BLOCK) -> DataFrame | None:
    """Keys of more than ``least`` rows, as ``_key_0``...; ``None`` if there are none.

    Only the ``HOT_KEYS`` most frequent are asked for: any other has fewer
    than a thousandth of the rows. A job over the key columns finds them.
    """
    counted = _counted(df.filter(~any_null(keys)), keys, "_copies").filter(F.col("_copies") > least)
    found = counted.orderBy(F.col("_copies").desc()).limit(HOT_KEYS).collect()
    columns = _key_columns(keys)
    schema = counted.select(*columns).schema
    return df.sparkSession.createDataFrame([row[:-1] for row in found], schema) if found else None


def _dealt(side: DataFrame, keys: Sequence[str], own: DataFrame | None, other: DataFrame | None) -> DataFrame:
    """A side with ``_salt``: rows of its own hot keys are dealt out, those of the other's are copied to every salt.

    Null keys match nothing, so each such row gets a salt for itself. The hot
    keys are ``HOT_KEYS`` rows at most, which is what makes the broadcast safe.
    """
    columns = _key_columns(keys)
    alone = " OR ".join(f"{c} IS NULL" for c in columns)
    side = side.withColumn("_row", F.monotonically_increasing_id()).withColumn("_alone", F.expr(alone))
    for hot, flag in ((own, "_hot"), (other, "_met")):
        if hot is None:
            side = side.withColumn(flag, F.lit(False))
        else:
            marked = F.broadcast(hot.withColumn(flag, F.lit(True)))
            side = side.join(marked, columns, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    # Several salts for each task, as they are dealt to tasks by hash.
    salts = 8 * int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salt = f"CASE WHEN _alone THEN _row WHEN _hot THEN _row % {salts} ELSE 0L END"
    if other is None:
        return side.withColumn("_salt", F.expr(salt))
    return side.withColumn("_salt", F.expr(f"explode(IF(_met, sequence(0L, {salts - 1}L), array({salt})))"))


def _sides(
    target: DataFrame, source: DataFrame, keys: Sequence[str], target_values: bool, hot: tuple[DataFrame | None, DataFrame | None]
) -> DataFrame:
    """Both sides in one frame, dealt by key and salt: ``_incoming`` tells them apart, ``_values`` has their row.

    Without ``target_values`` the target brings its keys alone.
    """
    incoming = as_target(target, source)
    values = F.struct(*[quoted(c) for c in target.columns])
    blank = F.lit(None).cast(target.select(values.alias("v")).schema["v"].dataType)
    held = target.select(*_keys(target, keys), F.lit(False).alias("_incoming"), (values if target_values else blank).alias("_values"))
    given = incoming.select(*_keys(incoming, keys), F.lit(True).alias("_incoming"), values.alias("_values"))
    of_target, of_source = hot
    # A target row under a key that is hot in the source conflicts, so it is not sent to all salts for it.
    met = held if of_source is None else held.join(
        F.broadcast(of_source.withColumn("_several", F.lit(True))), _key_columns(keys), "left"
    )
    several = F.lit(False) if of_source is None else F.coalesce("_several", F.lit(False))
    held = _dealt(met.withColumn("_several", several), keys, of_target, None)
    given = _dealt(given.withColumn("_several", F.lit(False)), keys, of_source, of_target)
    return held.unionByName(given)


def decided(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    delete_unmatched: bool,
    copies_per_block: int = COPIES_PER_BLOCK,
    target_keys_unique: bool = False,
) -> DataFrame:
    """The merged rows, and beside them ``_conflict`` (a target row that several source rows match; it has to go
    or to fail), ``_repeats`` (its key repeats on a side) and ``_key_0``....

    One pass: the sides are tagged and shuffled together once, by key, and
    what becomes of a row is decided by who else has its key. A sync merge
    sends only keys of the target.
    """
    hot = (
        None if target_keys_unique else hot_keys(target, keys, copies_per_block),
        hot_keys(as_target(target, source), keys, copies_per_block),
    )
    sides = _sides(target, source, keys, not delete_unmatched, hot)
    if any(h is not None for h in hot):
        # The task number is given because AQE would merge what is dealt out here again where rows are narrow.
        tasks = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        sides = sides.repartition(tasks, *_key_columns(keys), "_salt")
    alike = Window.partitionBy(*_key_columns(keys), "_salt")
    found = sides.select(
        "*",
        F.count_if("_incoming").over(alike).alias("_sources"),
        F.count_if(~F.col("_incoming")).over(alike).alias("_targets"),
        F.first(F.when(F.col("_incoming"), F.col("_values")), ignorenulls=True).over(alike).alias("_given"),
    )
    matched = "NOT _incoming AND NOT _alone AND _sources > 0"
    kept = "IF(_incoming, _alone OR (_targets = 0 AND NOT _met), " + (
        "NOT _alone AND (_sources > 0 OR _several))" if delete_unmatched else "true)"
    )
    out = found.select(
        F.expr(f"IF({matched}, _given, _values)").alias("_out"),
        F.expr("NOT _incoming AND NOT _alone AND (_sources > 1 OR _several)").alias("_conflict"),
        F.expr("NOT _alone AND (_sources > 1 OR _targets > 1 OR _hot OR _met)").alias("_repeats"),
        F.expr(kept).alias("_kept"),
        *_key_columns(keys),
    ).filter("_kept")
    return out.select(*[F.col("_out")[c].alias(c) for c in target.columns], "_conflict", "_repeats", *_key_columns(keys))


def decided_where(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[Key],
    delete_unmatched: bool,
    condition: str,
    copies_per_block: int = COPIES_PER_BLOCK,
) -> DataFrame | None:
    """``decided`` with a condition beside the keys; ``None`` where a key is hot.

    The source rows of a key come to its target rows as an array, which the
    condition filters. That is for keys of up to ``CANDIDATES`` source rows.
    """
    pairs = [key if isinstance(key, tuple) else (key, key) for key in keys]
    names = [t for t, _ in pairs]
    renamed, _ = paired(source, keys)
    incoming = as_target(target, renamed)
    if hot_keys(target, names, copies_per_block) is not None or hot_keys(incoming, names, CANDIDATES) is not None:
        return None
    of_source = {t: s for t, s in pairs}
    types = target.schema
    written = F.struct(*[named(of_source.get(f.name, f.name)).cast(f.dataType).alias(f.name) for f in types])
    values = F.struct(*[quoted(c) for c in target.columns])
    candidate = F.struct(*[quoted(c) for c in source.columns], F.col("_row"), F.col("_values").alias("_written"))
    held = target.select(*_keys(target, names), F.lit(False).alias("_incoming"), values.alias("_values")).withColumns(
        {"_row": F.monotonically_increasing_id(), "target": F.col("_values")}
    )
    given = source.select(
        *[named(s).cast(types[t].dataType).alias(c) for (t, s), c in zip(pairs, _key_columns(names), strict=True)],
        F.lit(True).alias("_incoming"), written.alias("_values"), F.monotonically_increasing_id().alias("_row"),
        *[quoted(c) for c in source.columns],
    )
    given = given.select(*_key_columns(names), "_incoming", "_values", "_row", candidate.alias("_candidate"))
    sides = held.unionByName(given, allowMissingColumns=True)
    alone = " OR ".join(f"{c} IS NULL" for c in _key_columns(names))
    sides = sides.withColumn("_alone", F.expr(alone)).withColumn("_salt", F.expr("IF(_alone, _row, 0L)"))
    alike = Window.partitionBy(*_key_columns(names), "_salt")
    candidates = F.when(~F.col("_incoming") & ~F.col("_alone"), F.collect_list("_candidate").over(alike))
    hits = f"coalesce(filter(_candidates, source -> ({condition})), array())"
    met = sides.withColumn("_candidates", candidates).drop("_candidate").withColumn("_hits", F.expr(hits)).drop("_candidates", "target")
    met = met.withColumn("_taken", F.collect_set(F.expr("get(_hits, 0)._row")).over(alike))
    kept = "IF(_incoming, NOT array_contains(_taken, _row), " + ("size(_hits) > 0)" if delete_unmatched else "true)")
    out = met.filter(kept).select(
        F.expr("IF(size(_hits) > 0, get(_hits, 0)._written, _values)").alias("_out"),
        F.expr("size(_hits) > 1").alias("_conflict"),
        F.lit(True).alias("_repeats"),
        *_key_columns(names),
    )
    return out.select(*[F.col("_out")[c].alias(c) for c in target.columns], "_conflict", "_repeats", *_key_columns(names))


def failing(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The decided rows; a conflict among them fails. It stands in a filter, which no choice of columns prunes away."""
    keys = [c for c in rows.columns if c.startswith("_key_")]
    message = F.concat(F.lit("several source rows match a target row: "), F.to_json(F.struct(*keys)))
    failed = F.when(F.col("_conflict"), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.filter(failed).select([quoted(c) for c in columns])


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[Key],
    delete_unmatched: bool = True,
    target_keys_unique: bool = False,
    source_keys_unique: bool = False,
    condition: str | None = None,
    copies_per_block: int = COPIES_PER_BLOCK,
) -> DataFrame:
    """The target after the merge, as a lazy frame that reads each side once.

    Hot keys are looked for when this is called, by a job over key columns.
    ``target_keys_unique=True`` states that no non-null key repeats in the
    target, and ``source_keys_unique=True`` the same of the source. With both,
    a sync merge is the source as it is.
    """
    if condition is not None:
        rows = decided_where(target, source, keys, delete_unmatched, condition, copies_per_block)
        if rows is None:
            return _merge_where(target, source, keys, delete_unmatched, condition)
        return failing(rows, target.columns)
    renamed, names = paired(source, keys)
    if delete_unmatched and target_keys_unique and source_keys_unique:
        _key_columns(names)
        return as_target(target, renamed)
    rows = decided(target, renamed, names, delete_unmatched, copies_per_block, target_keys_unique)
    return failing(rows, target.columns)


def _guarded(merged: DataFrame, conflicts: DataFrame) -> DataFrame:
    """The rows, with a branch that yields none and fails at the first conflict.

    The failure stands in a filter, which no choice of columns prunes away,
    and behind an aggregate, through which no filter is pushed to rows that
    are no conflicts yet.
    """
    first = conflicts.agg(F.count(F.lit(1)).alias("n"), F.min("conflict").alias("conflict"))
    message = F.concat(F.lit("several source rows match a target row: "), "conflict")
    failing = first.filter(F.when(F.col("n") > 0, F.raise_error(message).cast("boolean")).otherwise(F.lit(False)))
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in merged.schema]
    return merged.unionByName(failing.select(*empty))


def _merge_where(
    target: DataFrame, source: DataFrame, keys: Sequence[Key], delete_unmatched: bool, condition: str
) -> DataFrame:
    """A merge whose rows match by key and by a condition."""
    pairs = [key if isinstance(key, tuple) else (key, key) for key in keys]
    _key_columns([t for t, _ in pairs])
    on = F.expr(condition)
    for of_target, of_source in pairs:
        on = on & (F.col(f"target.{quoted(of_target)}") == F.col(f"source.{quoted(of_source)}"))
    numbered = target.withColumn("_row", F.monotonically_increasing_id()).alias("target")
    given = source.alias("source")
    renamed, _ = paired(source, keys)
    names = {of_target: of_source for of_target, of_source in pairs}
    as_given = [
        F.col(f"source.{quoted(names.get(f.name, f.name))}").cast(f.dataType).alias(f.name) for f in target.schema
    ]
    as_target(target, renamed)
    matched = numbered.join(given, on)
    written = matched.select(as_given).unionByName(given.join(target.alias("target"), on, "left_anti").select(as_given))
    if not delete_unmatched:
        written = target.alias("target").join(given, on, "left_anti").unionByName(written)
    twice = matched.groupBy("_row", *[F.col(f"target.{quoted(t)}").alias(f"_key_{i}") for i, (t, _) in enumerate(pairs)])
    twice = twice.agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1").drop("_row")
    return _guarded(written, twice.select(F.to_json(F.struct("*")).alias("conflict")))


def may_match(target: DataFrame, source: DataFrame, keys: Sequence[str], bits: int = KEY_BITS) -> DataFrame:
    """The target with ``_may_match``: false where no source row can have the key, true for the others and some more.

    The source's keys are hashed into a bitmap of ``bits`` bits, which is what
    is broadcast: ``bits`` / 8 bytes, however many rows there are.
    """
    incoming = as_target(target, source)

    def place(df: DataFrame) -> Column:
        return F.when(~any_null(keys), F.pmod(F.xxhash64(*[named(k) for k in keys]), F.lit(bits)) + 1)

    marked = incoming.select(place(incoming).alias("_place")).filter("_place IS NOT NULL")
    bitmaps = marked.groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bitmap")
    )
    asked = target.withColumn("_place", place(target)).withColumn("_of_bucket", F.bitmap_bucket_number("_place"))
    met = asked.join(F.broadcast(bitmaps), F.col("_of_bucket") == F.col("_bucket"), "left")
    bit = "CAST(bitmap_bit_position(_place) AS INT)"
    byte = f"CAST(conv(hex(substring(_bitmap, {bit} DIV 8 + 1, 1)), 16, 10) AS INT)"
    held = F.expr(f"coalesce(shiftright({byte}, {bit} % 8) & 1 = 1, false)").alias("_may_match")
    return met.select(*[quoted(c) for c in target.columns], held)


def merge_delta(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[Key],
    bits: int = KEY_BITS,
    copies_per_block: int = COPIES_PER_BLOCK,
) -> DataFrame:
    """An upsert (``merge(..., delete_unmatched=False)``) of few rows into many.

    Target rows that no source row can match are not shuffled: a bitmap of the
    source's keys tells them, at the price of reading the target twice. What
    is shuffled follows the source, and the share of its keys in ``bits``.
    """
    renamed, names = paired(source, keys)
    asked = may_match(target, renamed, names, bits)
    columns = [quoted(c) for c in target.columns]
    touched = asked.filter("_may_match").select(columns)
    return asked.filter("NOT _may_match").select(columns).unionByName(
        merge(touched, renamed, names, delete_unmatched=False, copies_per_block=copies_per_block)
    )


def merge_actions(target: DataFrame, source: DataFrame, keys: Sequence[Key]) -> DataFrame:
    """Rows per action of a sync merge: ``(action, n_rows)``, three rows.

    Both sides are counted per key before the join, so a hot key is one row.
    """
    source, keys = paired(source, keys)
    target_rows, source_rows = F.col("_target_rows"), F.col("_source_rows")

    def rows(condition: Column, counted: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, counted)), F.lit(0))

    return (
        _counted(target, keys, "_target_rows")
        .join(_counted(source, keys, "_source_rows"), _key_columns(keys), "full_outer")
        .agg(
            rows(source_rows.isNotNull(), target_rows).alias("update"),
            rows(target_rows.isNull(), source_rows).alias("insert"),
            rows(source_rows.isNull(), target_rows).alias("delete"),
        )
        .unpivot([], ["update", "insert", "delete"], "action", "n_rows")
    )


def update_kinds(
    target: DataFrame, source: DataFrame, keys: Sequence[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """Matched target rows by whether a column outside ``ignore`` changes.

    Tells rows with new values from rows that only carry a new run stamp:
    ``(kind, n_rows)`` with the kinds ``changed`` and ``same``. A matched
    target row is counted once; where source rows conflict over it, it fails.
    """
    compared = [c for c in target.columns if c not in {*ignore, *keys}]
    hot = (hot_keys(target, keys), hot_keys(as_target(target, source), keys))
    alike = Window.partitionBy(*_key_columns(keys), "_salt")
    found = _sides(target, source, keys, True, hot).select(
        *_key_columns(keys), "_incoming", "_alone", "_several", "_values",
        F.count_if("_incoming").over(alike).alias("_sources"),
        F.first(F.when(F.col("_incoming"), F.col("_values")), ignorenulls=True).over(alike).alias("_given"),
    )
    same = F.lit(True)
    for c in compared:
        same = same & F.col("_values")[c].eqNullSafe(F.col("_given")[c])
    matched = found.filter("NOT _incoming AND NOT _alone AND (_sources > 0 OR _several)").select(
        same.alias("same"), F.expr("_sources > 1 OR _several").alias("_conflict"), *_key_columns(keys)
    )
    return (
        failing(matched, ["same"])
        .agg(F.count_if(~F.col("same")).alias("changed"), F.count_if("same").alias("same"))
        .unpivot([], ["changed", "same"], "kind", "n_rows")
    )
