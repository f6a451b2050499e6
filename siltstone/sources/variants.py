"""Landing JSON without a declared schema: every record whole, as one ``VARIANT``.

Nothing a record brings is lost, whatever fields it has or lacks. A typed
layout is derived from the records themselves, by one aggregate that merges
their shapes, and can be compared with what was declared.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType, VariantType

from siltstone.functions import quoted

RECORD = "record"


def read_records(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per JSON record, in a column ``record`` of type ``VARIANT``.

    Text that is no JSON fails the read. Lines split over tasks;
    ``multi_line`` files are one task each.
    """
    reader = spark.read.option("singleVariantColumn", RECORD).option("mode", "FAILFAST")
    return reader.option("multiLine", multi_line).json(path)


def layout(records: DataFrame) -> StructType:
    """The fields of all records with types that hold all their values.

    A field with values of kinds that have no common type is a ``VARIANT``
    itself, and so is one that is null in every record. Records that are no
    objects are an error; no records have no fields. The shapes are merged in
    the tasks, one text for each comes to the driver.
    """
    merged = records.agg(F.schema_of_variant_agg(RECORD).alias("shape")).first()["shape"]
    if merged is None or merged == "VOID":
        return StructType()
    if not merged.startswith("OBJECT<"):
        raise ValueError(f"records are no objects with fields: {merged}")
    # The same notation as a table's, but for these two names outside of quoted ones.
    words = re.split(r"(`(?:[^`]|``)*`)", merged)
    words = [w if w.startswith("`") else re.sub(r"\bVOID\b", "VARIANT", w.replace("OBJECT<", "STRUCT<")) for w in words]
    return _sorted(StructType.fromDDL(f"r {''.join(words)}")["r"].dataType)


def _sorted(kind):
    """Fields in the order of their names, at every level."""
    if isinstance(kind, StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        return StructType([StructField(f.name, _sorted(f.dataType)) for f in fields]) if fields else VariantType()
    return ArrayType(_sorted(kind.elementType)) if isinstance(kind, ArrayType) else kind


def typed(records: DataFrame, schema: StructType | None = None) -> DataFrame:
    """The records in columns of a schema, by default that of ``layout``; a field a record lacks is null.

    A value that is not of the schema's type fails the query.
    """
    schema = layout(records) if schema is None else schema
    if not schema.fields:
        return records.select()
    return records.select(F.col(RECORD).cast(schema).alias("_typed")).select("_typed.*")


def leaves(schema: StructType, prefix: str = "") -> dict[str, str]:
    """``{dotted path: type}`` of every field that is no struct; parts that need it are quoted."""
    found = {}
    for field in schema.fields:
        name = field.name if re.fullmatch(r"\w+", field.name) else quoted(field.name)
        if isinstance(field.dataType, StructType):
            found |= leaves(field.dataType, f"{prefix}{name}.")
        else:
            found[f"{prefix}{name}"] = field.dataType.simpleString()
    return found


def _held(path: str, kind: str) -> Column:
    """How many records have a value there; a variant may be one that is null."""
    null = F.is_variant_null(F.col(path)) if kind == "variant" else F.lit(False)
    return F.count_if(F.col(path).isNotNull() & ~null)


def drift(records: DataFrame, declared: StructType) -> DataFrame:
    """``(path, declared_type, found_type, n_records)``: a row per path that is new, lacking, or of another type.

    ``n_records`` is how many records have a value there. One job derives the
    layout, the result is another.
    """
    found = layout(records)
    had, has = leaves(declared), leaves(found)
    changed = [path for path in sorted({*had, *has}) if had.get(path) != has.get(path)]
    rows = typed(records, found) if has else records
    counts = [
        F.struct(
            F.lit(path).alias("path"),
            F.lit(had.get(path)).cast("string").alias("declared_type"),
            F.lit(has.get(path)).cast("string").alias("found_type"),
            (_held(path, has[path]) if path in has else F.lit(0).cast("long")).alias("n_records"),
        )
        for path in changed
    ]
    empty = F.array().cast("array<struct<path: string, declared_type: string, found_type: string, n_records: bigint>>")
    counted = rows.agg(F.count(F.lit(1)).alias("_n"), (F.array(*counts) if counts else empty).alias("_drift"))
    return counted.select(F.inline("_drift"))
