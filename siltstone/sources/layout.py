"""How rows are spread over tasks before a write."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltstone.functions import named
from siltstone.sources import folders
from siltstone.sources.scratch import scratch_path


def clustered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring the rows of each partition value together before a write.

    A rebalance is a hash shuffle whose reduce side is cut to the advisory
    partition size: small values share a task, and a value that holds most of
    the table is split over many tasks and files.
    """
    if not partition_by:
        return df
    return df.hint("rebalance", *map(named, partition_by))


#: Bytes of values that a task of a sorted write sorts, about; in memory they take up to twice as much. Smaller pieces
#: are more pieces, and beyond 200 of them Spark's shuffle holds the rows of an input split in memory while it deals them.
SORTED_BYTES = 256 << 20

_LOCALITY = "spark.sql.sources.ignoreDataLocality"


def value_bytes(df: DataFrame) -> int:
    """About the size of a table's values: eight bytes each, and the lengths of texts, binaries and nested values."""
    lengths = []
    for field in df.schema.fields:
        value = named(field.name)
        if isinstance(field.dataType, T.StringType | T.BinaryType):
            lengths.append(F.octet_length(value))
        elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType | T.VariantType):
            lengths.append(F.octet_length(F.to_json(F.struct(value))))
    rows, *sums = df.agg(F.count("*"), *map(F.sum, lengths)).first()
    return 8 * rows * len(df.columns) + sum(n or 0 for n in sums)


def write_sorted(df: DataFrame, path: str, order: Sequence[str], files: int | None = None) -> None:
    """Overwrite a Parquet table with files that follow one another in ascending order.

    Ordered by their names, the files hold the rows in order (nulls first), so
    a read of a range of the first column opens the row groups of that range
    alone. Rows of equal values are told apart by where they stood, so a value
    that many rows have fills several files instead of one. ``files`` is their
    number; without it the session's shuffle partitions are merged up to its
    advisory size. A file of more than ``SORTED_BYTES`` is sorted in pieces,
    which are stored in order and then written one after the other.
    """
    taken = {c.lower() for c in df.columns}
    tie = "_tie"
    while tie in taken:
        tie = f"_{tie}"
    keys = [named(c) for c in order]
    pieces = 1 if files is None else -(-value_bytes(df) // (files * SORTED_BYTES))
    count = [] if files is None else [files * max(1, pieces)]
    tied = df.withColumn(tie, F.monotonically_increasing_id())
    ranged = tied.repartitionByRange(*count, *keys, tie).sortWithinPartitions(*keys, tie).drop(tie)
    if pieces > 1:
        scratch = scratch_path(df.sparkSession, "pieces")
        ranged.write.parquet(scratch)
        _in_order(df.sparkSession, scratch, ranged.schema).coalesce(files).write.mode("overwrite").parquet(path)
        folders.delete(df.sparkSession, scratch)
    else:
        ranged.write.mode("overwrite").parquet(path)


def _in_order(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The files under ``path``, each as partitions of its own, ordered by the number of the task that wrote it.

    A scan of several files deals them out by size. Places of blocks are not
    asked for, since ``coalesce`` joins neighbours only where it knows none.
    """
    names = [name for name in folders.children(spark, path) if name.startswith("part-")]
    before = spark.conf.get(_LOCALITY)
    spark.conf.set(_LOCALITY, "true")
    try:
        frames = [
            spark.read.schema(schema).parquet(f"{path}/{name}") for name in sorted(names, key=lambda n: int(n.split("-")[1]))
        ]
    finally:
        spark.conf.set(_LOCALITY, before)
    # A few at a time, since each union is analysed as a whole.
    while len(frames) > 1:
        frames = [reduce(DataFrame.unionAll, frames[i : i + 8]) for i in range(0, len(frames), 8)]
    return frames[0]
