"""Columns added at ingestion and at aggregation, and struct flattening.

All of it is projection: no shuffle, and nothing batch-only, so the same
functions apply to a streaming frame.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltstone.functions import named, quoted

STAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def moment(at: datetime | str | None) -> Column:
    """``at`` as a timestamp literal, or the query's own start time."""
    return F.current_timestamp() if at is None else F.lit(at).cast("timestamp")


def with_ingestion(
    df: DataFrame,
    source_system: str,
    at: datetime | str | None = None,
    timestamp_column: str = "ingestion_timestamp",
    source_column: str = "source_system",
) -> DataFrame:
    """Add the load time (one value for all rows) and the source's name."""
    return df.withColumns({timestamp_column: moment(at), source_column: F.lit(source_system)})


def with_source_file(df: DataFrame, column: str = "file_name") -> DataFrame:
    """Add the path of the file a row was read from.

    ``''`` for rows that come from no file. Apply it straight after the scan:
    behind a shuffle the file is no longer known.
    """
    return df.withColumn(column, F.input_file_name())


def with_date_parts(df: DataFrame, timestamp_column: str) -> DataFrame:
    """Add ``year`` and ``month`` of a timestamp, to partition a table by."""
    ts = named(timestamp_column)
    return df.withColumns({"year": F.year(ts), "month": F.month(ts)})


def enrich(
    df: DataFrame, source_system: str, at: datetime | str | None = None, file_column: str | None = None
) -> DataFrame:
    """The five load columns of a raw table. ``file_column`` has the rows' files where the reader brought them along."""
    loaded = with_ingestion(df, source_system, at)
    if file_column is None:
        loaded = with_source_file(loaded)
    else:
        # Behind the load time, as in other raw tables.
        loaded = loaded.withColumn("file_name", F.col(file_column)).drop(file_column)
    return with_date_parts(loaded, "ingestion_timestamp")


def with_run_stamp(
    df: DataFrame,
    run_id: str,
    at: datetime | str | None = None,
    stamp_column: str = "processed_at",
) -> DataFrame:
    """Add the processing time as text and the id of the run."""
    stamp = F.date_format(moment(at), STAMP_FORMAT)
    return df.withColumns({stamp_column: stamp, "run_id": F.lit(run_id)})


def _field(path: str) -> str:
    """A dotted path with each part quoted, unless it brings its own quotes."""
    return path if "`" in path else ".".join(map(quoted, path.split(".")))


def flatten(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Select nested fields as flat columns: ``{new name: dotted path}``.

    A null parent gives null children. Only the listed leaves are read from
    Parquet, however wide the structs are. A name with a dot in it has to be
    put in backticks, and then all parts that need them.
    """
    return df.selectExpr(*[f"{_field(path)} AS {quoted(n)}" for n, path in columns.items()])


def struct_leaves(schema: StructType, separator: str = "_") -> dict[str, str]:
    """``{flat name: dotted path}`` for every leaf under a struct schema."""

    def walk(struct: StructType, prefix: tuple[str, ...]) -> Iterator[tuple[str, ...]]:
        for field in struct.fields:
            path = (*prefix, field.name)
            if isinstance(field.dataType, StructType):
                yield from walk(field.dataType, path)
            else:
                yield path

    leaves = list(walk(schema, ()))
    flat = {
        separator.join(path): ".".join(map(quoted, path))
        for path in leaves
    }
    if len(flat) < len(leaves):
        raise ValueError("two struct fields flatten to one name; choose another separator")
    return flat


def flatten_all(df: DataFrame, separator: str = "_") -> DataFrame:
    """Flatten every struct of ``df``, names joined along the path."""
    return flatten(df, struct_leaves(df.schema, separator))
