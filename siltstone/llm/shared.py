"""Tables in the shared folder, and the code's way to the Python workers."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siltstone.sources.scratch import scratch_path

ROOT = str(Path(__file__).resolve().parents[2])


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: a lost executor costs a read of these files, and two
    readers of a frame see the same rows even if its tasks had to run twice.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def handing_back(task: Task) -> Task:
    """The task, and at its end the memory that it freed goes back to the system.

    Spark keeps its Python workers for later tasks. What the allocators of
    Arrow and of the C library hold for reuse would count to the executor until then.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            for pool in (pa.default_memory_pool(), pa.system_memory_pool()):
                pool.release_unused()

    return run


_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_DEFAULT_ROWS, _FEW_ROWS = "10000", "1000"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_FEW_BYTES = "512k"


def ship(spark: SparkSession) -> None:
    """Readies a session for the Python tasks of this package.

    Workers started from now on import it from where the driver has it. Rows
    here hold whole texts, so Arrow batches get fewer rows and bytes than
    Spark's defaults, unless the session has numbers of its own.
    """
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    if spark.conf.get(_ROWS, _DEFAULT_ROWS) == _DEFAULT_ROWS:
        spark.conf.set(_ROWS, _FEW_ROWS)
    if _BYTES not in spark.conf.getAll:
        spark.conf.set(_BYTES, _FEW_BYTES)
