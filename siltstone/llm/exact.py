"""Exact duplicates by an extendible-hash index on shared files.

A directory maps the leading bits of a text's hash to a bucket. It starts with
one bucket; while one is overfull, the directory doubles where it has to and
the bucket is split by its next bit. Copies are counted once, so they never
overfill a bucket. Each bucket is a key range with an owner task, which chains
entries that share a hash, compares them byte by byte and writes the bucket's
entries. Copies collapse in each map task before anything is sent, so a text
that a third of the rows hold arrives once per task, not once per row.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.textbytes import text_slices
from siltstone.sources.scratch import scratch_path

#: Entries of a bucket before it is split.
CAPACITY = 4_096
#: The directory has 2 ** MOST_BITS slots at most; they are counted on the driver.
MOST_BITS = 20
#: Bytes of text that one map-side combine holds.
COMBINED = 16 << 20

_SLOT = "shiftrightunsigned(hash, {})"


def split_buckets(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Bucket number of each directory slot; ``counts`` has the entries of the finest slots.

    Doubling level by level: a bucket over capacity is split by one more bit,
    and one within it stays, shared by all slots below it.
    """
    bits = int(len(counts)).bit_length() - 1
    sums = [counts]
    for _ in range(bits):
        sums.append(sums[-1].reshape(-1, 2).sum(1))
    leaf = np.ones(1, bool)
    final = np.zeros(1, bool)
    for depth in range(bits):
        full = sums[bits - depth] > capacity
        final = ~full | final
        leaf = np.repeat(leaf, 2)
        # Only the first slot of a bucket that stays whole starts a new number.
        leaf[1::2] &= ~final
        final = np.repeat(final, 2)
    return np.cumsum(leaf) - 1


class ExtendibleIndex:
    """Directory and buckets of the distinct texts of a table, in two Parquet tables under ``path``."""

    def __init__(self, spark: SparkSession, path: str, bits: int) -> None:
        self.bits = bits
        self.directory = spark.read.parquet(f"{path}/directory")
        self.buckets = spark.read.parquet(f"{path}/buckets")

    @classmethod
    def build(cls, texts: DataFrame, path: str, capacity: int = CAPACITY) -> ExtendibleIndex:
        """``texts`` has columns doc_id and text (not null); ids may be null or repeat."""
        spark = texts.sparkSession
        keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("hash"))
        distinct = keyed.select("hash").distinct()
        total = distinct.count()
        bits = min(MOST_BITS, max(1, (8 * total // capacity).bit_length()))
        slot = F.expr(_SLOT.format(64 - bits))
        counts = np.zeros(1 << bits, np.int64)
        for row in distinct.groupBy(slot.alias("slot")).count().toLocalIterator():
            counts[row["slot"]] = row["count"]
        numbers = split_buckets(counts, capacity)
        slots = [(i, int(n)) for i, n in enumerate(numbers)]
        spark.createDataFrame(slots, "slot long, bucket long").coalesce(1).write.parquet(f"{path}/directory")
        directory = spark.read.parquet(f"{path}/directory")

        combined = keyed.mapInArrow(_combine, _entry_schema(keyed))
        owned = (
            combined.withColumn("slot", slot)
            .join(directory, "slot")
            .drop("slot")
            .repartition("bucket")
            .sortWithinPartitions("bucket", "hash")
        )
        entries = owned.mapInArrow(
            _chain,
            f"bucket long, hash long, chain int, n_bytes long, sha string, keep_id {_kind(keyed)}, group_size long",
        )
        entries.write.parquet(f"{path}/buckets")
        return cls(spark, path, bits)


def _kind(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def _entry_schema(frame: DataFrame) -> str:
    return f"hash long, text string, keep_id {_kind(frame)}, n long"


def _largest(a, b):
    return b if a is None else a if b is None else max(a, b)


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Copies within a stretch of rows become one row with their number and largest id."""
    kind = held = None
    groups: dict[str, list] = {}

    def flush() -> pa.RecordBatch:
        columns = [
            pa.array([g[0] for g in groups.values()], pa.int64()), pa.array(list(groups), pa.string()),
            pa.array([g[1] for g in groups.values()], kind), pa.array([g[2] for g in groups.values()], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["hash", "text", "keep_id", "n"])

    held = 0
    for batch in batches:
        kind = batch.schema.field("doc_id").type
        for part in text_slices(batch, "text"):
            for doc, text, key in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "hash")), strict=True):
                if found := groups.get(text):
                    found[1], found[2] = _largest(found[1], doc), found[2] + 1
                else:
                    groups[text] = [key, doc, 1]
                    held += len(text)
            if held >= COMBINED:
                yield flush()
                groups, held = {}, 0
    if groups:
        yield flush()


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket and hash to entries; texts of one hash are told apart by their bytes."""
    bucket = key = kind = None
    chain: list[list] = []
    done: list[tuple] = []

    def close() -> None:
        for number, (text, keep, n) in enumerate(chain):
            data = text.encode()
            done.append((bucket, key, number, len(data), sha256(data).hexdigest(), keep, n))

    def flush() -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), kind, pa.int64()]
        columns = [pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, ["bucket", "hash", "chain", "n_bytes", "sha", "keep_id", "group_size"])

    for batch in batches:
        kind = batch.schema.field("keep_id").type
        for part in text_slices(batch, "text"):
            rows = (part.column(c).to_pylist() for c in ("bucket", "hash", "text", "keep_id", "n"))
            for at, own, text, keep, n in zip(*rows, strict=True):
                if own != key or at != bucket:
                    close()
                    bucket, key, chain = at, own, []
                for entry in chain:
                    if entry[0] == text:
                        entry[1], entry[2] = _largest(entry[1], keep), entry[2] + n
                        break
                else:
                    chain.append([text, keep, n])
            if done:
                yield flush()
    close()
    if done:
        yield flush()


def exact_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per document with the copy of its text that stays: the one with the largest id.

    Texts are equal when all their bytes are; null counts as empty. Rows that
    repeat an id with the same text get the same answer, and a row without an
    id is dropped in favour of one that has one (``keep_id`` is null where no
    copy has one, and ``kept`` false). An empty table gives no rows. Columns
    besides the two named are not read.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    index = ExtendibleIndex.build(texts, scratch_path(spark, "extendible"), capacity)
    probes = texts.select("doc_id", F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("sha"))
    found = probes.join(index.buckets, ["hash", "sha"])
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.expr("doc_id = keep_id"), F.lit(False)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
