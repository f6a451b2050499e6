"""Repeated lines, found by levelled sorted runs of line hashes.

Documents come in batches, those with the largest ids first. A run holds the
lines a batch was the first to bring, sorted by hash, with the largest id that
has each and the number of documents. A new batch is merge-joined with the
runs so far: what they lack is its own run, and of what they have only the
number of documents is noted. ``FANOUT`` runs of a level are merged into one
of the next, so a batch meets few runs; a line stands in one run only, and
merging never has to decide between two entries.

When all batches are in, the runs and the notes say which lines repeat and
which document keeps each. Lines that make up a thousandth of all lines or
more, of which there are a thousand at most, are looked up by broadcast and
all others by a join on their hash, so no task gets a line's whole crowd.
Everything is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.sources.scratch import scratch_path

#: Batches that a table is cut into by its ids.
BATCHES = 8
#: Runs of a level before they are merged.
FANOUT = 4
#: A line with more than one of so many line places is looked up by broadcast.
HEAVY = 1_000

# White space of a line's ends, and the letters that are lower-cased.
_SPACE = r" \t\n\u000B\u000C\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _digest(column: str) -> str:
    """SQL for 128 bits of a text's SHA-256; texts with the same are taken as equal."""
    return f"unhex(substring(sha2({column}, 256), 1, 32))"


class LineRuns:
    """The runs of the lines seen so far. ``levels[i]`` has the runs that i mergers led to."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT) -> None:
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []
        self.notes: list[DataFrame] = []

    def entries(self) -> DataFrame | None:
        """All entries, ``hash, keeper, n``: each line once."""
        return _united([run for level in self.levels for run in level])

    def add(self, batch: DataFrame) -> DataFrame:
        """Takes in a batch, ``hash, doc_id`` once per document and line; returns the entries it is first to have.

        A later batch must hold no larger id than an earlier one.
        """
        lines = batch.groupBy("hash").agg(F.max("doc_id").alias("keeper"), F.count("*").alias("n"))
        known = self.entries()
        if known is None:
            met = lines.withColumn("seen", F.lit(False))
        else:
            known = known.select("hash", F.lit(True).alias("_known")).hint("merge")
            met = lines.join(known, "hash", "left").withColumn("seen", F.col("_known").isNotNull()).drop("_known")
        path = scratch_path(self.spark, "run")
        met.sortWithinPartitions("seen", "hash").write.partitionBy("seen").parquet(path)
        both = self.spark.read.schema(met.schema).parquet(path)
        own = both.filter("NOT seen").drop("seen")
        self.notes.append(both.filter("seen").select("hash", "n"))
        self._push(own, 0)
        return own

    def _push(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            merged = _united(self.levels[level]).repartition("hash").sortWithinPartitions("hash")
            self.levels[level] = []
            self._push(stored(merged, f"run-{level + 1}"), level + 1)

    def repeated(self, least: int) -> DataFrame | None:
        """Lines of ``least`` documents or more: ``hash, keeper, n``."""
        entries = self.entries()
        if entries is None:
            return None
        later = _united(self.notes).groupBy("hash").agg(F.sum("n").alias("_later"))
        total = (F.col("n") + F.coalesce("_later", F.lit(0))).alias("n")
        return entries.join(later, "hash", "left").select("hash", "keeper", total).filter(F.col("n") >= least)


def _united(runs: list[DataFrame]) -> DataFrame | None:
    united = None
    for run in runs:
        united = run if united is None else united.unionByName(run)
    return united


def drop_repeated_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_length: int = 20,
    least_documents: int = 3,
    batches: int = BATCHES,
    fanout: int = FANOUT,
) -> DataFrame:
    r"""``doc_id, text, n_lines, n_dropped``: the documents without the lines that others repeat.

    Lines are equal when they are so after their white space at both ends is
    stripped and A-Z lower-cased. One of ``least_length`` code points or more
    that ``least_documents`` documents have stays in the one with the largest
    id alone, there at all its places. Texts are split at ``\n``; a null text
    is empty, and an empty one is one empty line.

    Rows that repeat an id each count as a document, and all rows with the
    largest id keep the line. A row without an id counts as one with an id
    below all others. An empty table gives no rows. Other columns are not read.
    """
    spark = documents.sparkSession
    chosen = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    lower = F.translate("text", _UPPER, _LOWER)
    places = chosen.select("doc_id", F.expr(_digest("text")).alias("copy"), F.posexplode(F.split(lower, "\n")))
    key = f"btrim(col, '{_SPACE}')"
    places = places.filter(f"length({key}) >= {least_length}").selectExpr("doc_id", "copy", "pos", f"{_digest(key)} AS hash")
    tasks = batches * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // batches)
    batch = F.expr(f"CAST(spark_partition_id() * {batches} DIV {tasks} AS INT)")
    ranged = places.repartitionByRange(tasks, F.col("doc_id").desc_nulls_last(), "copy").withColumn("batch", batch)
    # A row has a line once, however many places it has there; rows that repeat id and text are as many documents.
    ranged = ranged.withColumn("once", F.expr("pos = min(pos) OVER (PARTITION BY doc_id, copy, hash)"))
    path = scratch_path(spark, "lines")
    ranged.write.partitionBy("batch").parquet(path)
    places = spark.read.schema(ranged.schema).parquet(path)

    runs = LineRuns(spark, fanout)
    for number in range(batches):
        runs.add(places.filter((F.col("batch") == number) & F.col("once")).select("hash", "doc_id"))
    repeated = stored(runs.repeated(least_documents), "repeated")

    limit = places.count() // HEAVY
    heavy = F.broadcast(repeated.filter(F.col("n") > limit))
    light = repeated.filter(F.col("n") <= limit)
    crowd = places.join(heavy, "hash")
    others = places.join(heavy.select("hash"), "hash", "left_anti").join(light, "hash")
    dropped = crowd.unionByName(others).filter("NOT doc_id <=> keeper")
    dropped = dropped.groupBy(F.col("doc_id").alias("_doc"), F.col("copy").alias("_copy")).agg(
        F.collect_set("pos").alias("_dropped")
    )
    # Split below the join, so that the lines are there as they are asked for by number above it.
    split = chosen.select("doc_id", F.expr(_digest("text")).alias("copy"), F.split("text", "\n").alias("_lines"))
    met = split.join(dropped, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("copy") == F.col("_copy")), "left")
    kept = "transform(array_except(sequence(0, size(_lines) - 1), _dropped), i -> _lines[i])"
    return met.select(
        "doc_id",
        F.expr(f"array_join(IF(_dropped IS NULL, _lines, {kept}), '\\n')").alias("text"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.expr("CAST(coalesce(size(_dropped), 0) AS BIGINT)").alias("n_dropped"),
    )


def line_report(documents: DataFrame) -> DataFrame:
    """``drop_repeated_lines`` with a digest in place of the texts."""
    found = drop_repeated_lines(documents)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))
