"""Landing files: JSON records as delivered."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

MALFORMED = "_malformed"
_END = "_end_of_chunk"


def read_json(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    multi_line: bool = False,
    keep_malformed: bool = False,
) -> DataFrame:
    """JSON records, one per line or one array per line.

    Text that is no record of the schema fails the read. ``keep_malformed``
    keeps it instead, as a row of nulls with the text in ``_malformed``, which
    is null in all other rows; it needs a schema. Without a schema Spark reads
    the files once more to infer one. ``multi_line`` parses files as whole
    documents, one task per file; use it for many moderate files, and
    ``read_indented_array`` for large ones.
    """
    reader = spark.read.option("multiLine", multi_line)
    if keep_malformed:
        schema = StructType([*_struct(schema).fields, StructField(MALFORMED, StringType())])
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
    else:
        reader = reader.option("mode", "FAILFAST")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def _struct(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def read_indented_array(
    spark: SparkSession, path: str, schema: StructType | str, indent: int = 2
) -> DataFrame:
    """A pretty-printed JSON array of objects, read by many tasks.

    In a file written with a fixed indent, a line of ``indent`` spaces and a
    closing brace ends a record of several lines (a line break inside a string
    is escaped), so that line separates chunks and the file can be split. A
    chunk may hold more than one record, ``{}`` or compact ones among them:
    each is parsed as an array with a mark behind its last record, and a chunk
    whose mark is not reached fails the read, as does any other text that is
    no record. So every record is returned or none is, whatever the layout.
    """
    close = "\n" + " " * indent + "}"
    chunks = spark.read.option("lineSep", close).text(path)
    # A file's last chunk brings the array's own end and lacks no brace; a record may end in a list as well.
    body = "substring(value, instr(value, '{'))"
    went_on = f"""from_json(concat('[', {body}, '}}, {{"{_END}":true}}]'), 'array<variant>')"""
    reached = f"coalesce(try_variant_get(element_at({went_on}, -1), '$.{_END}', 'boolean'), false)"
    ends = f"value RLIKE '\\\\]\\\\s*$' AND NOT {reached}"
    open_end = f"IF({ends}, regexp_replace({body}, '\\\\]\\\\s*$', ''), concat({body}, '}}'))"
    marked = F.concat(F.lit("["), F.expr(open_end), F.lit(f',{{"{_END}":true}}]'))
    element = StructType([*_struct(schema).fields, StructField(_END, BooleanType())])
    records = F.from_json(marked, ArrayType(element), {"mode": "FAILFAST"})
    stray = F.expr(
        "IF(instr(value, '{') = 0, value, substring(value, 1, instr(value, '{') - 1))"
    ).rlike("[^\\s,\\[\\]]")
    failed = F.raise_error(F.concat(F.lit("no indented array of records: "), F.substring("value", 1, 200)))
    checked = F.when(~stray & F.coalesce(F.element_at("records", -1)[_END], F.lit(False)), F.col("records")).otherwise(
        failed
    )
    parsed = chunks.filter(F.col("value").rlike("[^\\s,\\[\\]]")).select("value", records.alias("records"))
    return (
        parsed.select(checked.alias("records"))
        .select(F.inline(F.expr("slice(records, 1, size(records) - 1)")))
        .drop(_END)
    )


def _count(column: str, mark: str) -> Column:
    return F.length(column) - F.length(F.replace(column, F.lit(mark), F.lit("")))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut behind every closing brace, with what each piece does to a scanner that comes upon it.

    ``_quotes`` is odd where a piece turns the inside of strings out.
    ``_deeper_0`` and ``_deeper_1`` are the levels it goes down, begun outside
    a string and inside one. The brace that ends it counts where it stands
    outside.
    """
    files = spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(path)
    pieces = files.select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
    )
    # An escape and what it escapes are never cut apart: a brace is not escaped.
    pieces = pieces.withColumn("_bare", F.regexp_replace("value", r"\\.", ""))
    pieces = pieces.withColumn("_quotes", _count("_bare", '"') % 2)
    string = '"[^"]*("|$)'
    for begun, text in ((0, F.col("_bare")), (1, F.concat(F.lit('"'), "_bare"))):
        pieces = pieces.withColumn("_out", F.regexp_replace(text, string, ""))
        closed = F.when(F.col("_quotes") == begun, 1).otherwise(0)
        deeper = _count("_out", "{") + _count("_out", "[") - _count("_out", "]") - closed
        pieces = pieces.withColumn(f"_deeper_{begun}", deeper)
    return pieces.drop("_bare", "_out")


def _stretches():
    """The file, block, first row and the row behind the last of each stretch of one block in a batch.

    Made here, like the tasks below, so that workers need not import this package.
    """

    def stretches(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
        file, block = batch.column("_file"), batch.column("_block").to_numpy()
        new = pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False) | (block[1:] != block[:-1])
        for start, stop in pairwise([0, *(np.flatnonzero(new) + 1).tolist(), len(block)]):
            yield file[start].as_py(), int(block[start]), start, stop

    return stretches


def _summed():
    """A row for each block: how many pieces it has, and what they do to a scan begun outside a string, and inside one."""
    stretches = _stretches()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_file", "_block", "_count", "_turns", "_from_0", "_from_1"]
        known, sums = None, [0, 0, 0, 0]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*known, *sums)], names)

        for batch in batches:
            if not batch.num_rows:
                continue
            quotes, *deeper = (batch.column(c).to_numpy() for c in ("_quotes", "_deeper_0", "_deeper_1"))
            for file, block, start, stop in stretches(batch):
                if known != (file, block):
                    if known is not None:
                        yield row()
                    known, sums = (file, block), [0, 0, 0, 0]
                own, (outside, inside) = quotes[start:stop], (d[start:stop] for d in deeper)
                turned = (sums[1] + np.cumsum(own) - own) % 2 == 1
                sums[0] += stop - start
                sums[1] = (sums[1] + int(own.sum())) % 2
                sums[2] += int(np.where(turned, inside, outside).sum())
                sums[3] += int(np.where(turned, outside, inside).sum())
        if known is not None:
            yield row()

    return task


def _block_states(pieces: DataFrame) -> DataFrame:
    """For each block of a file how its scan begins, inside a string or not and at which level, and its last piece if it ends the file.

    A block is summed up for either beginning in the task that reads it, and
    the sums of the blocks before it are added up: no piece leaves its task,
    and a row per block is all that meets in one.
    """
    sums = pieces.select("_file", "_block", "_quotes", "_deeper_0", "_deeper_1").mapInArrow(
        _summed(), "_file string, _block long, _count long, _turns long, _from_0 long, _from_1 long"
    )
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = sums.withColumn("_inside", F.coalesce(F.sum("_turns").over(before), F.lit(0)) % 2)
    goes = F.when(F.col("_inside") == 0, F.col("_from_0")).otherwise(F.col("_from_1"))
    ends_file = F.col("_block") == F.max("_block").over(Window.partitionBy("_file"))
    return inside.withColumn("_goes", goes).select(
        F.col("_file").alias("_of_file"), F.col("_block").alias("_of_block"), "_inside",
        F.coalesce(F.sum("_goes").over(before), F.lit(0)).alias("_level"),
        F.when(ends_file, F.col("_count") - 1).otherwise(-1).alias("_last"),
    )


def _cut_records():
    """The pieces of a block put together up to each end of a record, and what is left behind the last."""
    stretches = _stretches()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The block that is read, the state of its scan, its pieces and texts so far, and the pieces of the text begun.
        known, last, state, level, seen, number = None, -1, 0, 0, 0, 0
        begun: list[str] = []

        def made(texts: list[str], ended: bool) -> pa.RecordBatch:
            n = len(texts)
            columns = [[known[0]] * n, [known[1]] * n, list(range(number, number + n)), [ended] * n, texts]
            return pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["_file", "_block", "_number", "_ended", "_text"])

        def rest() -> list[pa.RecordBatch]:
            # The piece that ends the file lacks no brace.
            return [made(["}".join(begun) + ("}" if last < 0 else "")], False)] if begun else []

        for batch in batches:
            if not batch.num_rows:
                continue
            quotes, *deeper = (batch.column(c).to_numpy() for c in ("_quotes", "_deeper_0", "_deeper_1"))
            values = batch.column("value").to_pylist()
            for file, block, start, stop in stretches(batch):
                if known != (file, block):
                    yield from rest()
                    known, seen, number, begun = (file, block), 0, 0, []
                    state, level, last = (batch.column(c)[start].as_py() for c in ("_inside", "_level", "_last"))
                own, (outside, inside) = quotes[start:stop], (d[start:stop] for d in deeper)
                within = (state + np.cumsum(own) - own) % 2
                depth = level + np.cumsum(np.where(within == 1, inside, outside), dtype=np.int64)
                ends = ((within + own) % 2 == 0) & (depth == 1) & (np.arange(seen, seen + stop - start) != last)
                state, level, seen = int(within[-1] + own[-1]) % 2, int(depth[-1]), seen + stop - start
                texts, at = [], start
                for end in (np.flatnonzero(ends) + start + 1).tolist():
                    texts.append("}".join([*begun, *values[at:end]]) + "}")
                    begun, at = [], end
                if texts:
                    yield made(texts, True)
                    number += len(texts)
                begun += values[at:stop]
        yield from rest()

    return task


def read_array(
    spark: SparkSession, path: str, schema: StructType | str, file_column: str | None = None
) -> DataFrame:
    """A JSON array of objects per file, of any layout, read by many tasks.

    Compact on one line, indented or mixed; records may hold lists, objects,
    escapes, and braces inside strings. Files are cut behind closing braces
    and scanned in two passes: the first sums up what each block of a file
    does to quotes and nesting, so that the second knows how its blocks begin
    and cuts records where the nesting is back at the array's level. A record
    that spans blocks is put together from its parts.

    Every record is returned or the read fails: on elements that are no
    objects, text between records, an array that does not end, a value that
    does not fit the schema. An empty array and a blank file have no records.
    ``file_column`` names a column for the file a record was in.
    """
    pieces = _pieces(spark, path)
    states = _block_states(pieces)
    same = (F.col("_file") == F.col("_of_file")) & (F.col("_block") == F.col("_of_block"))
    # The join leaves pieces where they were read, in their order.
    known = pieces.join(F.broadcast(states), same).drop("_of_file", "_of_block")
    parts = known.mapInArrow(_cut_records(), "_file string, _block long, _number long, _ended boolean, _text string")
    # Whole records begin behind another one's end in the same block; what else there is are two parts a block.
    whole = "_number > 0 AND _ended"
    of_file = Window.partitionBy("_file").orderBy("_block", "_number").rowsBetween(Window.unboundedPreceding, -1)
    spanning = parts.filter(f"NOT ({whole})").withColumn("_record", F.coalesce(F.sum(F.col("_ended").cast("int")).over(of_file), F.lit(0)))
    joined = spanning.groupBy("_file", "_record").agg(
        F.expr("array_join(array_sort(collect_list(struct(_block, _number, _text)))._text, '')").alias("_text"),
        F.bool_or("_ended").alias("_ended"),
        F.min(F.struct("_block", "_number")).alias("_begin"),
    )
    first = "_begin._block = 0 AND _begin._number = 0"
    records = parts.filter(whole).select("_file", "_text", F.lit(True).alias("_ended"), F.lit(False).alias("_first"))
    records = records.unionByName(joined.select("_file", "_text", "_ended", F.expr(first).alias("_first")))
    mark = F.when(F.col("_first"), F.lit("[")).otherwise(F.lit(","))
    opened = F.regexp_extract("_text", r"^\uFEFF?\s*([\[,])\s*\{", 1) == mark
    closed = F.col("_text").rlike(r"^\s*\]\s*$") & ~F.col("_first") | F.col("_text").rlike(r"^(\s*\[\s*\])?\s*$") & F.col("_first")
    failed = F.raise_error(F.concat(F.lit("no array of records: "), F.substring("_text", 1, 200))).cast("boolean")
    kept = F.when(F.col("_ended") & opened, True).when(~F.col("_ended") & closed, False).otherwise(failed)
    body = F.expr("substring(_text, instr(_text, '{'))")
    parsed = records.filter(kept).select("_file", F.from_json(body, _struct(schema), {"mode": "FAILFAST"}).alias("_parsed"))
    return parsed.select("_parsed.*", *([] if file_column is None else [F.col("_file").alias(file_column)]))
