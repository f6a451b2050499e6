"""Spelling variants: words one edit apart, grouped under the word they vary.

Letters are hashed to a few symbols. Words one edit apart have reduced words
that are equal or one edit apart, so each reduced word's one-edit neighbours
are generated and joined to the reduced vocabulary, and what meets is verified
on the words themselves. Reduced words have few neighbours however large the
alphabet is. A pair needs to be found once: an insertion into one word is a
deletion from the other, and of a replaced symbol the lesser one is raised, so
a neighbourhood is made of the word itself, its deletions and its raised
symbols. Neighbours are sent as 64-bit hashes; two that collide cost a
verification and nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.llm.textbytes import mixed

#: Symbols that letters are hashed to.
SYMBOLS = 8
#: Words of a length that a task works on together, in letters.
LETTERS = 1 << 16

# The letters of a word, and those that are lower-cased.
_RUN = r"[A-Za-zÀ-ÿ]"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15


def word_counts(documents: DataFrame, least_length: int = 7, least_count: int = 2, every: int = 31) -> DataFrame:
    """``word, n`` of ``documents`` (``doc_id, text``), one in ``every`` words with a letter deleted by its hash."""
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc"),
        F.explode(F.regexp_extract_all("text", F.lit(f"{_RUN}{{{least_length},}}"), F.lit(0))).alias("run"),
    )
    lower = runs.select(F.col("doc"), F.translate("run", _UPPER, _LOWER).alias("run"))
    hashed = lower.withColumn("hash", F.expr("crc32(encode(concat(doc, ':', run), 'UTF-8'))"))
    shorter = "concat(substring(run, 1, CAST(hash % length(run) AS INT)), substring(run, CAST(hash % length(run) AS INT) + 2))"
    words = hashed.select(F.expr(f"IF(hash % {every} = 0, {shorter}, run)").alias("word"))
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _alike(words: pa.Array, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of one length each time: their rows, and a matrix of their letters' symbols."""
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, LETTERS // length)
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            joined = "".join([texts[i] for i in some.tolist()]).encode("utf-32-le")
            letters = np.frombuffer(joined, "<u4").astype(_U).reshape(len(some), length)
            yield some, mixed(letters) % _U(symbols)


def _finished(sums: np.ndarray, length: int) -> np.ndarray:
    return mixed(sums + _U(length)).view(np.int64)


def _powers(length: int) -> np.ndarray:
    """Factor of each place's symbol in the hash of a word."""
    table = np.full(length, _BASE, _U)
    table[0] = 1
    return np.cumprod(table)[::-1]


def _with_symbols(symbols: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.empty(batch.num_rows, np.int64)
            for rows, matrix in _alike(batch.column("word"), symbols):
                length = matrix.shape[1]
                hashes[rows] = _finished(((matrix + _U(1)) * _powers(length)).sum(1, dtype=_U), length)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes)], [*batch.schema.names, "reduced"])

    return task


def _neighbours(symbols: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_numpy()
            for rows, matrix in _alike(batch.column("word"), symbols):
                for some, hashes in _edits(matrix, symbols):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[rows[some]]), pa.array(hashes)], ["id", "reduced"])

    return task


def _edits(matrix: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of the matrix and hashes of their words, of these without a symbol, and of these with one raised."""
    length = matrix.shape[1]
    factors = _powers(length)
    values = matrix + _U(1)
    whole = (values * factors).sum(1, dtype=_U)
    yield np.arange(len(matrix)), _finished(whole, length)
    # What stands before place i keeps its symbols and loses one factor of the base; unsigned sums wrap.
    ahead = np.zeros((len(matrix), length), _U)
    np.cumsum(values[:, :-1] * factors[1:], axis=1, out=ahead[:, 1:], dtype=_U)
    behind = whole[:, None] - np.cumsum(values * factors, axis=1, dtype=_U)
    # Of equal symbols side by side, deleting the first is deleting any.
    new = np.ones(matrix.shape, bool)
    new[:, 1:] = matrix[:, 1:] != matrix[:, :-1]
    row, place = np.nonzero(new)
    yield row, _finished((ahead + behind)[row, place], length - 1)
    for raised in range(1, symbols):
        row, place = np.nonzero(matrix + _U(raised) < symbols)
        yield row, _finished(whole[row] + _U(raised) * factors[place], length)


def near_words(vocabulary: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """All pairs of words one inserted, deleted or replaced code point apart: ``word, n, near, near_n``.

    ``vocabulary`` has each ``word`` once with its ``n``; pairs stand in both
    directions.
    """
    kept = stored(vocabulary.select("word", "n"), "vocabulary").withColumn("id", F.monotonically_increasing_id())
    reduced = kept.select("id", "word", "n").mapInArrow(
        _with_symbols(symbols), "id long, word string, n long, reduced long"
    )
    reduced = stored(reduced, "reduced")
    edits = reduced.select("id", "word").mapInArrow(_neighbours(symbols), "id long, reduced long")
    near = reduced.select("reduced", F.col("id").alias("_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    met = edits.join(near, "reduced").filter("id <> _id").drop("reduced")
    pairs = met.join(reduced.select("id", "word", "n"), "id").filter("levenshtein(word, near, 1) = 1")
    # Words whose reduced words are equal meet twice.
    ordered = pairs.selectExpr(
        "IF(id < _id, word, near) AS word", "IF(id < _id, n, near_n) AS n",
        "IF(id < _id, near, word) AS near", "IF(id < _id, near_n, n) AS near_n",
    )
    once = stored(ordered.distinct(), "pairs")
    return once.unionByName(once.selectExpr("near AS word", "near_n AS n", "word AS near", "n AS near_n"))


def spelling_variants(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", times: int = 10, symbols: int = SYMBOLS
) -> DataFrame:
    """One row per word: ``word, form, root, n, n_near, form_n``.

    A word's form is the most frequent of the words near it (the first in
    code-point order on a tie) where it is ``times`` as frequent or more, and
    its root is where its forms lead to. As each form is more frequent than
    its word, no way goes in a circle.

    A null text has no words; a null id counts as an empty one. Rows that
    repeat count as often as they stand there. An empty table gives no rows.
    Other columns are not read.
    """
    chosen = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    vocabulary = stored(word_counts(chosen), "words")
    met = near_words(vocabulary, symbols).groupBy("word").agg(
        F.count("*").alias("n_near"), F.expr("min_by(struct(near, near_n), struct(-near_n, near))").alias("best")
    )
    chosen_form = F.col("best.near_n") >= times * F.col("n")
    forms = vocabulary.join(met, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(chosen_form, F.col("best.near")).alias("form"), F.when(chosen_form, F.col("best.near_n")).alias("form_n"),
    )
    forms = stored(forms, "forms")
    # Each round doubles how far up all ways have been followed.
    ways = forms.filter("form IS NOT NULL").selectExpr("word", "form AS root")
    while True:
        ways = stored(ways, "ways")
        further = ways.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        longer = ways.join(further, "root")
        if longer.isEmpty():
            break
        ways = ways.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
    return forms.join(ways, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
