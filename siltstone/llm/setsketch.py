"""Near duplicates by SetSketch registers.

A document's set of word shingles becomes ``REGISTERS`` registers. Register i
is ``floor(1 - log_b(h))`` for the least of exponentially distributed hash
values h of the set's members, so registers are truncated minima on an
exponentially spaced scale; the sketch of a union is the greater register of
the two, and equal sets agree everywhere. Registers are locality-sensitive:
they are banded, and documents that share a band are candidates. A candidate
pair's similarity is estimated from how many registers are greater, less and
equal, as the value that makes those three counts likeliest given the two set
sizes; pairs far below the threshold go, and the rest is confirmed on the full
sets.

Texts with the same words are one class from the start. In a bucket the first
rounds compare each class with one leader, and only with leaders of other
components, as long as that links anything; pairs that are left between
different components of a bucket are then compared in blocks, where only links
leave the task. So a large group of near copies that hang together costs a
comparison per copy and round, and no link between components is lost.
A pair at similarity 0.85 shares no band with a probability of 4e-7.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.components import components
from siltstone.llm.shared import stored
from siltstone.llm.textbytes import mixed, text_slices, word_hashes, word_spans

SHINGLE_WORDS = 5
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, 65_535
#: Standard deviations of the estimate by which a pair may fall short and still be confirmed on full sets.
SLACK = 5.0
#: Rounds of one leader a bucket at most; they end with the first that links nothing.
STAR_ROUNDS = 3
#: Classes of one bucket that are compared with each other in one task.
BLOCK = 512
#: Text bytes that are sketched at once; hashing takes about sixty times as much memory.
SKETCH_BYTES = 128 << 10

_U = np.uint64
_RANDOM = np.random.default_rng(20_221)
_FACTORS = _RANDOM.integers(1 << 62, 1 << 63, REGISTERS, dtype=np.uint64) * _U(2) + _U(1)
_MASKS = _RANDOM.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_STEP = _U(0xD6E8FEB86659FD93)


def normalised(text: bytes) -> bytes:
    """A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+`` joined by one space."""
    return b" ".join(text.lower().split())


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words; of the whole sequence where it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    take = min(width, n)
    total = np.full(n - take + 1, take, _U)
    for i in range(take):
        total = total * _STEP + hashes[i : n - take + 1 + i]
    return np.unique(mixed(total))


def _shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """The shingle set of each normalised text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not len(data):
        return [np.zeros(0, _U)] * len(texts)
    begins, ends, first = word_spans(data, offsets)
    hashes = word_hashes(data, begins, ends)
    return [shingles(hashes[first[i] : first[i + 1]], width) for i in range(len(texts))]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set; none may be empty."""
    members = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((len(sets), REGISTERS), _U)
    for i in range(REGISTERS):
        least[:, i] = np.minimum.reduceat((members ^ _MASKS[i]) * _FACTORS[i], starts)
    share = (least.astype(np.float64) + 0.5) / 2.0**64
    spaced = np.floor(1 - np.log(-np.log1p(-np.minimum(share, 1 - 1e-16)) / RATE) / np.log(BASE))
    return np.clip(spaced, 0, TOP).astype("<u2")


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The likeliest similarity of each pair of register rows, given both set sizes."""
    greater, less = (a > b).sum(1), (a < b).sum(1)
    equal = a.shape[1] - greater - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    low, high = np.zeros(len(a)), np.minimum(u / v, v / u)

    def likelihood(j: np.ndarray) -> np.ndarray:
        # P(K_a > K_b) and P(K_a < K_b) for similarity j.
        more = -np.log1p(-np.clip(u - v * j, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
        fewer = -np.log1p(-np.clip(v - u * j, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
        log = lambda p: np.log(np.maximum(p, 1e-12))
        return greater * log(more) + less * log(fewer) + equal * log(1 - more - fewer)

    # The logarithm is concave in j, so the interval can be cut by comparing two inner points.
    for _ in range(25):
        third = (high - low) / 3
        right = likelihood(low + third) < likelihood(high - third)
        low, high = np.where(right, low + third, low), np.where(right, high, high - third)
    return (low + high) / 2


def _sketch(width: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, "text", SKETCH_BYTES):
                texts = [normalised((t or "").encode()) for t in part.column("text").to_pylist()]
                sets = _shingle_sets(texts, width)
                full = [i for i, s in enumerate(sets) if len(s)]
                rows: list[bytes | None] = [None] * len(sets)
                if full:
                    for i, row in zip(full, registers([sets[i] for i in full]), strict=True):
                        rows[i] = row.tobytes()
                columns = [
                    part.column("doc_id"), part.column("text_hash"),
                    pa.array([blake2b(t, digest_size=16).digest() for t in texts]),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(rows, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "class", "n_shingles", "registers"])

    return task


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 4_096):
            part = batch.slice(start, 4_096)
            sketch = np.frombuffer(b"".join(part.column("registers").to_pylist()), "<u2").reshape(-1, BANDS, ROWS)
            value = np.full(sketch.shape[:2], 0, _U) + np.arange(BANDS, dtype=_U)
            for i in range(ROWS):
                value = mixed(value * _STEP + sketch[:, :, i])
            columns = [
                pa.array(value.ravel().view(np.int64)),
                pa.array(np.tile(np.arange(BANDS, dtype=np.int32), part.num_rows)),
                part.column("node").take(pa.array(np.repeat(np.arange(part.num_rows), BANDS))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "band", "node"])


def _close(threshold: float):
    """Pairs whose estimate does not rule out the threshold."""
    margin = threshold - SLACK * float(np.sqrt(threshold * (1 - threshold) / REGISTERS))

    def keep(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        possible = np.minimum(n_a, n_b) >= threshold * np.maximum(n_a, n_b)
        # Registers of this base agree about as often as members; far too few need no estimate.
        possible[possible] = (a[possible] == b[possible]).mean(1) >= margin - 0.1
        possible[possible] = estimate(a[possible], b[possible], n_a[possible], n_b[possible]) >= margin
        return possible

    return keep


def _estimated(threshold: float):
    keep = _close(threshold)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in ("ra", "rb")
            ]
            sizes = [batch.column(c).to_numpy().astype(float) for c in ("na", "nb")]
            yield batch.select(["a", "b"]).filter(pa.array(keep(*sketch, *sizes)))

    return task


#: Pairs whose registers are compared at once.
_TOGETHER = 1 << 14


class _Sets:
    """Full shingle sets of some rows, and which of the rows already hang together."""

    def __init__(self, sets: list[np.ndarray], component: np.ndarray, percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.component = component
        self.up = list(range(int(component.max(initial=-1)) + 1))

    def _top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def link(self, x: int, y: int) -> bool:
        """Whether rows of two components are linked; if so, the two are one from then on."""
        a, b = self._top(self.component[x]), self._top(self.component[y])
        if a == b or not _similar(self.sets[x], self.sets[y], self.percent):
            return False
        self.up[a] = b
        return True


def _similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _across(width: int, percent: int):
    """Links between different components of a bucket; rows come sorted by bucket and block pair.

    A pair is looked at in the first band it shares, once wherever else it
    meets, and confirmed where it is found: only links leave the task, and of
    these only such as join two components of the table.
    """
    keep = _close(percent / 100)

    def compared(table: pa.Table) -> pa.RecordBatch:
        """The block pairs of a table that holds them whole."""
        sketch = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, REGISTERS)
        bands = sketch.reshape(-1, BANDS, ROWS)
        size = table.column("n_shingles").to_numpy().astype(float)
        part = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
        band, pair, block = (table.column(c).to_numpy() for c in ("band", "pair", "block"))
        texts = [normalised(t.encode()) for t in table.column("text").to_pylist()]
        sets = _Sets(_shingle_sets(texts, width), part, percent)
        heads = _heads(table)
        links: list[tuple[int, int]] = []
        waiting: list[np.ndarray] = []

        def flush() -> None:
            pairs = np.concatenate(waiting, 1)
            waiting.clear()
            for start in range(0, pairs.shape[1], _TOGETHER):
                x, y = pairs[:, start : start + _TOGETHER]
                first = (bands[x] == bands[y]).all(2).argmax(1) == band[x]
                x, y = x[first], y[first]
                close = keep(sketch[x], sketch[y], size[x], size[y])
                links.extend((i, j) for i, j in zip(x[close].tolist(), y[close].tolist(), strict=True) if sets.link(i, j))

        for start, stop in zip(heads, [*heads[1:], table.num_rows], strict=True):
            if pair[start] >> 20 == pair[start] & 0xFFFFF:
                x, y = np.triu_indices(stop - start, 1)
            else:
                first = block[start:stop] == pair[start] >> 20
                x, y = (g.ravel() for g in np.meshgrid(np.flatnonzero(first), np.flatnonzero(~first)))
            x, y = x + start, y + start
            apart = part[x] != part[y]
            waiting.append(np.stack([x[apart], y[apart]]))
            if sum(w.shape[1] for w in waiting) > 8 * _TOGETHER:
                flush()
        if waiting:
            flush()
        x, y = np.array(links, np.int64).reshape(-1, 2).T
        node = table.column("node").combine_chunks()
        return pa.RecordBatch.from_arrays([node.take(pa.array(x)), node.take(pa.array(y))], ["x", "y"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for part in text_slices(batch, "text"):
                table = pa.Table.from_batches([*held, part])
                last = int(_heads(table)[-1])
                if last:
                    yield compared(table.slice(0, last))
                held = table.slice(last).to_batches()
        if held:
            yield compared(pa.Table.from_batches(held))

    return task


def _heads(table: pa.Table) -> np.ndarray:
    """First row of each block pair."""
    bucket, pair = table.column("bucket").to_numpy(), table.column("pair").to_numpy()
    new = np.ones(table.num_rows, bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (pair[1:] != pair[:-1])
    return np.flatnonzero(new)


def _confirm(width: int, percent: int):
    """Keeps pairs with 100 * intersection >= percent * union of their full shingle sets."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict = OrderedDict()

        def own(node, text: str) -> np.ndarray:
            if node not in known:
                known[node] = _shingle_sets([normalised(text.encode())], width)[0]
                if len(known) > 256:
                    known.popitem(last=False)
            return known[node]

        for batch in batches:
            keep = []
            for a, b, ta, tb in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb")), strict=True):
                keep.append(_similar(own(a, ta), own(b, tb), percent))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return task


class _Classes:
    """Classes of texts with the same words, with what is needed to compare them.

    ``texts`` holds the texts of the classes that share a bucket with another;
    they are fetched from the documents once.
    """

    def __init__(self, classes: DataFrame, texts: DataFrame, width: int, percent: int) -> None:
        self.classes, self.texts, self.width, self.percent = classes, texts, width, percent
        self.kind = classes.schema["node"].dataType.simpleString()

    def estimated(self, pairs: DataFrame) -> DataFrame:
        own = self.classes.select("node", "n_shingles", "registers")
        rows = pairs.join(own.toDF("a", "na", "ra"), "a").join(own.toDF("b", "nb", "rb"), "b")
        return rows.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(
            _estimated(self.percent / 100), f"a {self.kind}, b {self.kind}"
        )

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Confirmed links among the pairs."""
        pairs = stored(pairs, "pairs")
        needed = pairs.select("a").union(pairs.select("b")).distinct().toDF("node")
        texts = self.texts.join(needed, "node", "left_semi")
        rows = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb")
        return stored(rows.mapInArrow(_confirm(self.width, self.percent), f"a {self.kind}, b {self.kind}"), "links")

    def across(self, reached: DataFrame) -> DataFrame:
        """Links between the components of a bucket: each pair of its blocks is a group of its own."""
        sizes = reached.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
        rows = reached.join(sizes, "bucket").withColumn("block", F.expr("pmod(xxhash64(node), blocks)"))
        pairs = "transform(sequence(0L, blocks - 1), x -> shiftleft(least(x, block), 20) + greatest(x, block))"
        rows = rows.withColumn("pair", F.explode(F.expr(pairs))).drop("blocks")
        full = rows.join(self.classes.select("node", "n_shingles", "registers"), "node").join(self.texts, "node")
        dealt = full.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair", "node")
        found = dealt.mapInArrow(_across(self.width, self.percent), f"x {self.kind}, y {self.kind}")
        return found.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    percent: int = 85,
    width: int = SHINGLE_WORDS,
) -> DataFrame:
    """One row per document: size of its shingle set, its component, and whether it stays.

    Linked are documents with ``100 * intersection >= percent * union``; the
    document with the least id of a component stays. A null text, or one
    without words, has an empty set and links with nothing, so it stays; so
    does a row without an id, with a null component. Rows that repeat an id
    hang together, whatever their texts are; one of them with an empty set
    stands alone. An empty table gives no rows. Columns besides the two named
    are not read.
    """
    chosen = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    chosen = chosen.withColumn("text_hash", F.xxhash64("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    sketches = stored(
        chosen.mapInArrow(
            _sketch(width),
            f"doc_id {kind}, text_hash long, class binary, n_shingles long, registers binary",
        ),
        "sketches",
    )
    named = sketches.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # A class is a node, whatever ids its documents have; ids come back in when the components are known.
    classes = stored(
        named.groupBy("class")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("n_shingles").alias("n_shingles"),
             F.first("registers").alias("registers"))
        .select("class", F.monotonically_increasing_id().alias("node"), F.col("first.doc_id").alias("doc_id"),
                F.col("first.text_hash").alias("text_hash"), "n_shingles", "registers"),
        "classes",
    )
    banded = classes.select("node", "registers").mapInArrow(_bands, "bucket long, band int, node long")
    shared = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    buckets = stored(banded.join(shared, "bucket").select("bucket", "band", "node"), "buckets")

    meeting = classes.join(buckets.select("node").distinct(), "node", "left_semi")
    texts = chosen.join(meeting.select("node", "doc_id", "text_hash"), ["doc_id", "text_hash"]).select("node", "text")
    compared = _Classes(classes, stored(texts.dropDuplicates(["node"]), "texts"), width, percent)

    links = stored(_of_one_id(named, classes), "same-ids")
    tried = None
    reached = buckets.withColumn("component", F.col("node"))
    for turn in range(STAR_ROUNDS):
        order = "node" if turn == 0 else f"struct(xxhash64(node, bucket, {turn}L), node)"
        leaders = reached.groupBy("bucket").agg(
            F.min_by("node", F.expr(order)).alias("leader"), F.min_by("component", F.expr(order)).alias("led")
        )
        pairs = (
            reached.join(leaders, "bucket")
            .filter("component <> led")
            .select(F.greatest("node", "leader").alias("a"), F.least("node", "leader").alias("b"))
            .distinct()
        )
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "star")
        tried = pairs if tried is None else tried.union(pairs)
        found = compared.confirmed(compared.estimated(pairs))
        if turn and found.isEmpty():
            break
        links = links.union(found)
        joined = components(links)
        reached = _open(buckets, joined)
        if reached.isEmpty():
            break
    if not reached.isEmpty():
        found = stored(compared.across(reached), "links")
        if not found.isEmpty():
            joined = components(links.union(found))

    placed = classes.join(joined, "node", "left").select("class", "doc_id", F.coalesce("component", "node").alias("component"))
    least = placed.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    by_class = placed.join(least, "component").select("class", "component_id")
    filled = sketches.select("doc_id", "class", "n_shingles").join(by_class, "class", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return filled.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), own).alias("component_id"),
        F.coalesce(F.col("doc_id") == own, F.lit(True)).alias("kept"),
    )


def _of_one_id(named: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of ids that have several: documents of one id hang together."""
    several = named.groupBy("doc_id").agg(F.min("class").alias("l"), F.max("class").alias("g")).filter("l <> g")
    held = named.join(several.select("doc_id"), "doc_id", "left_semi").join(classes.select("class", "node"), "class")
    held = held.select("doc_id", "node").distinct()
    first = held.groupBy("doc_id").agg(F.min("node").alias("b"))
    return held.join(first, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b")


def _open(buckets: DataFrame, joined: DataFrame) -> DataFrame:
    """Members of the buckets that still hold several components."""
    members = buckets.join(joined, "node", "left").select(
        "bucket", "band", "node", F.coalesce("component", "node").alias("component")
    )
    several = members.groupBy("bucket").agg(F.min("component").alias("l"), F.max("component").alias("g")).filter("l <> g")
    return stored(members.join(several.select("bucket"), "bucket"), "open")
