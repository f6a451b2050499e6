"""Windows of texts that repeat, found where equal ones meet.

A window is ``width`` neighbouring symbols (bytes or words). Its anchor is the
least hash of the ``gram``-symbol runs inside it, so equal windows have equal
anchors, and one anchor serves a run of neighbouring windows. A window can
only repeat if its anchor occurs in two runs, or twice in one; only runs whose
anchor does are looked at further. Such a run is cut out as a piece: the
symbols of all its windows, keyed by the anchor. Equal pieces are one, with
the first of their places. A solver sees the distinct pieces of an anchor
together and says which of their windows start earlier elsewhere; a copy of a
piece has all its windows earlier in the first.

An anchor found more than ``HOT`` times is replaced by the hash of the whole
window, one piece a window, so its pieces are all equal and one again, and no
group of pieces grows with the rows that share a line.

Texts travel as compressed slices of whole rows, and what is known of a slice
comes back to it by its number. Slices are stored first, so every reader sees
the same rows under a number however often a task has to run. Anchors and
pieces are sent as one block for each slice and part, not as rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.llm.textbytes import (
    expanded,
    mixed,
    prefix_sums,
    sliding_minimum,
    span_hashes,
    text_bytes,
    text_slices,
    window_hashes,
    word_hashes,
    word_spans,
)

#: Windows of one piece at most; longer runs of one anchor are several pieces.
PIECE_WINDOWS = 4_096
#: Runs of an anchor beyond which its windows go by name, one by one.
HOT = 10_000
#: Text bytes of a slice, and of one part: what a task holds of anchors or pieces grows with the latter.
SLICE_BYTES = 1 << 20
PART_BYTES = 32 << 20
#: Bytes of pieces that are solved at once; one anchor's pieces are never split.
SHARD_BYTES = 512 << 10

_U = np.uint64


@dataclass(frozen=True)
class Symbols:
    """What a text is made of, and how long a window and a gram are."""

    width: int
    gram: int
    words: bool

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes; begin and end byte of each symbol; first symbol of each text (one more); hash of each symbol."""
        data, offsets = text_bytes(texts)
        if self.words:
            begins, ends, first = word_spans(data, offsets)
            return data, begins, ends, first, word_hashes(data, begins, ends)
        places = np.arange(len(data) + 1)
        return data, places[:-1], places[1:], offsets, data

    def grams(self, symbols: np.ndarray) -> np.ndarray:
        return window_hashes(prefix_sums(symbols), self.gram)

    def windows(self, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many windows each text has, and which of all windows do not reach into the next text."""
        sizes = np.diff(first)
        counts = np.maximum(sizes - self.width + 1, 0)
        inside = np.repeat(np.tile([True, False], len(counts)), np.stack([counts, sizes - counts], 1).ravel())
        return counts, inside[: max(len(inside) - self.width + 1, 0)]

    def runs(
        self, first: np.ndarray, symbols: np.ndarray, grams: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Text, first window (in its text), number of windows and anchor of each run."""
        none = np.zeros(0, np.int64)
        if len(symbols) < self.width:
            return none, none, none, np.zeros(0, _U)
        anchors = sliding_minimum(self.grams(symbols) if grams is None else grams, self.width - self.gram + 1)
        counts, new = self.windows(first)
        new[1:] &= anchors[1:] != anchors[:-1]
        new[first[:-1][counts > 0]] = True
        heads = np.flatnonzero(new)
        text = np.searchsorted(first, heads, side="right") - 1
        starts, anchor = heads - first[text], anchors[heads]
        lengths = np.minimum(np.append(heads[1:], len(anchors)) - heads, counts[text] - starts)
        if len(heads) and lengths.max() > PIECE_WINDOWS:
            # Long runs in equal steps from their own begin, so equal stretches are mostly cut alike.
            parts = -(-lengths // PIECE_WINDOWS)
            step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            text, anchor = np.repeat(text, parts), np.repeat(anchor, parts)
            starts = np.repeat(starts, parts) + step * PIECE_WINDOWS
            lengths = np.minimum(np.repeat(lengths, parts) - step * PIECE_WINDOWS, PIECE_WINDOWS)
        return text, starts, lengths, anchor

    def marks(self, first: np.ndarray, grams: np.ndarray, runs: tuple) -> np.ndarray:
        """How often each run has its anchor: more than once where a text repeats within a window's length."""
        text, start, length, anchor = runs
        if not len(text):
            return np.zeros(0, np.int64)
        spans = length + self.width - self.gram
        bounds = np.cumsum(spans) - spans
        out = np.empty(len(text), np.int64)
        # A few runs at a time, since each is looked at over all its grams.
        for low in range(0, len(text), 16_384):
            part = slice(low, low + 16_384)
            same = grams[expanded(first[text[part]] + start[part], spans[part])] == np.repeat(anchor[part], spans[part])
            out[part] = np.add.reduceat(same.astype(np.int64), bounds[part] - bounds[low])
        return out


@dataclass(frozen=True)
class Repeats:
    """What differs between the operators that remove repeated windows.

    ``solve`` is given pieces, the ids of their documents and their first
    windows' places in them; it returns a flag for each window of each piece,
    one piece after the other: whether it starts earlier in another one.
    ``later`` is a condition under which all windows of a place start later
    than those of its piece's first place, and ``later_windows`` says the same
    of windows (``id, slice, doc, start``) and the first ones of their names.
    ``finish`` makes the output columns from texts and their runs of such
    windows.
    """

    symbols: Symbols
    solve: Callable[[list[bytes], list[tuple], np.ndarray], np.ndarray]
    later: str
    later_windows: Callable[[pa.Table, pa.Table], np.ndarray]
    finish: Callable[[list[bytes], list[list[tuple[int, int]]]], list[pa.Array]]
    columns: str

    def apply(self, documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
        """One row per document: doc_id, and ``columns``."""
        chosen = documents.select(
            F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
        )
        kind = chosen.schema["id"].dataType.simpleString()
        # The condition is there so that the joins below can share one shuffle of the slices.
        slices = stored(chosen.mapInArrow(_packed, "slice long, payload binary"), "slices").filter("slice IS NOT NULL")
        total = chosen.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // PART_BYTES))

        anchors = slices.mapInArrow(partial(_anchors, self.symbols, parts), "part int, slice long, anchors binary, counts binary")
        told = (
            anchors.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(_repeated, "slice long, anchors binary, hot binary, any_hot boolean")
            .groupBy("slice").agg(F.collect_list(F.struct("anchors", "hot")).alias("told"), F.max("any_hot").alias("any_hot"))
        )
        told = stored(told, "told")
        met = slices.join(told.drop("any_hot"), "slice")
        pieces = met.mapInArrow(partial(_pieces, self.symbols, parts), "part int, pieces binary")
        solved = pieces.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(
            partial(_solved, self.solve, self.symbols),
            f"anchor long, digest long, first_id {kind}, first_slice long, first_doc int, first_start long, "
            "ranges array<struct<begin: long, stop: long>>",
        )
        places = met.mapInArrow(
            partial(_places, self.symbols), f"anchor long, digest long, id {kind}, slice long, doc int, start long, windows long"
        )
        whole = "array(struct(start AS begin, start + windows AS stop))"
        shifted = "transform(ranges, r -> struct(start + r.begin AS begin, start + r.stop AS stop))"
        runs = (
            places.join(solved, ["anchor", "digest"])
            .select("slice", "doc", F.expr(f"IF({self.later}, {whole}, {shifted})").alias("runs"))
            .filter("size(runs) > 0")
            .groupBy("slice")
            .agg(F.collect_list(F.struct("doc", "runs")).alias("runs"))
        )
        # Windows of hot anchors go by name, packed by slice and part, and what is known of them comes back alike.
        crowded = slices.join(told.filter("any_hot").drop("any_hot"), "slice")
        named = crowded.mapInArrow(partial(_hot_windows, self.symbols, parts), "part int, slice long, windows binary")
        firsts = (
            named.repartition(parts, "part").sortWithinPartitions("part")
            .mapInArrow(_hot_firsts, "slice long, firsts binary")
            .groupBy("slice").agg(F.collect_list("firsts").alias("firsts"))
        )
        judged = slices.join(runs, "slice", "left").join(firsts, "slice", "left")
        return judged.select("slice", "payload", "runs", "firsts").mapInArrow(
            partial(_finished, self), f"doc_id {kind}, {self.columns}"
        )


_ZSTD = {"level": 3}


def _pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return zstandard.ZstdCompressor(**_ZSTD).compress(sink.getvalue())


def _unpack(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(payload)).read_all().combine_chunks()


def _column(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).chunk(0) if table.num_rows else pa.array([], table.schema.field(name).type)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    held: list[pa.RecordBatch] = []
    size = 0

    def slice_of() -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        kind = table.schema.field("id").type
        table = pa.table({"id": table.column("id").cast(kind), "text": table.column("text").cast(pa.binary())})
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([_pack(table)], pa.binary())], ["slice", "payload"])

    for batch in batches:
        for part in text_slices(batch, "text", SLICE_BYTES):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size >= SLICE_BYTES:
                yield slice_of()
                held, size, number = [], 0, number + 1
    if held:
        yield slice_of()


def _texts(table: pa.Table) -> pa.Array:
    """The texts of a slice; of rows without an id, which take no part, empty ones."""
    return pc.if_else(pc.is_valid(_column(table, "id")), _column(table, "text"), b"")


def _blocks(parts: np.ndarray, count: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each part that occurs, and the indexes of its entries."""
    order = np.argsort(parts, kind="stable")
    bounds = np.searchsorted(parts[order], np.arange(count + 1))
    for part in np.flatnonzero(np.diff(bounds)).tolist():
        yield part, order[bounds[part] : bounds[part + 1]]


def _anchors(symbols: Symbols, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slice's anchors by part, and how often each occurs in it, up to 255 times."""
    for batch in batches:
        for number, payload in zip(*(batch.column(c).to_pylist() for c in ("slice", "payload")), strict=True):
            _, _, _, first, hashes = symbols.read(_texts(_unpack(payload)))
            grams = symbols.grams(hashes)
            runs = symbols.runs(first, hashes, grams)
            anchor, at = np.unique(runs[3], return_inverse=True)
            n = np.bincount(at, symbols.marks(first, grams, runs), len(anchor))
            n = np.minimum(n, 255).astype(np.uint8)
            rows = [(p, anchor[i].tobytes(), n[i].tobytes()) for p, i in _blocks((anchor % _U(parts)).astype(np.int64), parts)]
            columns = [
                pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()),
                pa.array([r[1] for r in rows], pa.binary()), pa.array([r[2] for r in rows], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["part", "slice", "anchors", "counts"])


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """All rows of each part; rows come sorted by part."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        part = batch.column("part").to_numpy()
        start = 0
        for cut in [*(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]:
            if held and start < cut and held[-1].column("part")[-1].as_py() != part[start]:
                yield pa.Table.from_batches(held)
                held = []
            if start < cut:
                held.append(batch.slice(start, cut - start))
            start = cut
    if held:
        yield pa.Table.from_batches(held)


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each slice those of its anchors that occur more than once anywhere."""
    for table in _by_part(batches):
        blocks = [np.frombuffer(x, _U) for x in table.column("anchors").to_pylist()]
        anchor, at = np.unique(np.concatenate(blocks), return_inverse=True)
        n = np.bincount(at, np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8))
        often = n[at] > 1
        bounds = np.cumsum([0, *map(len, blocks)])
        own, hot = [], []
        for block, low, high in zip(blocks, bounds, bounds[1:], strict=False):
            keep = often[low:high]
            own.append(block[keep].tobytes())
            hot.append((n[at[low:high][keep]] > HOT).tobytes())
        crowded = pa.array([b"\1" in flags for flags in hot])
        columns = [table.column("slice").combine_chunks(), pa.array(own, pa.binary()), pa.array(hot, pa.binary()), crowded]
        kept = pa.RecordBatch.from_arrays(columns, ["slice", "anchors", "hot", "any_hot"])
        yield kept.filter(pc.greater(pc.binary_length(kept.column("anchors")), 0))


@dataclass
class _Read:
    """A slice, and the runs of those of its anchors that repeat: text, first window, number of windows, anchor."""

    table: pa.Table
    data: np.ndarray
    begins: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    cold: tuple[np.ndarray, ...]
    hot: tuple[np.ndarray, ...]


def _read(symbols: Symbols, payload: bytes, told: list[dict]) -> _Read:
    table = _unpack(payload)
    data, begins, ends, first, hashes = symbols.read(_texts(table))
    runs = symbols.runs(first, hashes)
    known = np.frombuffer(b"".join(t["anchors"] for t in told), _U)
    known_hot = np.frombuffer(b"".join(t["hot"] for t in told), bool)
    order = np.argsort(known)
    known, known_hot = known[order], known_hot[order]
    at = np.minimum(np.searchsorted(known, runs[3]), len(known) - 1)
    found = known[at] == runs[3]
    hot = found & known_hot[at]
    cold = found & ~hot
    return _Read(table, data, begins, ends, first, hashes, tuple(x[cold] for x in runs), tuple(x[hot] for x in runs))


def _cut(symbols: Symbols, payload: bytes, told: list[dict]) -> tuple:
    """Pieces of the runs whose anchors are told and not hot: table of the slice, document, first window, windows, anchor, bytes."""
    own = _read(symbols, payload, told)
    text, start, length, anchor = own.cold
    at = own.first[text] + start
    raw = own.data.tobytes()
    stop = at + length + symbols.width - 2
    pieces = [raw[a:b] for a, b in zip(own.begins[at].tolist(), own.ends[stop].tolist(), strict=True)] if len(at) else []
    return own.table, text, start, length, anchor, pieces


def window_names(symbols: Symbols, hashes: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """64 bits for every window, or the windows ``at``; equal windows have the same, wherever they stand."""
    sums = prefix_sums(hashes)
    return window_hashes(sums, symbols.width) if at is None else span_hashes(sums, at, at + symbols.width)


def second_names(symbols: Symbols, hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64 bits more for the windows ``at``."""
    if symbols.words:
        return window_names(symbols, mixed(hashes.astype(_U) + _U(symbols.width)), at)
    return window_names(symbols, mixed(np.arange(256, dtype=_U) + _U(symbols.width))[hashes], at)


#: Bits of a window's place in its text; the others number a slice's texts.
_OFFSET_BITS = 40


def _split_names(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether windows with one first name, side by side, have several second ones; chance hardly ever makes any."""
    return bool(((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any())


def _hot_windows(symbols: Symbols, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By part, the names of a slice's windows of hot anchors, each with its first place and its number there."""
    for number, payload, told in _met(batches):
        own = _read(symbols, payload, told)
        text, start, length, _ = own.hot
        if not len(text):
            continue
        doc, offset = np.repeat(text, length), expanded(start, length)
        at = own.first[doc] + offset
        a, b = window_names(symbols, own.hashes, at), second_names(symbols, own.hashes, at)
        by_id = pc.sort_indices(_column(own.table, "id")).to_numpy()
        rank = np.empty(own.table.num_rows, np.int64)
        rank[by_id] = np.arange(own.table.num_rows)
        place = rank[doc] << _OFFSET_BITS | offset
        order = np.argsort(a)
        if _split_names(a[order], b[order]):
            order = np.lexsort((b, a))
        a, b = a[order], b[order]
        heads = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        n = np.diff(np.append(heads, len(a)))
        least = np.minimum.reduceat(place[order], heads)
        a, b, doc, offset = a[heads], b[heads], by_id[least >> _OFFSET_BITS], least & (1 << _OFFSET_BITS) - 1
        names = pa.table(
            {
                "a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64)), "id": _column(own.table, "id").take(pa.array(doc)),
                "slice": pa.array(np.full(len(a), number)), "doc": pa.array(doc.astype(np.int64)), "start": pa.array(offset),
                "n": pa.array(n.astype(np.int64)),
            }
        )
        rows = [(p, _pack(names.take(pa.array(i)))) for p, i in _blocks((a % _U(parts)).astype(np.int64), parts)]
        columns = [
            pa.array([r[0] for r in rows], pa.int32()), pa.array([number] * len(rows), pa.int64()),
            pa.array([r[1] for r in rows], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["part", "slice", "windows"])


_MARK_BITS = 20
_PLACE = ["id", "slice", "doc", "start"]


def _hot_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """To each slice the names of its windows that stand more than once anywhere, with their first place."""
    for rows in _by_part(batches):
        table = pa.concat_tables([_unpack(x) for x in rows.column("windows").to_pylist()]).combine_chunks()
        # Most windows beside a common line stand once; they go before anything is put in order of its place.
        a = _column(table, "a").to_numpy()
        order = np.argsort(a)
        heads = np.flatnonzero(np.append(True, a[order][1:] != a[order][:-1]))
        total = np.add.reduceat(_column(table, "n").to_numpy()[order], heads)
        often = order[np.repeat(total > 1, np.diff(np.append(heads, len(order))))]
        if not len(often):
            continue
        table = table.take(pa.array(often)).combine_chunks()
        keys = [(name, "ascending") for name in ("a", "b", *_PLACE)]
        table = table.take(pc.sort_indices(table.select([k for k, _ in keys]), keys)).combine_chunks()
        a, b = (_column(table, c).to_numpy() for c in ("a", "b"))
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        heads, group = np.flatnonzero(new), np.cumsum(new) - 1
        often = np.flatnonzero(np.add.reduceat(_column(table, "n").to_numpy(), heads)[group] > 1)
        if not len(often):
            continue
        first = table.take(pa.array(heads[group[often]]))
        answer = pa.table({"a": pa.array(a[often]), "b": pa.array(b[often]), **{c: first.column(c) for c in _PLACE}}).combine_chunks()
        asked = _column(table, "slice").to_numpy()[often]
        slices, at = np.unique(asked, return_inverse=True)
        packed = [_pack(answer.take(pa.array(i))) for _, i in _blocks(at, len(slices))]
        yield pa.RecordBatch.from_arrays([pa.array(slices), pa.array(packed, pa.binary())], ["slice", "firsts"])


def _hot_runs(repeats: Repeats, number: int, table: pa.Table, packed: list[bytes]) -> Iterator[tuple[int, int, int]]:
    """Document, first window and the one behind the last of each run of windows that start later than their first."""
    symbols = repeats.symbols
    known = pa.concat_tables([_unpack(x) for x in packed])
    known = known.take(pc.sort_indices(known.select(["a", "b"]), [("a", "ascending"), ("b", "ascending")])).combine_chunks()
    _, _, _, first, hashes = symbols.read(_texts(table))
    _, inside = symbols.windows(first)
    known_a, known_b = (_column(known, c).to_numpy() for c in ("a", "b"))
    names = window_names(symbols, hashes).view(np.int64)
    # A table of some bits of the names leaves few windows to be looked up.
    marked = np.zeros(1 << _MARK_BITS, bool)
    marked[known_a & (1 << _MARK_BITS) - 1] = True
    likely = np.flatnonzero(marked[names & (1 << _MARK_BITS) - 1] & inside)
    a = names[likely]
    at = np.minimum(np.searchsorted(known_a, a), len(known_a) - 1)
    met = np.flatnonzero(known_a[at] == a)
    likely, at = likely[met], at[met]
    b = second_names(symbols, hashes, likely).view(np.int64)
    # Names alike in their first half stand side by side.
    while len(step := np.flatnonzero((known_b[at] != b) & (known_a[np.minimum(at + 1, len(known_a) - 1)] == known_a[at]) & (at + 1 < len(known_a)))):
        at[step] += 1
    found = np.flatnonzero(known_b[at] == b)
    likely, at = likely[found], at[found]
    doc = np.searchsorted(first, likely, side="right") - 1
    start = likely - first[doc]
    places = pa.table(
        {
            "id": _column(table, "id").take(pa.array(doc)), "slice": pa.array(np.full(len(doc), number)),
            "doc": pa.array(doc), "start": pa.array(start),
        }
    )
    later = repeats.later_windows(places, known.take(pa.array(at)).combine_chunks())
    doc, start = doc[later], start[later]
    if len(doc):
        heads = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)))
        tails = np.append(heads[1:], len(doc)) - 1
        yield from zip(doc[heads].tolist(), start[heads].tolist(), (start[tails] + 1).tolist(), strict=True)


def _digests(pieces: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blake2b(p, digest_size=8).digest() for p in pieces), np.int64)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, list[dict]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(batch.column(c)[i].as_py() for c in ("slice", "payload", "told"))


def _pieces(symbols: Symbols, parts: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A slice's distinct pieces by part, each with the first of its places there."""
    for number, payload, told in _met(batches):
        table, text, start, _, anchor, pieces = _cut(symbols, payload, told)
        if not len(text):
            continue
        ids = _column(table, "id").take(pa.array(text))
        cut = pa.table(
            {
                "anchor": pa.array(anchor.view(np.int64)), "digest": pa.array(_digests(pieces)), "id": ids,
                "slice": pa.array(np.full(len(text), number)), "doc": pa.array(text.astype(np.int32)),
                "start": pa.array(start), "piece": pa.array(pieces, pa.binary()),
            }
        )
        cut = _firsts(cut)
        part = (_column(cut, "anchor").to_numpy().view(_U) % _U(parts)).astype(np.int64)
        rows = [(p, _pack(cut.take(pa.array(i)))) for p, i in _blocks(part, parts)]
        columns = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["part", "pieces"])


def _firsts(cut: pa.Table) -> pa.Table:
    """Of equal pieces the one at the first place; ordered by anchor."""
    names = ["anchor", "digest", "id", "slice", "doc", "start"]
    cut = cut.take(pc.sort_indices(cut.select(names), [(name, "ascending") for name in names])).combine_chunks()
    anchor, digest = _column(cut, "anchor").to_numpy(), _column(cut, "digest").to_numpy()
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (digest[1:] != digest[:-1])
    return cut.filter(pa.array(new)).combine_chunks()


def _places(symbols: Symbols, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every place of every piece."""
    for number, payload, told in _met(batches):
        table, text, start, length, anchor, pieces = _cut(symbols, payload, told)
        if len(text):
            columns = [
                pa.array(anchor.view(np.int64)), pa.array(_digests(pieces)), _column(table, "id").take(pa.array(text)),
                pa.array(np.full(len(text), number)), pa.array(text.astype(np.int32)), pa.array(start), pa.array(length),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "digest", "id", "slice", "doc", "start", "windows"])


def _solved(solve, symbols: Symbols, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in _by_part(batches):
        cut = _firsts(pa.concat_tables([_unpack(x) for x in rows.column("pieces").to_pylist()]))
        for shard in _shards(cut):
            pieces = _column(shard, "piece").to_pylist()
            docs = list(zip(*(_column(shard, c).to_pylist() for c in ("id", "slice", "doc")), strict=True))
            start = _column(shard, "start").to_numpy()
            flags = solve(pieces, docs, start)
            if symbols.words:
                windows = np.array([len(p.split()) for p in pieces]) - symbols.width + 1
            else:
                windows = np.array([len(p) for p in pieces]) - symbols.width + 1
            bounds = np.concatenate([[0], np.cumsum(windows)])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("stop", pa.int64())]))
            columns = [
                *(_column(shard, c) for c in ("anchor", "digest", "id", "slice", "doc", "start")),
                pa.array(_ranges(flags, bounds), kind),
            ]
            names = ["anchor", "digest", "first_id", "first_slice", "first_doc", "first_start", "ranges"]
            yield pa.RecordBatch.from_arrays(columns, names)


def _shards(cut: pa.Table) -> Iterator[pa.Table]:
    """Whole anchors together, in tables of about ``SHARD_BYTES`` of pieces."""
    anchor = _column(cut, "anchor").to_numpy()
    sizes = np.cumsum(pc.binary_length(_column(cut, "piece")).to_numpy(zero_copy_only=False).astype(np.int64))
    ends = np.append(np.flatnonzero(np.diff(anchor)) + 1, len(anchor))
    start = 0
    for end in ends.tolist():
        if sizes[end - 1] - (sizes[start - 1] if start else 0) >= SHARD_BYTES or end == len(anchor):
            yield cut.slice(start, end - start).combine_chunks()
            start = end


def _ranges(flags: np.ndarray, bounds: np.ndarray) -> list[list[dict]]:
    """The runs of set flags of each stretch ``bounds[i]:bounds[i + 1]``, counted from its begin."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[bounds] = True
    heads = np.flatnonzero(flags & (~np.append(False, flags[:-1]) | edge[:-1]))
    tails = np.flatnonzero(flags & (~np.append(flags[1:], False) | edge[1:])) + 1
    owner = np.searchsorted(bounds, heads, side="right") - 1
    out: list[list[dict]] = [[] for _ in range(len(bounds) - 1)]
    for i, a, b in zip(owner.tolist(), (heads - bounds[owner]).tolist(), (tails - bounds[owner]).tolist(), strict=True):
        out[i].append({"begin": a, "stop": b})
    return out


def _finished(repeats: Repeats, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", *(c.split()[0] for c in repeats.columns.split(","))]
    for batch in batches:
        for i in range(batch.num_rows):
            number, payload, found, packed = (batch.column(c)[i].as_py() for c in ("slice", "payload", "runs", "firsts"))
            table = _unpack(payload)
            runs: list[list[tuple[int, int]]] = [[] for _ in range(table.num_rows)]
            for own in found or ():
                runs[own["doc"]] += [(r["begin"], r["stop"]) for r in own["runs"]]
            for doc, begin, stop in _hot_runs(repeats, number, table, packed) if packed else ():
                runs[doc].append((begin, stop))
            made = repeats.finish(_column(table, "text").to_pylist(), runs)
            yield pa.RecordBatch.from_arrays([_column(table, "id"), *made], names)


def covered(runs: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """Begin and end symbol of each stretch that the windows of the runs cover, apart and in order."""
    out: list[tuple[int, int]] = []
    for begin, stop in sorted(runs):
        if out and begin <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop + width - 1)
        else:
            out.append((begin, stop + width - 1))
    return out
