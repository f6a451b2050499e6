"""Token ids by content-defined chunks that documents share.

A rolling hash over ``WINDOW`` bytes cuts texts where it has a certain value,
so equal passages are cut alike wherever they stand. A chunk found more than
once is encoded by one document, its owner, and its ids go to all others. What
stands between shared chunks is encoded where it is. Where two pieces meet,
the words around the cut are encoded again: the new ids must agree with both
pieces on the words farther out, and the stretch doubles until they do or
takes in a whole piece.

Only fingerprints of all chunks are shuffled, and the ids of shared ones;
texts are sent compressed, once to the owners' tasks and once to meet what is
known of their chunks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored
from siltstone.llm.textbytes import prefix_sums, text_bytes, text_slices, window_hashes
from siltstone.llm.tokens import Words, vocabulary_path, words_of

WINDOW = 48
#: Bytes between cuts on average; shorter chunks than ``LEAST`` are not shared.
SPACING = 1_024
LEAST = 128
#: Words on either side of a join that are encoded again at first.
AROUND = 2
#: Compressed bytes of texts that a task unpacks together.
SENT_BYTES = 1 << 20

_U = np.uint64


def cut_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text and place of every content-defined cut inside the texts, never within a character."""
    ends = np.flatnonzero(window_hashes(prefix_sums(data), WINDOW) % _U(SPACING) == 0) + WINDOW
    text = np.searchsorted(offsets, ends, side="left") - 1
    inside = (ends - WINDOW >= offsets[text]) & (ends < offsets[text + 1])
    ends, text = ends[inside], text[inside]
    whole = (data[ends] & 0xC0) != 0x80
    return text[whole], (ends - offsets[text])[whole]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, "text"):
            data, offsets = text_bytes(part.column("text"))
            text, at = cut_points(data, offsets)
            lengths = np.diff(offsets)
            owner = np.concatenate([text, np.arange(len(lengths))])
            stops = np.concatenate([at, lengths])
            order = np.lexsort((stops, owner))
            owner, stops = owner[order], stops[order]
            begins = np.zeros(len(stops), np.int64)
            begins[1:] = np.where(owner[1:] == owner[:-1], stops[:-1], 0)
            long = stops - begins >= LEAST
            owner, begins, stops = owner[long], begins[long], stops[long]
            raw = data.tobytes()
            first = offsets[owner]
            digests = [blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first + begins, first + stops, strict=True)]
            columns = [part.column("key").take(pa.array(owner)), pa.array(begins), pa.array(stops), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "begin", "stop", "digest"])


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with each text compressed, as it is sent."""
    compressor = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for part in text_slices(batch, "text"):
            packed = [compressor.compress(t) for t in part.column("text").cast(pa.binary()).to_pylist()]
            names = [n for n in part.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), pa.array(packed, pa.binary())], [*names, "packed"])


def _raw(part: pa.RecordBatch) -> list[bytes]:
    decompressor = zstandard.ZstdDecompressor()
    return [decompressor.decompress(x) for x in part.column("packed").to_pylist()]


def _encode_owned(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            for part in text_slices(batch, "packed", SENT_BYTES):
                digests, pieces = [], []
                for data, owned in zip(_raw(part), part.column("owned").to_pylist(), strict=True):
                    for chunk in owned:
                        digests.append(chunk["digest"])
                        pieces.append(data[chunk["begin"] : chunk["stop"]].decode())
                ids, bounds = words.encode(pa.array(pieces, pa.string()))
                own = [ids[a:b].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(own, pa.binary())], ["digest", "ids"])

    return task


class Joined:
    """A text's ids as its pieces are set end to end; a join looks only at the words around the cut.

    The ids are a list of arrays, put together once at the end, and the bytes
    are those of the whole text, so a join costs the same wherever it is.
    """

    def __init__(self, words: Words, data: bytes) -> None:
        self.words, self.data = words, data
        self.ids: list[np.ndarray] = []
        self.stop = 0

    def _end(self, n: int) -> np.ndarray:
        """The last ``n`` ids so far, all of them if there are fewer."""
        parts, found = [], 0
        for part in reversed(self.ids):
            if found >= n:
                break
            parts.append(part)
            found += len(part)
        ids = np.concatenate(parts[::-1]) if parts else np.zeros(0, "<u2")
        return ids[max(0, len(ids) - n) :]

    def _drop(self, n: int) -> None:
        while n:
            last = self.ids.pop()
            if len(last) > n:
                self.ids.append(last[: len(last) - n])
            n = max(0, n - len(last))

    def add(self, stop: int, right_ids: np.ndarray) -> None:
        """Takes on the piece from where the last one ended to ``stop``, with its ids."""
        data, begin = self.data, self.stop
        self.stop = stop
        if not begin or begin == stop or data[begin - 1 : begin].isspace() or data[begin : begin + 1].isspace():
            self.ids.append(right_ids)
            return
        encode, around = self.words.encode_bytes, AROUND
        while True:
            tail, head = _last_words(data, begin, around), _first_words(data, begin, stop, around)
            whole = len(tail) == begin, len(head) == stop - begin
            old_tail = self._end(sum(map(len, self.ids))) if whole[0] else encode(tail)
            old_head = right_ids if whole[1] else encode(head)
            new = encode(tail + head)
            # Beyond the two fragments at the cut, old and new must be the same.
            far_left = 0 if whole[0] else len(encode(tail[: len(tail) - len(_last_words(tail, len(tail), 1))]))
            far_right = 0 if whole[1] else len(encode(head[len(_first_words(head, 0, len(head), 1)) :]))
            agreed = (
                np.array_equal(self._end(len(old_tail)), old_tail)
                and np.array_equal(right_ids[: len(old_head)], old_head)
                and np.array_equal(new[:far_left], old_tail[:far_left])
                and np.array_equal(new[len(new) - far_right :], old_head[len(old_head) - far_right :])
            )
            if agreed:
                self._drop(len(old_tail))
                self.ids += [new, right_ids[len(old_head) :]]
                return
            around *= 2

    def all(self) -> np.ndarray:
        return np.concatenate(self.ids) if self.ids else np.zeros(0, "<u2")


#: Bytes beside a cut that are looked at first for its words.
_NEAR = 256


def _last_words(data: bytes, stop: int, n: int) -> bytes:
    """The end of the first ``stop`` bytes from the begin of the n-th last word; all of them if there are fewer."""
    near = _NEAR
    while True:
        seen = data[max(0, stop - near) : stop]
        parts = seen.rsplit(None, n)
        # The first part is the begin of the bytes without the white space behind it.
        if len(parts) > n:
            return seen[len(parts[0]) :].lstrip()
        if near >= stop:
            return seen
        near *= 4


def _first_words(data: bytes, begin: int, stop: int, n: int) -> bytes:
    """The bytes from ``begin`` to the end of the n-th word; up to ``stop`` if there are fewer."""
    near = _NEAR
    while True:
        seen = data[begin : min(stop, begin + near)]
        parts = seen.split(None, n)
        if len(parts) > n:
            return seen[: len(seen) - len(parts[n])].rstrip()
        if near >= stop - begin:
            return seen
        near *= 4


def _finish(path: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        for batch in batches:
            for part in text_slices(batch, "packed", SENT_BYTES):
                yield _finished(part, words)

    return task


def _finished(part: pa.RecordBatch, words: Words) -> pa.RecordBatch:
    texts, shared = _raw(part), part.column("shared").to_pylist()
    own: list[str] = []
    plans = []
    for data, chunks in zip(texts, shared, strict=True):
        # The pieces of a text: (begin, stop, ids), ids None where they are encoded here.
        if not chunks:
            plans.append(None)
            own.append(data.decode())
            continue
        at, plan = 0, []
        for chunk in sorted(chunks, key=lambda c: c["begin"]):
            if at < chunk["begin"]:
                plan.append((at, chunk["begin"], None))
            plan.append((chunk["begin"], chunk["stop"], np.frombuffer(chunk["ids"], "<u2")))
            at = chunk["stop"]
        if at < len(data):
            plan.append((at, len(data), None))
        own += [data[a:b].decode() for a, b, ids in plan if ids is None]
        plans.append((data, plan))
    ids, bounds = words.encode(pa.array(own, pa.string()))
    n_tokens, ids_digest, text_digest, reused, at = [], [], [], [], 0
    for entry in plans:
        if entry is None:
            done, at, n = ids[bounds[at] : bounds[at + 1]], at + 1, 0
        else:
            data, plan = entry
            joined, n = Joined(words, data), 0
            for _, stop, known in plan:
                if known is None:
                    known, at = ids[bounds[at] : bounds[at + 1]], at + 1
                else:
                    n += 1
                joined.add(stop, known)
            done = joined.all()
        n_tokens.append(len(done))
        reused.append(n)
        ids_digest.append(sha256(done.astype("<u4").tobytes()).hexdigest())
        text_digest.append(sha256(words.decode(done)).hexdigest())
    columns = [part.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_digest), pa.array(text_digest), pa.array(reused, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_shared"])


def encode(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """One row per document: its number of tokens, and digests of its ids and of the text they decode to.

    ``n_shared`` counts the chunks whose ids came from their owner. A null or
    empty text has no tokens. Ids may be null or repeat: a chunk belongs to a
    pair of id and text, and every row gets its answer. An empty table gives no
    rows. Columns besides the two named are not read.
    """
    path = vocabulary or vocabulary_path()
    chosen = documents.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    kind = chosen.schema["doc_id"].dataType.simpleString()
    # The id with its length in front, so that no two pairs of id and text read alike.
    named = "coalesce(concat(octet_length(CAST(doc_id AS STRING)), ':', CAST(doc_id AS STRING)), '-')"
    keyed = chosen.select("doc_id", F.expr(f"md5(concat({named}, '|', text))").alias("key"), "text")
    chunks = keyed.select("key", "text").mapInArrow(_chunks, "key string, begin long, stop long, digest binary")
    chunks = stored(chunks, "chunks")
    shared = chunks.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("key", "begin")).alias("owner"))
    uses = stored(
        chunks.join(shared.filter("n > 1"), "digest")
        .select("key", "begin", "stop", "digest", F.expr("owner = struct(key, begin)").alias("own"))
        .distinct(),
        "uses",
    )
    owned = uses.filter("own").groupBy("key").agg(F.collect_list(F.struct("begin", "stop", "digest")).alias("owned"))
    encoded = (
        keyed.select("key", "text").mapInArrow(_compressed, "key string, packed binary")
        .join(owned, "key")
        .select("packed", "owned")
        .mapInArrow(_encode_owned(path), "digest binary, ids binary")
        .groupBy("digest")
        .agg(F.first("ids").alias("ids"))
    )
    known = (
        uses.join(stored(encoded, "encoded"), "digest")
        .groupBy("key")
        .agg(F.collect_list(F.struct("begin", "stop", "ids")).alias("shared"))
    )
    return (
        keyed.mapInArrow(_compressed, f"doc_id {kind}, key string, packed binary")
        .join(known, "key", "left")
        .select("doc_id", "packed", "shared")
        .mapInArrow(
            _finish(path),
            f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_shared long",
        )
    )
