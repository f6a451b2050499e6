"""Best-fit packing of documents into sequences by hierarchical residual packing.

Each task packs the pieces it has tokenized, best fit in decreasing order, and
its nearly full bins are final. Underfull bins then climb a tree: at each
level the bins of ``FAN_IN`` neighbouring groups meet as items of a further
best-fit round. A group hands up its ``CARRIED`` emptiest bins at most, so no
task holds more than ``FAN_IN * CARRIED`` items however large the input; the
bins it keeps are sequences as they are, and no piece is ever left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import handing_back, stored
from siltstone.llm.textbytes import joined_slices
from siltstone.llm.tokens import vocabulary_path, words_of

LIMIT = 4096
END_ID = 1
#: Pieces a task packs together; their sizes are held in memory, their ids are not.
TOGETHER = 100_000
#: Bytes of text that are tokenized together.
TEXT_BYTES = 3 << 20
#: Bins at least this full are final at once.
FULL = 0.98
FAN_IN = 8
CARRIED = 2_000

_PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"
_PLACED = ", bin long, bin_offset long, bin_filled long"


def best_fit(sizes: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each item, and how full each bin is: best fit, largest first.

    Open bins are stacked by the room they have, and one integer has a bit for
    each room that occurs, so the tightest bin is found without a search.
    """
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    filled: list[int] = []
    by_room: list[list[int]] = [[] for _ in range(limit + 1)]
    rooms = 0
    order = np.argsort(-sizes, kind="stable")
    for item, size in zip(order.tolist(), sizes[order].tolist(), strict=True):
        fitting = rooms >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            number = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            number, room = len(filled), limit
            filled.append(0)
        bins[item], offsets[item] = number, filled[number]
        filled[number] += size
        if room > size:
            if not by_room[room - size]:
                rooms |= 1 << (room - size)
            by_room[room - size].append(number)
    return bins, offsets, np.array(filled, np.int64)


def _packed(ids: list, rows: list[tuple], limit: int, first: int, kind: pa.DataType) -> tuple[pa.RecordBatch, int]:
    piece, start, length, crc = (np.array(x, np.int64) for x in zip(*rows, strict=True))
    bins, offsets, filled = best_fit(length, limit)
    columns = [
        pa.array(ids, kind), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc),
        pa.array(bins + first), pa.array(offsets), pa.array(filled[bins]),
    ]
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "bin", "bin_offset", "bin_filled"]
    return pa.RecordBatch.from_arrays(columns, names), first + len(filled)


def _pack_locally(path: str, limit: int, end_id: int, id_column: str, text_column: str):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        number = TaskContext.get().partitionId() << 32
        ids, rows, kind = [], [], pa.int64()
        # Arrow batches are far smaller, and each slice pays for its distinct words once.
        for part in joined_slices(batches, text_column, TEXT_BYTES):
            kind = part.schema.field(id_column).type
            tokens, bounds = words.encode(part.column(text_column))
            for i, doc in enumerate(part.column(id_column).to_pylist()):
                own = np.append(tokens[bounds[i] : bounds[i + 1]], end_id).astype("<u4")
                for piece, start in enumerate(range(0, len(own), limit)):
                    cut = own[start : start + limit]
                    ids.append(doc)
                    rows.append((piece, start, len(cut), zlib.crc32(cut.tobytes())))
            if len(rows) >= TOGETHER:
                out, number = _packed(ids, rows, limit, number, kind)
                yield out
                ids, rows = [], []
        if rows:
            yield _packed(ids, rows, limit, number, kind)[0]

    return handing_back(task)


def _merge_bins(limit: int, carried: int, full: int):
    """One group's underfull bins as items; ``up`` marks the bins that meet others at the next level."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["filled", "bin"], ascending=[False, True], ignore_index=True)
        bins, offsets, filled = best_fit(frame["filled"].to_numpy(), limit)
        order = np.argsort(bins, kind="stable")
        heads = order[np.searchsorted(bins[order], np.arange(len(filled)))]
        rank = np.empty(len(filled), np.int64)
        rank[np.argsort(filled, kind="stable")] = np.arange(len(filled))
        up = (filled < full) & (rank < carried)
        return pd.DataFrame(
            {"bin": frame["bin"], "into": frame["bin"].to_numpy()[heads][bins], "shift": offsets, "into_filled": filled[bins],
             "up": up[bins], "grp": frame["grp"]}
        )

    return merge


def pack(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str | None = None,
    limit: int = LIMIT,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: where it comes from and its place in a sequence.

    A document is its token ids and ``end_id``; only documents longer than
    ``limit`` are cut. A null or empty text is the end id alone. Ids may be
    null or repeat, since every row is packed as a document of its own. An
    empty table gives no rows. Columns besides the two named are not read.
    """
    chosen = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    task = _pack_locally(vocabulary or vocabulary_path(), limit, end_id, "doc_id", "text")
    placed = stored(chosen.mapInArrow(task, _PIECES.format(id=kind) + _PLACED), "pieces")

    bins = placed.filter(f"bin_filled < {int(limit * FULL)}").groupBy("bin").agg(F.first("bin_filled").alias("filled"))
    level = bins.selectExpr("bin", "filled", f"shiftright(bin, 32) div {FAN_IN} AS grp")
    places = None
    while True:
        merged = stored(
            level.groupBy("grp").applyInPandas(
                _merge_bins(limit, CARRIED, int(limit * FULL)),
                "bin long, into long, shift long, into_filled long, up boolean, grp long",
            ),
            "merged",
        )
        moved = merged.select("bin", "into", "shift")
        if places is None:
            places = moved
        else:
            places = places.alias("a").join(moved.alias("b"), F.expr("a.into = b.bin"), "left").selectExpr(
                "a.bin", "coalesce(b.into, a.into) AS into", "a.shift + coalesce(b.shift, 0L) AS shift"
            )
        groups = merged.agg(F.countDistinct("grp")).first()[0]
        if groups < 2:
            break
        heads = merged.filter("up AND shift = 0 AND bin = into")
        level = heads.selectExpr("bin", "into_filled AS filled", f"grp div {FAN_IN} AS grp")
    return placed.join(places, "bin", "left").selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32",
        "coalesce(into, bin) AS sequence_id", "bin_offset + coalesce(shift, 0L) AS `offset`",
    )
