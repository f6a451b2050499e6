"""Repeated byte strings by suffix arrays that are built by induced sorting.

Shards are sets of pieces that hold every window another one could equal. A
shard's text is classified into S and L suffixes; its leftmost S suffixes are
brought into order, first as substrings by inducing, then, where substrings
repeat, as suffixes of the string of their names; and all other suffixes are
induced from them in two linear passes. The passes go bucket by bucket, and
all of a bucket's suffixes that are known move their predecessors at once.
Common prefixes with the predecessor in the array are computed in text order,
eight bytes at a step, as far as the length in question.
"""

from __future__ import annotations

from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from siltstone.llm.anchors import Repeats, Symbols, covered
from siltstone.llm.textbytes import expanded, prefix_sums, span_hashes

LENGTH = 100
GRAM = 32
#: A string of names with more symbols than this is sorted by doubling names, not by buckets.
BUCKETS = 1_024


def _kinds(text: np.ndarray) -> np.ndarray:
    """True for each S suffix: less than the one behind it. The last symbol is the least and stands alone."""
    step = np.sign(np.diff(text.astype(np.int64)))
    # Within a stretch of one symbol, what follows the stretch decides.
    place = np.where(step != 0, np.arange(len(step)), len(step))
    following = np.minimum.accumulate(place[::-1])[::-1]
    return np.append(np.append(step, 1)[following] > 0, True)


def _induce(text: np.ndarray, s_kind: np.ndarray, leftmost: np.ndarray, size: int) -> np.ndarray:
    """The array of all suffixes from the leftmost S suffixes in order."""
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    begins = ends - counts
    if size <= 1 << 16:
        text = text.astype(np.uint16)
    array = np.full(len(text), -1, np.int64)
    steps = np.arange(len(text))

    def send(found: np.ndarray, free: np.ndarray, way: int) -> None:
        """Appends suffixes to their buckets' free places, upwards or downwards."""
        at = text[found]
        n = np.bincount(at, minlength=size)
        if len(found) == 1:
            array[free[at]] = found
        elif len(found):
            # A stable order; sixteen bits are sorted by radix.
            order = at.argsort(kind="stable")
            heads = n.cumsum() - n
            array[(free - way * heads)[at[order]] + way * steps[: len(found)]] = found[order]
        free += way * n

    lms = np.bincount(text[leftmost], minlength=size)
    send(leftmost, ends - lms, 1)

    free = begins.copy()
    for symbol in np.flatnonzero(counts).tolist():
        done = begins[symbol]
        while done < free[symbol]:
            known, done = array[done : free[symbol]], free[symbol]
            before = known[known > 0] - 1
            send(before[~s_kind[before]], free, 1)
        known = array[ends[symbol] - lms[symbol] : ends[symbol]]
        before = known[known > 0] - 1
        send(before[~s_kind[before]], free, 1)
    l_ends = free
    free = ends - 1
    for symbol in np.flatnonzero(counts)[::-1].tolist():
        done = ends[symbol] - 1
        while done > free[symbol]:
            known, done = array[free[symbol] + 1 : done + 1][::-1], free[symbol]
            before = known[known > 0] - 1
            send(before[s_kind[before]], free, -1)
        known = array[begins[symbol] : l_ends[symbol]][::-1]
        before = known[known > 0] - 1
        send(before[s_kind[before]], free, -1)
    return array


def _doubled(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes by their first ``depth`` names at least."""
    rank, reach, n = names.astype(np.int64), 1, len(names)
    while True:
        key = rank * (n + 1)
        key[: n - reach] += rank[reach:] + 1
        order = np.argsort(key)
        ranked = key[order]
        new = np.zeros(n, np.int64)
        new[1:] = ranked[1:] != ranked[:-1]
        fresh = np.cumsum(new)
        reach *= 2
        if fresh[-1] == n - 1 or reach >= min(depth, n):
            return order
        rank = np.empty(n, np.int64)
        rank[order] = fresh


def suffix_array(text: np.ndarray, size: int, depth: int) -> np.ndarray:
    """Suffixes in order of their first ``depth`` symbols at least.

    Symbols are below ``size``; the last one is 0 and occurs nowhere else.
    """
    if len(text) < 3:
        return np.arange(len(text))[::-1]
    s_kind = _kinds(text)
    leftmost = np.flatnonzero(s_kind[1:] & ~s_kind[:-1]) + 1
    if not len(leftmost):
        return _induce(text, s_kind, leftmost, size)
    # Inducing from any order sorts the substrings from one leftmost S suffix to the next.
    array = _induce(text, s_kind, leftmost, size)
    is_leftmost = np.zeros(len(text), bool)
    is_leftmost[leftmost] = True
    ordered = array[is_leftmost[array]]
    stops = np.append(leftmost[1:] + 1, len(text))
    number = np.empty(len(text), np.int64)
    number[leftmost] = np.arange(len(leftmost))
    hashes = span_hashes(prefix_sums(text), leftmost, stops)
    own = number[ordered]
    lengths = (stops - leftmost)[own]
    new = np.zeros(len(own), np.int64)
    new[1:] = (hashes[own][1:] != hashes[own][:-1]) | (lengths[1:] != lengths[:-1])
    names = np.empty(len(leftmost), np.int64)
    names[own] = np.cumsum(new)
    count = int(names.max()) + 1
    if count == len(leftmost):
        return _induce(text, s_kind, ordered, size)
    # A name spans two symbols at least, one of them its own.
    if count <= BUCKETS:
        order = suffix_array(names, count, depth)
    else:
        order = _doubled(names, depth)
    return _induce(text, s_kind, leftmost[order], size)


def common_prefixes(text: np.ndarray, array: np.ndarray, most: int) -> np.ndarray:
    """For each place of the text, what its suffix shares with the one before it in the array, up to ``most``."""
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    padded = np.zeros(n + most + 16, np.uint8)
    padded[:n] = text
    words = np.zeros(n + most + 8, np.uint64)
    for i in range(8):
        words |= padded[i : i + len(words)].astype(np.uint64) << np.uint64(8 * i)
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for step in range(0, most, 8):
        differ = words[active + step] ^ words[before[active] + step]
        same = differ == 0
        low = differ[~same]
        # The lowest differing bit is in the first differing byte.
        bit = np.log2((low & (~low + np.uint64(1))).astype(np.float64)).astype(np.int64)
        shared[active[~same]] = step + bit // 8
        active = active[same]
        shared[active] = step + 8
    return np.minimum(shared, most)


def earlier_windows(pieces: list[bytes], place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Flags of all windows of the pieces that another one equals at a smaller place, and each piece's first flag.

    ``place`` is that of each piece's first window; later windows follow it.
    """
    # Bytes move up by one to make room for the end mark.
    joined = np.frombuffer(b"\0".join(pieces), np.uint8)
    symbols = np.append(joined.astype(np.int64) + 1, 0)
    lengths = np.array([len(p) for p in pieces], np.int64)
    begins = np.cumsum(lengths + 1) - lengths - 1
    windows = lengths - width + 1
    array = suffix_array(symbols, 257, width)
    shared = common_prefixes(np.append(joined, 0), array, width)

    valid = np.zeros(len(symbols), bool)
    starts = expanded(begins, windows)
    valid[starts] = True
    own = np.zeros(len(symbols), np.int64)
    own[starts] = expanded(place, windows)
    ordered = array[valid[array]]
    bounds = np.concatenate([[0], np.cumsum(windows)])
    # Equal windows share a group; a suffix that runs over a piece's end may stand among them.
    group = np.cumsum(shared[array] < width)[valid[array]]
    new = np.ones(len(ordered), bool)
    new[1:] = group[1:] != group[:-1]
    heads = np.flatnonzero(new)
    least = np.minimum.reduceat(own[ordered], heads)
    earliest = np.empty(len(symbols), np.int64)
    earliest[ordered] = np.repeat(least, np.diff(np.append(heads, len(ordered))))
    return earliest[starts] < own[starts], bounds


def _solve(width: int, pieces: list[bytes], docs: list[tuple], start: np.ndarray) -> np.ndarray:
    rank = {doc: i for i, doc in enumerate(sorted(set(docs)))}
    return earlier_windows(pieces, np.array([rank[d] for d in docs], np.int64) << 40 | start, width)[0]


def _finish(width: int, texts: list[bytes], runs: list[list[tuple[int, int]]]) -> list[pa.Array]:
    removed, spans, digests = [], [], []
    for text, own in zip(texts, runs, strict=True):
        stretches = covered(own, width)
        kept, at = sha256(), 0
        for begin, stop in stretches:
            kept.update(text[at:begin])
            at = stop
        kept.update(text[at:])
        removed.append(sum(stop - begin for begin, stop in stretches))
        spans.append(len(stretches))
        digests.append(kept.hexdigest())
    sizes = [len(text) for text in texts]
    return [*(pa.array(x, pa.int64()) for x in (sizes, removed, spans)), pa.array(digests, pa.string())]


def _other_place(places: pa.Table, firsts: pa.Table) -> np.ndarray:
    """Whether each window starts elsewhere than the first one of its name."""
    pairs = [(places.column(c).to_numpy(), firsts.column(c).to_numpy()) for c in ("slice", "doc", "start")]
    return np.logical_or.reduce([own != first for own, first in pairs])


def remove_repeated_bytes(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per document: how many bytes repeated strings take, in how many stretches, and what is left.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a document with a smaller id, or before in the same one.
    Strings are judged on the input. A null text is empty. Rows that share an
    id are documents one after the other. A row without an id has no place in
    the order: it keeps its text and takes nothing from others. An empty table
    gives no rows. Columns besides the two named are not read.
    """
    return Repeats(
        Symbols(length, min(GRAM, length), False),
        partial(_solve, length),
        "NOT (slice = first_slice AND doc = first_doc AND start = first_start)",
        _other_place,
        partial(_finish, length),
        "n_bytes long, n_removed long, n_spans long, kept_sha256 string",
    ).apply(documents, id_column, text_column)
