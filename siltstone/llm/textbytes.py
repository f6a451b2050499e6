"""Texts of an Arrow batch as one byte array: slices, words and hashes.

Shared by the operators that work on bytes or words inside Arrow tasks. Every
function is vectorised over a slice of whole texts; a slice ends before the
text that would take it over its size, so memory follows the slice size and
the longest single text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_U = np.uint64


def text_slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of whole rows, each of about ``size`` text bytes."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def joined_slices(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """All batches in runs of whole rows, each of ``size`` text bytes at most or one row; short batches are put together."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        for part in text_slices(batch, column, size):
            own = pc.sum(pc.binary_length(part.column(column))).as_py() or 0
            if held and total + own > size:
                yield pa.concat_batches(held)
                held, total = [], 0
            held.append(part)
            total += own
    if held:
        yield pa.concat_batches(held)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row, and where each begins (one more entry); null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
    data = pc.fill_null(texts.cast(kind), b"")
    lengths = pc.binary_length(data).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = np.zeros(len(data) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    buffer = b"".join(data.to_pylist())
    return np.frombuffer(buffer, np.uint8), offsets


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end byte of each ``[^\\x20\\x09-\\x0D]+`` word, and for each text its first word (one more entry)."""
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # A text's first and last byte bound a word whatever stands in the next text.
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    begins, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return begins, ends, np.searchsorted(begins, offsets)


#: Values that are worked on together, so that they stay in the processor's cache from step to step.
_NEAR = 1 << 14


def _mix(values: np.ndarray) -> None:
    shifted = values >> _U(30)
    values ^= shifted
    values *= _U(0xBF58476D1CE4E5B9)
    np.right_shift(values, _U(27), out=shifted)
    values ^= shifted
    values *= _U(0x94D049BB133111EB)
    np.right_shift(values, _U(31), out=shifted)
    values ^= shifted


def mixed(values: np.ndarray) -> np.ndarray:
    """Each 64-bit value scrambled, one to one."""
    values = np.array(values, _U)
    for low in range(0, len(values), _NEAR):
        _mix(values[low : low + _NEAR])
    return values


class _Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, _U)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, factor in (("up", _BASE), ("down", _INVERSE)):
                table = np.full(size, factor, _U)
                table[0] = 1
                setattr(self, name, np.cumprod(table))


_POWERS = _Powers()


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    """Sums S with which ``window_hashes`` hashes any stretch of the symbols; arithmetic is modulo 2**64."""
    _POWERS.reach(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, _U)
    for low in range(0, len(symbols), _NEAR):
        own = sums[low + 1 : low + 1 + _NEAR]
        np.add(symbols[low : low + _NEAR], _U(1), out=own, dtype=_U, casting="unsafe")
        own *= _POWERS.up[low : low + len(own)]
    return np.cumsum(sums, out=sums)


def span_hashes(sums: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch; equal stretches hash alike wherever they stand."""
    return mixed((sums[ends] - sums[begins]) * _POWERS.down[begins])


def window_hashes(sums: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every stretch of ``width`` symbols."""
    n = len(sums) - width
    if n <= 0:
        return np.zeros(0, _U)
    out = np.empty(n, _U)
    for low in range(0, n, _NEAR):
        own = out[low : low + _NEAR]
        np.subtract(sums[low + width : low + width + len(own)], sums[low : low + len(own)], out=own)
        own *= _POWERS.down[low : low + len(own)]
        _mix(own)
    return out


def word_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes.

    Each byte is scrambled together with its place in the word and these are
    added up. Words can be of any length, and sums of powers, as above, are
    equal for certain pairs of 1,024 bytes or more.
    """
    if not len(begins):
        return np.zeros(0, _U)
    lengths = ends - begins
    heads = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(heads, lengths)
    values = mixed(data[expanded(begins, lengths)].astype(_U) + (place.astype(_U) << _U(8)) + _U(_BASE))
    return mixed(np.add.reduceat(values, heads) + lengths.astype(_U))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    out = np.empty(max(len(values) - width + 1, 0), values.dtype)
    for low in range(0, len(out), _NEAR):
        done, least = 1, values[low : low + _NEAR + width - 1]
        while done * 2 <= width:
            least = np.minimum(least[:-done], least[done:])
            done *= 2
        if rest := width - done:
            least = np.minimum(least[:-rest], least[rest:])
        out[low : low + _NEAR] = least
    return out


def expanded(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes of all stretches, one stretch after the other."""
    total = int(lengths.sum())
    steps = np.arange(total, dtype=np.int64)
    before = np.cumsum(lengths) - lengths
    return steps + np.repeat(begins - before, lengths)
