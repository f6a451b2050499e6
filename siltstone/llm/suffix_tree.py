"""Repeated word sequences by suffix trees over prefix partitions.

A task's pieces hold every window another one could equal. Their suffixes
that begin a window are split by prefix: by the first word, and, where a
group is larger than ``GROUP_SUFFIXES``, by one word more, until groups fit.
A subtree is built for each group from its prefix on, top down: the suffixes
below a node are split by their next word, a node whose suffixes all go on
alike is an edge, and a suffix alone is a leaf. The nodes that reach the depth
of a window are maximal repeats of that depth; their leaves are all places of
one word sequence. Suffixes alone are dropped as soon as they are, so most
cost one or two steps, not one for each word of a window.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from siltstone.llm.anchors import Repeats, Symbols, covered
from siltstone.llm.textbytes import expanded, word_hashes, word_spans

WORDS = 50
GRAM = 14
#: Suffixes of one subtree; a group that is one sequence of a window's depth is never split.
GROUP_SUFFIXES = 50_000


def _split(group: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by group and word, new group numbers in that order, and the size of each new group."""
    order = np.lexsort((word, group))
    group, word = group[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (group[1:] != group[:-1]) | (word[1:] != word[:-1])
    heads = np.flatnonzero(new)
    return order, np.cumsum(new) - 1, np.diff(np.append(heads, len(order)))


def prefix_groups(words: np.ndarray, starts: np.ndarray, depth: int, most: int) -> Iterator[tuple[np.ndarray, int]]:
    """Suffixes with one prefix of varying length, and that length; suffixes that are alone are left out."""
    pending = [(starts, 0)]
    while pending:
        suffixes, length = pending.pop()
        if length and (len(suffixes) <= most or length == depth):
            yield suffixes, length
            continue
        order, group, sizes = _split(np.zeros(len(suffixes), np.int64), words[suffixes + length])
        suffixes = suffixes[order]
        ends = np.cumsum(sizes)
        large = np.flatnonzero(sizes > most)
        pending += [(suffixes[ends[i] - sizes[i] : ends[i]], length + 1) for i in large.tolist()]
        # Small groups that stand together are built at once; a further word tells them apart as before.
        small = np.flatnonzero((sizes <= most) & (sizes > 1))
        batch, total = [], 0
        for i in small.tolist():
            batch.append(suffixes[ends[i] - sizes[i] : ends[i]])
            total += int(sizes[i])
            if total >= most:
                yield np.concatenate(batch), length
                batch, total = [], 0
        if batch:
            yield np.concatenate(batch), length


def deep_nodes(words: np.ndarray, suffixes: np.ndarray, length: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The subtree's nodes at ``depth``: its suffixes that are under one with another, and the node of each.

    All suffixes share their first ``length`` words.
    """
    node = np.zeros(len(suffixes), np.int64)
    for at in range(length, depth):
        if not len(suffixes):
            break
        order, child, sizes = _split(node, words[suffixes + at])
        shared = sizes[child] > 1
        suffixes, node = suffixes[order][shared], child[shared]
    return suffixes, node


def earliest_places(words: np.ndarray, starts: np.ndarray, place: np.ndarray, depth: int, most: int) -> np.ndarray:
    """The least place of each suffix's sequence of ``depth`` words among all suffixes."""
    least = np.empty(len(words), np.int64)
    least[starts] = place
    own = least.copy()
    for suffixes, length in prefix_groups(words, starts, depth, most):
        found, node = deep_nodes(words, suffixes, length, depth)
        if len(found):
            order = np.argsort(node, kind="stable")
            found, node = found[order], node[order]
            heads = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            low = np.minimum.reduceat(own[found], heads)
            least[found] = np.repeat(low, np.diff(np.append(heads, len(found))))
    return least[starts]


def _solve(depth: int, pieces: list[bytes], docs: list[tuple], start: np.ndarray) -> np.ndarray:
    data = np.frombuffer(b"".join(pieces), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    begins, ends, first = word_spans(data, offsets)
    words = np.unique(word_hashes(data, begins, ends), return_inverse=True)[1]
    windows = np.diff(first) - depth + 1
    # Sequences count as earlier by the document alone, not by where they stand in it.
    rank = {key: i for i, key in enumerate(sorted({doc[0] for doc in docs}))}
    place = np.repeat(np.array([rank[doc[0]] for doc in docs], np.int64), windows)
    return earliest_places(words, expanded(first[:-1], windows), place, depth, GROUP_SUFFIXES) < place


def _finish(width: int, texts: list[bytes], runs: list[list[tuple[int, int]]]) -> list[pa.Array]:
    size, removed, digests = [], [], []
    for text, own in zip(texts, runs, strict=True):
        words = text.split()
        kept, at = [], 0
        for begin, stop in covered(own, width):
            kept += words[at:begin]
            at = stop
        kept += words[at:]
        size.append(len(words))
        removed.append(len(words) - len(kept))
        digests.append(sha256(b" ".join(kept)).hexdigest())
    return [pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]


def _other_document(places: pa.Table, firsts: pa.Table) -> np.ndarray:
    """Whether each window's document has a greater id than the first one of its name."""
    return pc.greater(places.column("id"), firsts.column("id")).to_numpy(zero_copy_only=False)


def remove_repeated_words(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS
) -> DataFrame:
    """One row per document: how many of its words repeat an earlier document, and what is left.

    A word goes if a run of ``words`` words that covers it also starts in a
    document with a smaller id. Words are unchanged stretches between white
    space; runs are judged on the input. A null text has no words. Rows that
    share an id never take words from each other. A row without an id keeps
    its text and takes nothing from others. An empty table gives no rows.
    Columns besides the two named are not read.
    """
    return Repeats(
        Symbols(words, min(GRAM, words), True),
        partial(_solve, words),
        "id > first_id",
        _other_document,
        partial(_finish, words),
        "n_words long, n_removed long, kept_sha256 string",
    ).apply(documents, id_column, text_column)
