"""Repeated bytes and words against plain forms."""

import random
import sys
import tracemalloc

import numpy as np
import pytest

from siltstone.llm import anchors, suffix_array, suffix_tree, textbytes
from siltstone.llm.textbytes import mixed, prefix_sums, sliding_minimum, window_hashes
from tests.llm.brute import repeated_bytes, repeated_words


def _texts(seed, n=60):
    """Texts that share passages, are periodic, short, empty, null, or copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(rng.randint(20, 90)) for _ in range(6)]
    out = []
    for i in range(n):
        parts = [prose(rng.randint(0, 60)), rng.choice(passages), prose(rng.randint(0, 40)), rng.choice(passages)]
        out.append(rng.choice([" ", "\n", "\t "]).join(parts[: rng.randint(1, 4)]))
        if i % 9 == 0:
            out[-1] = rng.choice(["ab", "x y ", "é"]) * rng.randint(40, 120)
        if i % 13 == 5:
            out[-1] = out[rng.randrange(i)]
    return [*enumerate(out), (1000, None), (1001, ""), (1002, " \n"), (1003, "\x00" * 130), (1004, "z" * 300)]


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(documents, seed):
    rows = _texts(seed)
    random.Random(seed).shuffle(rows)
    found = suffix_array.remove_repeated_bytes(documents(rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_bytes(rows, 100)


def test_words_against_brute_force(documents):
    rows = _texts(3)
    found = suffix_tree.remove_repeated_words(documents(rows), words=20).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_words(rows, 20)


def _common_line(n):
    """A line that is in all texts with other words around it, some of them copies, and some texts without it."""
    rng = random.Random(5)
    line = "this line stands in every text of the table and is long enough to be found and a hundred and thirty bytes long, or even longer "
    rows = [(i, f"{rng.random()} {line * rng.choice([1, 1, 2])} {rng.random()}") for i in range(n)]
    rows += [(n + i, rows[i * 7 % n][1]) for i in range(n // 10)] + [(2 * n + i, f"{rng.random()}") for i in range(20)]
    rng.shuffle(rows)
    return rows


def test_hot_anchors_go_by_window():
    """One by one, in this process."""
    symbols = anchors.Symbols(60, 32, False)
    texts = [t.encode() for _, t in _common_line(30)]
    data = anchors.pa.array(texts, anchors.pa.binary())
    _, _, _, first, hashes = symbols.read(data)
    anchor = np.unique(symbols.runs(first, hashes)[3])
    payload = anchors._pack(anchors.pa.table({"id": list(range(len(texts))), "text": data}))
    told = [{"anchors": anchor.tobytes(), "hot": np.ones(len(anchor), bool).tobytes()}]
    own = anchors._read(symbols, payload, told)
    assert not len(own.cold[0]) and own.hot[2].sum() == sum(max(len(t) - 59, 0) for t in texts)
    batch = anchors.pa.RecordBatch.from_pylist([{"slice": 5, "payload": payload, "told": told}])
    (named,) = anchors._hot_windows(symbols, 1, iter([batch]))
    (answer,) = anchors._hot_firsts(iter([named]))
    seen, expected = {}, set()
    for i, t in enumerate(texts):
        for s in range(len(t) - 59):
            if seen.setdefault(t[s : s + 60], (i, s)) != (i, s):
                expected.add((i, s))
    repeats = suffix_array.Repeats(symbols, None, "", suffix_array._other_place, None, "")
    runs = anchors._hot_runs(repeats, 5, anchors._unpack(payload), answer.column("firsts").to_pylist())
    assert {(doc, s) for doc, begin, stop in runs for s in range(begin, stop)} == expected


def test_a_common_line_end_to_end(documents):
    """More texts with one line than an anchor may have runs."""
    rows = _common_line(anchors.HOT + 200)
    found = suffix_array.remove_repeated_bytes(documents(rows)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_bytes(rows, 100)
    found = suffix_tree.remove_repeated_words(documents(rows), words=12).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_words(rows, 12)


def test_repeated_ids_null_ids_and_nothing(spark, documents):
    passage = "one two three four five six seven eight nine ten " * 4
    rows = [(None, passage), (5, passage), (5, passage), (5, "own " + passage), (7, passage)]
    by_bytes = suffix_array.remove_repeated_bytes(documents(rows)).collect()
    assert len(by_bytes) == 5
    kept = {r.n_removed for r in by_bytes if r.doc_id is None}
    assert kept == {0}
    assert next(r.n_removed for r in by_bytes if r.doc_id == 7) == len(passage)
    by_words = suffix_tree.remove_repeated_words(documents(rows), words=10).collect()
    assert all(r.n_removed == 0 for r in by_words if r.doc_id in (None, 5))
    assert next(r for r in by_words if r.doc_id == 7).n_removed == 40
    empty = documents([]).filter("false")
    assert suffix_array.remove_repeated_bytes(empty).collect() == []
    assert suffix_tree.remove_repeated_words(empty).collect() == []


@pytest.mark.parametrize("buckets", [1, 3, 1024])
def test_suffix_array(monkeypatch, buckets):
    monkeypatch.setattr(suffix_array, "BUCKETS", buckets)
    rng = np.random.default_rng(buckets)
    for _ in range(60):
        size = int(rng.integers(2, 6))
        text = np.append(rng.integers(1, size, int(rng.integers(0, 60))), 0)
        expected = sorted(range(len(text)), key=lambda i: text[i:].tolist())
        assert suffix_array.suffix_array(text, size, 1000).tolist() == expected


def test_common_prefixes():
    text = np.frombuffer(b"abracadabra abracadabra abracad\0", np.uint8)
    order = suffix_array.suffix_array(text.astype(np.int64), 256, 1000)
    shared = suffix_array.common_prefixes(text, order, 10)
    for before, at in zip(order, order[1:], strict=False):
        a, b = text[before:].tobytes(), text[at:].tobytes()
        plain = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert shared[at] == min(plain, 10)


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_subtrees_find_equal_sequences(most):
    rng = np.random.default_rng(most)
    words = rng.integers(0, 3, 400)
    starts = np.arange(390)
    place = rng.permutation(390)
    least = suffix_tree.earliest_places(words, starts, place, 8, most)
    best = {}
    for s, p in zip(starts, place, strict=True):
        key = tuple(words[s : s + 8])
        best[key] = min(best.get(key, 1 << 60), p)
    assert least.tolist() == [best[tuple(words[s : s + 8])] for s in starts]


def thue_morse(length):
    """A word of "a" and "b" and its complement; sums of powers modulo 2 ** 64 take them as equal from 1,024 on."""
    bits = [bin(i).count("1") % 2 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_long_words_alike_in_sums_of_powers_are_told_apart(documents):
    one, other = thue_morse(2_048)
    rows = [(i, " ".join(f"{w}{i}" for i in range(25))) for i, w in ((1, one), (2, other), (3, one))]
    found = suffix_tree.remove_repeated_words(documents(rows), words=20).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repeated_words(rows, 20)
    assert {r.doc_id: r.n_removed for r in found} == {1: 0, 2: 0, 3: 25}


def test_windows_of_texts_of_any_size():
    dice = np.random.default_rng(7)
    for width, gram in ((10, 4), (7, 7)):
        symbols = anchors.Symbols(width, gram, False)
        for _ in range(200):
            sizes = dice.integers(0, 30, 6) * dice.integers(0, 2, 6)
            first = np.append(0, np.cumsum(sizes))
            data = dice.integers(0, 2, first[-1]).astype(np.uint8)
            counts, inside = symbols.windows(first)
            assert counts.tolist() == [max(n - width + 1, 0) for n in sizes]
            begins = [b + i for b, n in zip(first.tolist(), counts.tolist(), strict=False) for i in range(n)]
            assert np.flatnonzero(inside).tolist() == begins
            text, start, length, _ = symbols.runs(first, data)
            found = [first[t] + s + i for t, s, n in zip(text, start, length, strict=True) for i in range(n)]
            assert found == begins


def _peak(action):
    tracemalloc.start()
    try:
        made = action()
        return made.nbytes, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_hashes_are_made_without_copies_of_the_whole():
    data = np.random.default_rng(3).integers(0, 256, 200_000).astype(np.uint8)
    sums = prefix_sums(data)
    for action in (lambda: prefix_sums(data), lambda: window_hashes(sums, 32), lambda: sliding_minimum(sums, 69)):
        made, peak = _peak(action)
        assert peak < 1.6 * made + (1 << 18)
    for i in (0, 16_383, 16_384, 199_000):
        value = (int(sums[i + 32]) - int(sums[i])) * pow(textbytes._INVERSE, i, 1 << 64) % (1 << 64)
        assert window_hashes(sums, 32)[i] == mixed(np.array([value], np.uint64))[0]
    assert sliding_minimum(sums, 69).tolist() == np.lib.stride_tricks.sliding_window_view(sums, 69).min(axis=1).tolist()


def test_a_pass_over_a_bucket_takes_few_calls():
    rng = np.random.default_rng(4)
    text = np.append(rng.integers(1, 257, 20_000), 0)
    calls = 0

    def count(frame, event, argument):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        array = suffix_array.suffix_array(text, 257, 100)
    finally:
        sys.setprofile(None)
    # Two inductions of two passes over 256 buckets, and a few rounds in each.
    assert calls < 40_000, calls
    raw = text.astype(">u2").tobytes()
    assert array.tolist() == sorted(range(len(text)), key=lambda i: raw[2 * i : 2 * i + 200])
