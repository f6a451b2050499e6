"""Nearest neighbours and quotation linking."""

import numpy as np
import pytest

from siltstone.llm import quotes, vptree


def _plain(ids, rows, k):
    out = {}
    for q, v in zip(ids, rows, strict=True):
        if q % 100 == 0:
            far = sorted((float(np.sqrt(((v - w) ** 2).sum())), int(i)) for i, w in zip(ids, rows, strict=True) if i != q)
            out[int(q)] = far[:k]
    return out


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(1500, 8)) + 4 * rng.normal(size=(6, 8))[rng.integers(0, 6, 1500)]
    rows[200:260] = rows[200]
    return rows.astype(np.float32)


def test_factor_one_is_exact_over_shards(spark, points):
    frame = spark.createDataFrame([(i, v.tolist(), 1, "x") for i, v in enumerate(points)], "vec_id long, embedding array<float>, rank int, score string")
    found = vptree.nearest(frame, shard_rows=400).collect()
    expected = _plain(np.arange(1500), points.astype(float), 10)
    own = {}
    for r in sorted(found, key=lambda r: r.rank):
        own.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert {q: [i for _, i in v] for q, v in own.items()} == {q: [i for _, i in v] for q, v in expected.items()}
    assert all(np.allclose([s for s, _ in own[q]], [s for s, _ in expected[q]]) for q in own)


def test_relaxed_search_visits_less_and_finds_most(points):
    tree = vptree.Tree(np.arange(1500), points.astype(float))
    queries = np.arange(0, 1500, 100)
    exact, _ = tree.search(queries, points[queries].astype(float), 10, 1.0)
    relaxed, _ = tree.search(queries, points[queries].astype(float), 10, 1.3)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(exact, relaxed, strict=True)]) >= 0.9


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0]), (100, [0.0, 0.0]), (200, None), (300, [1.0, None]), (400, [float("nan"), 1.0]),
        (500, [float("inf"), 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [9.0, 9.0]), (3, [9.0, 9.0]),
        (600, []), (700, [1.0, 2.0, 3.0]),
    ]
    found = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in sorted(found, key=lambda r: r.rank)] == [(0, 1, 1), (0, 2, 2), (0, 3, 3)]
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vptree.nearest(empty).collect() == []


@pytest.mark.parametrize("shard_rows", [400, 40])
def test_repeated_rows_take_one_place(spark, shard_rows):
    """Near rows of one id, with one vector or several at one distance, among more than ten candidates."""
    rows = [(0, [1.0, 0.0])] + [(i, [1.0 + i, 0.0]) for i in range(1, 40)]
    rows += [(1, [2.0, 0.0])] * 15 + [(i, [2.0, 0.0]) for i in range(50, 53)] + [(2, [1.0, 2.0]), (2, [1.0, -2.0]), (2, [3.0, -0.0])]
    rows += [(100, [30.0, 0.0])] * 2 + [(100, [5.0, 5.0]), (53, [30.0, 0.0]), (53, [30.0, 0.0])]
    found = vptree.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard_rows=shard_rows).collect()
    for query in (0, 100):
        pairs = {(float(np.hypot(*np.subtract(v, w))), i) for q, v in rows if q == query for i, w in rows if i != query}
        own = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == query)
        assert [i for _, i, _ in own] == [i for _, i in sorted(pairs)[:10]]
        assert np.allclose([far for *_, far in own], [far for far, _ in sorted(pairs)[:10]])


MESSAGES = [
    (1, 0, "user", "Hello there\nsecond line"),
    (1, 1, "assistant", "On Monday X wrote:\n> Hello there\n> second line\n\nMy answer"),
    (1, 2, "user", "> My answer\n>> Hello there\n> > second line\nThanks"),
    (1, 3, "user", "> nobody said\n> Hello   THERE\nok"),
    (1, 4, None, None),
    (1, 5, "user", "> Thanks\nlast"),
    (1, 5, "user", "> Thanks\nlast"),
    (None, 5, "user", "> x"),
    (2, None, "user", "a > b is no quote"),
    (3, 0, "user", ">" * 50 + " deep\n" + "word " * 20_000),
    (3, 1, "user", "We wrote:\nno quote follows"),
]


def test_quotations_are_linked(spark):
    frame = spark.createDataFrame([(*m, "p", 1) for m in MESSAGES], "conv_id long, turn long, role string, text string, path string, copy int")
    found = {(r.conv_id, r.turn): r for r in quotes.link_quotations(frame).collect()}
    assert len(found) == len(MESSAGES) - 1
    own = {k: (r.text, r.parent_turn, r.path and [int(x) for x in r.path.split("/")], r.n_quotes, r.n_unlinked) for k, r in found.items()}
    assert own[1, 0] == ("Hello there\nsecond line", None, [0], 0, 0)
    assert own[1, 1] == ("My answer", 0, [0, 1], 1, 0)
    assert own[1, 2] == ("Thanks", 1, [0, 1, 2], 2, 0)
    assert own[1, 3] == ("ok", 0, [0, 3], 1, 0)
    assert own[1, 4] == ("", None, [4], 0, 0)
    assert own[1, 5] == ("last", 2, [0, 1, 2, 5], 1, 0)
    assert own[None, 5] == ("", None, [5], 1, 1)
    assert own[2, None] == ("a > b is no quote", None, None, 0, 0)
    assert own[3, 0][3:] == (1, 1) and len(own[3, 0][0]) == 99_999
    assert own[3, 1][0] == "We wrote:\nno quote follows"
    assert quotes.link_quotations(frame.limit(0)).collect() == []


def test_linking_runs_no_python(spark):
    frame = spark.createDataFrame(MESSAGES, "conv_id long, turn long, role string, text string")
    plan = quotes.link_quotations(frame)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_turns_of_any_size_sort_as_numbers(spark):
    turns = [-(10**18), -5, -1, 0, 7, 999_999_999_999, 10**12, 10**12 + 5, 10**13 + 51, 9_223_372_036_854_775_807]
    rows = [(1, t, "user", f"own words of turn {t}") for t in turns]
    found = quotes.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    paths = {r.turn: r.path for r in found}
    assert len(set(paths.values())) == len(turns)
    assert sorted(turns, key=paths.get) == turns
    assert paths[7] == "000000000007"
