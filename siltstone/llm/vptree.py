"""Nearest neighbours by vantage-point trees, one per shard.

Rows are dealt to shards by their ids. A shard's task builds its tree, then
the queries stream past it in batches, so a task holds one shard and one
batch. A node keeps the distance range of each half from its vantage point; by
the triangle inequality a half whose range lies farther from the query's own
distance than the best found so far cannot hold a nearer row. The bound is
relaxed by ``factor``: a half is skipped once its least possible distance
times the factor exceeds the current tenth-best. Factor one skips only what
cannot matter, and the search is exact; above one it may miss neighbours that
are less than that factor nearer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

NEIGHBOURS = 10
SHARD_ROWS = 16_384
LEAF_ROWS = 96
#: Queries that walk a tree together.
BATCH = 512


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distance of each row to each query (a column each), summed over components in order."""
    total = np.zeros((len(rows), len(query)))
    for i in range(rows.shape[1]):
        apart = rows[:, i : i + 1] - query[:, i]
        total += apart * apart
    return np.sqrt(total)


def _few_copies(ids: np.ndarray, rows: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the rows without all but the ``most`` smallest ids of each vector, each id once."""
    # Adding zero makes one of both signs of it.
    keys = np.ascontiguousarray(rows + 0.0).view(np.dtype((np.void, rows.dtype.itemsize * rows.shape[1]))).ravel()
    vector = np.unique(keys, return_inverse=True)[1].ravel()
    order = np.lexsort((ids, vector))
    repeated = (vector[order][1:] == vector[order][:-1]) & (ids[order][1:] == ids[order][:-1])
    order = order[np.append(True, ~repeated)]
    same = vector[order]
    heads = np.flatnonzero(np.append(True, same[1:] != same[:-1]))
    number = np.arange(len(same)) - np.repeat(heads, np.diff(np.append(heads, len(same))))
    return np.sort(order[number < most])


class Tree:
    """A vantage-point tree over rows, as nested tuples over index ranges of one permutation.

    Rows that repeat an id with one vector count once, so they take one place. Of copies of one vector only the ``copies`` smallest ids are kept. With
    one more than the neighbours asked for, no other copy can be among them.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, copies: int = NEIGHBOURS + 1) -> None:
        kept = _few_copies(ids, rows, copies)
        self.ids, self.rows = ids[kept], rows[kept]
        self.squares = (self.rows * self.rows).sum(1)
        ids = self.ids
        self.order = np.arange(len(ids))
        self.root = self._build(0, len(ids))

    def _build(self, start: int, stop: int):
        if stop - start <= LEAF_ROWS:
            return (start, stop)
        own = self.order[start:stop]
        # The row farthest from the first one is at the rim, where distances spread most.
        first = distances(self.rows[own], self.rows[own[:1]])[:, 0]
        vantage = own[int(first.argmax())]
        far = distances(self.rows[own], self.rows[vantage][None])[:, 0]
        rank = np.argsort(far, kind="stable")
        self.order[start:stop], far = own[rank], far[rank]
        half = (stop - start) // 2
        if far[0] == far[-1]:
            # All at one distance: no half can be told from the other.
            return (start, stop)
        ranges = np.array([[far[0], far[half - 1]], [far[half], far[-1]]])
        return (vantage, ranges, self._build(start, start + half), self._build(start + half, stop))

    def search(self, ids: np.ndarray, query: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest of each query, itself left out; -1 and infinity where there are fewer."""
        best = np.full((len(ids), k), np.inf)
        names = np.full((len(ids), k), np.iinfo(np.int64).max)
        every = np.arange(len(ids))
        # Each query's own leaf first, so that there is a bound to prune by; then every node once for all queries.
        met = np.full(len(ids), -1)
        self._descend(self.root, every, ids, query, best, names, met)
        self._visit(self.root, every, ids, query, best, names, met, factor)
        return np.where(np.isinf(best), -1, names), best

    def _least(self, node, active, query) -> np.ndarray:
        """Least possible distance of each query to either half, a little less for rounding."""
        vantage, ranges = node[:2]
        own = distances(self.rows[vantage][None], query[active])[0]
        return np.maximum(np.maximum(ranges[:, :1] - own, own - ranges[:, 1:]), 0) * (1 - 1e-12) - 1e-12

    def _descend(self, node, active, ids, query, best, names, met) -> None:
        if len(node) == 2:
            met[active] = node[0]
            self._leaf(node, active, ids, query, best, names)
            return
        nearer = self._least(node, active, query).argmin(0)
        for side in (0, 1):
            if (nearer == side).any():
                self._descend(node[2 + side], active[nearer == side], ids, query, best, names, met)

    def _visit(self, node, active, ids, query, best, names, met, factor) -> None:
        if len(node) == 2:
            self._leaf(node, active[met[active] != node[0]], ids, query, best, names)
            return
        least = self._least(node, active, query) * factor
        for side in (0, 1):
            mine = active[least[side] <= best[active, -1]]
            if len(mine):
                self._visit(node[2 + side], mine, ids, query, best, names, met, factor)

    def _leaf(self, node, active, ids, query, best, names) -> None:
        if len(active):
            for start in range(node[0], node[1], 4_096):
                self._scan(self.order[start : min(start + 4_096, node[1])], active, ids, query, best, names)

    def _scan(self, rows, active, ids, query, best, names) -> None:
        """Rows that may be among a query's best are picked by squares and products, and only these measured."""
        own, asked = self.rows[rows], query[active]
        squares = self.squares[rows] + (asked * asked).sum(1)[:, None]
        # Far above what rounding can do to the difference.
        bound = best[active, -1] ** 2
        near = squares - 2 * (asked @ own.T) <= bound[:, None] * (1 + 1e-9) + 1e-9 * squares
        near &= self.ids[rows] != ids[active][:, None]
        q, r = np.nonzero(near)
        if not len(q):
            return
        total = np.zeros(len(q))
        for i in range(own.shape[1]):
            apart = own[r, i] - asked[q, i]
            total += apart * apart
        k = best.shape[1]
        changed = np.unique(q)
        place = active[changed]
        group = np.concatenate([np.searchsorted(changed, q), np.repeat(np.arange(len(changed)), k)])
        far = np.concatenate([np.sqrt(total), best[place].ravel()])
        name = np.concatenate([self.ids[rows][r], names[place].ravel()])
        order = np.lexsort((name, far, group))
        # An id found at one distance by several of its vectors is one neighbour and takes one place.
        last, then = order[:-1], order[1:]
        repeated = (group[then] == group[last]) & (name[then] == name[last]) & (far[then] == far[last]) & np.isfinite(far[then])
        order = order[np.append(True, ~repeated)]
        heads = np.searchsorted(group[order], np.arange(len(changed)))
        first = order[heads[:, None] + np.arange(k)]
        best[place], names[place] = far[first], name[first]


def _search(k: int, factor: float, size: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by shard, the shard's own rows before the queries."""
        shard, tree, ids, rows = None, None, [], []
        for batch in batches:
            parts = batch.column("shard").to_numpy()
            asked = batch.column("is_query").to_numpy(zero_copy_only=False)
            names = batch.column("vec_id").to_numpy()
            values = batch.column("vector").flatten().to_numpy().astype(np.float64).reshape(-1, size)
            cuts = np.flatnonzero((np.diff(parts) != 0) | (np.diff(asked.astype(int)) != 0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(parts)], strict=True):
                if start == stop:
                    continue
                if parts[start] != shard:
                    shard, tree, ids, rows = parts[start], None, [], []
                if not asked[start]:
                    ids.append(names[start:stop])
                    rows.append(values[start:stop])
                    continue
                if not ids:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(ids), np.concatenate(rows), k + 1)
                for at in range(start, stop, BATCH):
                    own = slice(at, min(at + BATCH, stop))
                    found, far = tree.search(names[own], values[own], k, factor)
                    full = ~np.isinf(far)
                    query = np.repeat(names[own], full.sum(1))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(query), pa.array(found[full]), pa.array(far[full])], ["query_id", "vec_id", "score"]
                    )

    return task


def nearest(
    vectors: DataFrame,
    queries: str = "vec_id % 100 = 0",
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = NEIGHBOURS,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """The k nearest rows of every row that meets ``queries``, by Euclidean distance in double precision.

    Nearest first, ties to the smaller id; a query never finds a row of its
    own id. Rows without an id take no part, nor do vectors that are null,
    empty, zero or hold null or non-finite components. Where lengths differ, a
    query is compared with vectors of its own length. Rows that repeat an id
    with one vector count once, as do vectors of one id at one distance. An empty table gives no rows. Other columns
    are not read.
    """
    chosen = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    usable = chosen.filter(
        "vec_id IS NOT NULL AND size(vector) > 0 "
        "AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        "AND exists(vector, x -> x <> 0)"
    )
    usable = stored(usable, "vectors")
    found = None
    for size, rows in sorted(usable.groupBy(F.size("vector").alias("size")).count().collect()):
        part = usable.filter(F.size("vector") == size)
        shards = -(-rows // shard_rows)
        own = part.selectExpr(f"pmod(xxhash64(vec_id), {shards}) AS shard", "false AS is_query", "vec_id", "vector")
        # Every shard has to see every query: the stated query set against all rows, in shards.
        asked = part.filter(queries.replace(id_column, "vec_id")).selectExpr(
            f"explode(sequence(0L, {shards}L - 1)) AS shard", "true AS is_query", "vec_id", "vector"
        )
        dealt = own.union(asked).repartition(shards, "shard").sortWithinPartitions("shard", "is_query", "vec_id")
        part_found = dealt.mapInArrow(_search(k, factor, size), "query_id long, vec_id long, score double")
        found = part_found if found is None else found.union(part_found)
    if found is None:
        found = usable.selectExpr("vec_id AS query_id", "vec_id", "double(0) AS score")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
