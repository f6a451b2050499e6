"""Connected components of a graph of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

_MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hangs each node's greater (or lesser) neighbours on the least node it knows."""
    both = edges.union(edges.select("v", "u")) if large else edges.selectExpr("greatest(u, v)", "least(u, v)")
    both = both.toDF("u", "v")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    met = both.join(least, "u")
    if large:
        moved = met.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = met.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", "m"))
    return moved.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``u, v`` links to ``node, component``: the least node each linked node can reach.

    No node's neighbours are ever gathered: a round takes the least neighbour
    of each node and one join, and writes its edges to the shared folder.
    """
    edges = stored(links.toDF("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    for _ in range(_MOST_ROUNDS):
        edges = stored(_star(stored(_star(edges, True), "large-star"), False), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not stable after {_MOST_ROUNDS} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
