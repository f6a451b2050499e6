"""A Merkle manifest of a table, and proofs that climb it by a recursive query.

Every row is a leaf. The leaves of a source, in order of their ids, are hashed
together three at a time until one digest, the subroot, is left; the subroots
in order of their sources give the root in the same way. Each inner node is a
stored row: its children's digests, and a link to its parent. A recursive
query then starts at all leaves at once and goes up these links; each step
appends the siblings it met to the proof and folds the leaf's digest, taken of
the tampered row where there is one, with them. Every step sends all leaves once,
so it takes ``STRIDE`` levels: the rows it stops at have the siblings of the
next levels beside their children, and are linked to the ancestor above these.

Near the root all leaves would meet in one node row. So a node row is kept
once per block of ``BLOCK`` neighbouring leaves below it, and a leaf joins its
own block's copy: no key has more than ``BLOCK`` leaves, whatever the source,
and the copies of a level are no more than its nodes and the blocks together.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

#: Children of a node.
RUN = 3
#: Levels that a step of the climb takes.
STRIDE = 3
#: Leaves that share their copies of the nodes above them.
BLOCK = 2_048
#: The fields of a leaf, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

# A node's number: the first leaf (or subroot) below it, and a code of seven bits for tree and height.
_HEIGHTS = 128
_TOP = 64
_NO_SIBLINGS = "CAST('' AS BINARY)"


def _digest(columns: str) -> str:
    """SQL for the digest, as 32 bytes, of the hexadecimal texts of digests."""
    return f"unhex(sha2(lower(hex({columns})), 256))"


def leaf_digest(*fields: str) -> str:
    """SQL for a row's digest: ``-`` per null, else the length in bytes, a colon and the value."""
    parts = [f"coalesce(concat(octet_length({f}), ':', {f}), '-')" for f in fields]
    return f"unhex(sha2(concat({', '.join(parts)}), 256))"


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """The rows with their place in the order of all: ``at`` from 0, and by group ``tree`` (the
    ``at`` of its first row), ``pos`` in it, ``n`` rows of it, and ``rank`` of it among groups.

    Sorted by ranges; only the number of rows per task and group is gathered
    up, so no group is one task's. Equal rows are told apart by where they
    are stored, so that copies of one row can be dealt to several tasks.
    """
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    ranges = keyed.repartitionByRange(group, *order, "_row").sortWithinPartitions(group, *order, "_row")
    placed = ranges.withColumn("_place", F.monotonically_increasing_id()).withColumn("_task", F.spark_partition_id())
    placed = stored(placed.drop("_row"), name)
    counted = placed.groupBy("_task", F.col(group).alias("_group")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    counted = stored(counted, f"{name}-counts")
    # One row per task: a window without keys over these is a few bytes for each.
    tasks = counted.groupBy("_task").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_groups"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = tasks.select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"))
    within = Window.partitionBy("_task")
    pieces = counted.join(tasks, "_task").withColumn(
        "_at", F.col("_rows_before") + F.col("_first") - F.min("_first").over(within)
    )
    of_group = Window.partitionBy("_group")
    pieces = pieces.withColumn("tree", F.min("_at").over(of_group)).withColumn("n", F.sum("_n").over(of_group))
    pieces = stored(pieces.drop("_rows_before"), f"{name}-pieces")
    # Groups begin in the task where their first row is; a task's groups are ranked inside it.
    starts = pieces.filter("_at = tree")
    per_task = starts.groupBy("_task").agg(F.count("*").alias("_starts"))
    per_task = per_task.select("_task", F.coalesce(F.sum("_starts").over(before), F.lit(0)).alias("_ranks_before"))
    in_task = Window.partitionBy("_task").orderBy("tree")
    ranks = starts.join(per_task, "_task").select(
        "tree", (F.col("_ranks_before") + F.row_number().over(in_task) - 1).alias("rank")
    )
    pieces = pieces.join(ranks, "tree").drop("_n")
    found = placed.join(
        pieces.withColumnRenamed("_task", "_of_task"),
        (F.col("_task") == F.col("_of_task")) & F.col(group).eqNullSafe(F.col("_group")),
    )
    return found.select(
        *rows.columns, "tree", "n", "rank", (F.col("_at") + F.col("_place") - F.col("_first")).alias("at")
    ).withColumn("pos", F.expr("at - tree"))


def _above(height: int, sources: int, code: int = 0) -> tuple[str, str]:
    """SQL for the parent's number (null at the root) and for the place among its children."""
    width = RUN**height
    base = "tree" if code == 0 else "0"
    parent = f"({base} + (pos DIV {RUN}) * {width * RUN}) * {_HEIGHTS} + {code + height + 1}"
    if code or sources == 1:
        return f"IF(n > {width}, {parent}, CAST(NULL AS BIGINT))", f"CAST(pos % {RUN} AS INT)"
    top = f"(rank - rank % {RUN}) * {_HEIGHTS} + {_TOP + 1}"
    return f"IF(n > {width}, {parent}, {top})", f"CAST(IF(n > {width}, pos, rank) % {RUN} AS INT)"


def _levels(items: DataFrame, most: int, name: str) -> list[DataFrame]:
    """The levels over ``tree, n, rank, pos, digest, low, high``, each a stored table, ``children`` added."""
    levels, level, height = [], items, 0
    while RUN**height < most:
        runs = level.filter(f"n > {RUN**height}").groupBy("tree", "n", "rank", F.expr(f"pos DIV {RUN}").alias("pos"))
        joined = runs.agg(
            F.expr("array_sort(collect_list(struct(pos % 3 AS slot, digest))).digest").alias("_children"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        children = F.expr(f"aggregate(_children, {_NO_SIBLINGS}, (all, one) -> concat(all, one))")
        joined = joined.withColumn("children", children).drop("_children")
        level = stored(joined.withColumn("digest", F.expr(_digest("children"))), f"{name}-{height + 1}")
        height += 1
        levels.append(level)
    return levels


class Manifest:
    """The tree of a table: ``leaves`` as given and numbered, ``nodes`` linked to their parents, ``root``."""

    def __init__(self, rows: DataFrame, source: str, order: str) -> None:
        """``rows`` have a column ``leaf`` of digests besides source and order; sources are compared as UTF-8."""
        self.leaves = stored(numbered(rows, source, [order, "leaf"], "leaves"), "numbered")
        size = self.leaves.agg(F.max("n").alias("n"), F.max("rank").alias("rank")).first()
        self.most, self.sources = size["n"] or 0, 0 if size["rank"] is None else size["rank"] + 1
        items = self.leaves.select(
            "tree", "n", "rank", "pos", F.col("leaf").alias("digest"), F.col("at").alias("low"), F.col("at").alias("high")
        )
        below = _levels(items, self.most, "level")
        tops = items.filter("n = 1")
        parts = []
        for height, level in enumerate(below, 1):
            done = level.filter(f"n <= {RUN**height}")
            tops = tops.unionByName(done.select(*tops.columns))
            parts.append(self._linked(level, height, 0))
        subroots = tops.select(
            F.lit(-1).cast("long").alias("tree"), F.lit(self.sources).cast("long").alias("n"),
            F.col("rank").alias("pos"), "rank", "digest", "low", "high",
        ).withColumn("rank", F.lit(0).cast("long"))
        above = _levels(subroots, self.sources, "top")
        parts += [self._linked(level, height, _TOP) for height, level in enumerate(above, 1)]
        self.root = bytes((above[-1] if above else subroots).first()["digest"]) if self.sources else None
        nodes = None
        for part in parts:
            nodes = part if nodes is None else nodes.unionByName(part)
        self.nodes = None if nodes is None else stored(nodes, "nodes")
        self.ways = None if nodes is None else stored(self._ways(), "ways")

    def _linked(self, level: DataFrame, height: int, code: int) -> DataFrame:
        """Node rows of a level, one per block of leaves below each."""
        base, width = ("0" if code else "tree"), RUN**height
        parent, slot = _above(height, self.sources, code)
        of_source = "CAST(NULL AS BINARY)" if code else f"IF(n <= {width}, digest, CAST(NULL AS BINARY))"
        return level.selectExpr(
            f"({base} + pos * {width}) * {_HEIGHTS} + {code + height} AS node", "children",
            f"{parent} AS parent", f"{slot} AS parent_slot", f"{of_source} AS subroot",
            f"explode(sequence(low DIV {BLOCK}, high DIV {BLOCK})) AS block",
            # How far up a way enters the tree of sources depends on the source.
            f"{bool(code) or height % STRIDE == 1 % STRIDE} AS stop",
        )

    def _ways(self) -> DataFrame:
        """The rows a climb stops at, with ``left_i`` and ``right_i`` of the next levels (null above the root)."""
        ways = self.nodes.filter("stop").drop("stop")
        up = self.nodes.select(
            F.col("node").alias("_node"), F.col("block").alias("_block"), F.col("children").alias("_children"),
            F.col("parent").alias("_parent"), F.col("parent_slot").alias("_slot"), F.col("subroot").alias("_subroot"),
        )
        for i in range(1, STRIDE):
            same = (F.col("parent") == F.col("_node")) & (F.col("block") == F.col("_block"))
            ways = ways.join(up, same, "left").selectExpr(
                "node", "block", "children", *[f"{side}_{k}" for k in range(1, i) for side in ("left", "right")],
                f"substring(_children, 1, 32 * parent_slot) AS left_{i}",
                f"substring(_children, 32 * parent_slot + 33) AS right_{i}",
                "_parent AS parent", "_slot AS parent_slot", "coalesce(subroot, _subroot) AS subroot",
            )
        return ways

    def climb(self, digest: str, carried: list[str]) -> DataFrame:
        """One row per leaf and step of its way up: ``at, step, folded, siblings, subroot``.

        Step 0 is the leaf, folded is there ``digest`` and ``carried`` its
        columns, which are null further up. The last step has the digest that
        the way ended with; siblings stand level by level and left to right, 32 bytes each.
        """
        node, slot = _above(0, self.sources)
        anchor = self.leaves.selectExpr(
            "at", f"at DIV {BLOCK} AS block", "0 AS step", f"{node} AS node", f"{slot} AS slot",
            f"{digest} AS folded", f"{_NO_SIBLINGS} AS siblings",
            "IF(n = 1, leaf, CAST(NULL AS BINARY)) AS subroot", *carried,
        )
        spark = anchor.sparkSession
        if self.nodes is None:
            return anchor.drop("block", "node", "slot")
        nothing = ", ".join(f"CAST(NULL AS {anchor.schema[c].dataType.simpleString()})" for c in carried)
        left, right = "substring(n.children, 1, 32 * c.slot)", "substring(n.children, 32 * c.slot + 33)"
        folded, met = _digest(f"concat({left}, c.folded, {right})"), [left, right]
        for i in range(1, STRIDE):
            folded = f"IF(n.left_{i} IS NULL, {folded}, {_digest(f'concat(n.left_{i}, {folded}, n.right_{i})')})"
            met += [f"coalesce(n.{side}_{i}, {_NO_SIBLINGS})" for side in ("left", "right")]
        query = f"""
            WITH RECURSIVE climb({", ".join(anchor.columns)}) AS (
              SELECT * FROM {{anchor}}
              UNION ALL
              SELECT c.at, c.block, c.step + 1, n.parent, n.parent_slot,
                     {folded}, concat({", ".join(met)}), n.subroot, {nothing}
              FROM climb c JOIN {{ways}} n ON c.node = n.node AND c.block = n.block)
            SELECT * FROM climb"""
        with _unlimited(spark):
            steps = stored(spark.sql(query, anchor=anchor, ways=self.ways), "climb")
        return steps.drop("block", "node", "slot")


@contextmanager
def _unlimited(spark: SparkSession) -> Iterator[None]:
    """Recursive queries may return any number of rows; Spark's own limit would also send them through one task."""
    setting = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def merkle_manifest(documents: DataFrame) -> DataFrame:
    """One row per document: its digests in the manifest, its proof, and whether the tampered row still proves.

    ``documents`` has the columns of ``FIELDS``, which are read as text. A row
    is tampered with by deleting its text's line breaks where two divides the
    CRC-32 of its id; null texts and rows without an id are left as they are.
    ``verified`` says whether the digest folded up from the row as it then is
    equals the root.

    Null ids come first in their source, null sources before all others. Rows
    alike in every field are leaves of their own, in any order; rows that
    share an id are ordered by their digests. An empty table gives no rows.
    Other columns are not read.
    """
    fields = [F.col(f).cast("string").alias(f"_{f}") for f in FIELDS]
    given = documents.select(F.col("doc_id"), *fields)
    names = [f"_{f}" for f in FIELDS]
    untouched = "coalesce(crc32(encode(_doc_id, 'UTF-8')) % 2 <> 0 OR NOT contains(_text, '\\n'), true)"
    tampered = leaf_digest(*names[:-1], "replace(_text, '\\n', '')")
    leaves = stored(
        given.select(
            "doc_id", F.col("_source").alias("source"), F.expr(leaf_digest(*names)).alias("leaf"),
            F.expr(f"IF({untouched}, CAST(NULL AS BINARY), {tampered})").alias("tampered"),
        ),
        "digests",
    )
    manifest = Manifest(leaves, "source", "doc_id")
    steps = manifest.climb("coalesce(tampered, leaf)", ["doc_id", "leaf"])
    root = F.lit(manifest.root.hex() if manifest.root else None).cast("string")
    proofs = steps.groupBy("at").agg(
        F.max("doc_id").alias("doc_id"),
        F.expr("lower(hex(max(leaf)))").alias("leaf"),
        F.expr("lower(hex(max(subroot)))").alias("subroot"),
        F.expr("array_sort(collect_list(struct(step, siblings))).siblings").alias("_siblings"),
        F.expr("lower(hex(max_by(folded, step)))").alias("folded_root"),
    )
    proof = "sha2(array_join(transform(_siblings, s -> lower(hex(s))), ''), 256)"
    return proofs.select(
        "doc_id", "leaf", "subroot", root.alias("root"), F.expr(proof).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
