"""Conversations without quotations, each quotation linked to the message it quotes.

A line that begins with ``>`` marks is quoted, once per mark. The lines of a
message at one level that stand together are a passage. Passages and messages
are normalised alike (marks and repeated white space dropped, lower case) and
hashed, whole and line by line; a passage joins the messages of its
conversation that have its hashes. Replies then hang under what they quote at
the shallowest level, and a conversation is read in reply order. Everything is
DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.shared import stored

# A quoted line: marks, perhaps with spaces between them.
_MARKS = r"^[ \t]*((?:>[ \t]?)+)"
# The line that announces a quotation, as mail programs write it.
_ANNOUNCED = r"(?i)^\\s*(on\\b.*\\bwrote:|.{1,80}\\bwrote:)\\s*$"

_LINES = f"""
transform(
  split(coalesce(text, ''), '\\r?\\n'),
  (line, i) -> struct(
    i AS at,
    length(regexp_replace(regexp_extract(line, '{_MARKS}', 1), '[^>]', '')) AS level,
    regexp_replace(line, '{_MARKS}', '') AS line))
"""


def _normalised(column: str) -> str:
    return f"lower(trim(regexp_replace({column}, '\\\\s+', ' ')))"


def parse_quotes(messages: DataFrame) -> DataFrame:
    """``own`` (text without quotations) and ``passages`` (level, text) added to the messages.

    Neighbouring lines of one level are a passage; blank lines and the lines
    that announce a quotation belong to none and go with it.
    """
    lines = messages.withColumn("_lines", F.expr(_LINES))
    # An announcement counts only right above a quoted line, blank lines aside.
    kept = f"""
    filter(_lines, x -> x.level = 0 AND NOT (
      x.line RLIKE '{_ANNOUNCED}'
      AND coalesce(element_at(filter(_lines, y -> y.at > x.at AND trim(y.line) <> ''), 1).level, 0) > 0))
    """
    # Long messages have few quoted lines, so only those are looked at again.
    announced = "exists(_lines, x -> x.level > 0)"
    own = f"IF({announced}, {kept}, _lines)"
    runs = """
    aggregate(
      filter(_lines, x -> x.level > 0),
      cast(array() AS array<struct<level: int, last: int, text: string>>),
      (runs, x) -> IF(
        size(runs) > 0 AND element_at(runs, -1).level = x.level AND element_at(runs, -1).last = x.at - 1,
        concat(
          slice(runs, 1, size(runs) - 1),
          array(struct(x.level AS level, x.at AS last, concat(element_at(runs, -1).text, '\\n', x.line) AS text))),
        concat(runs, array(struct(x.level AS level, x.at AS last, x.line AS text)))))
    """
    return lines.select(
        *messages.columns,
        F.expr(f"regexp_replace(array_join(transform({own}, x -> x.line), '\\n'), '(^\\\\s+)|(\\\\s+$)', '')").alias("own"),
        F.expr(f"filter({runs}, r -> trim(r.text) <> '')").alias("passages"),
    )


def _paragraphs(column: str) -> str:
    """Hashes of the whole text and of each of its lines that say something."""
    lines = f"transform(split({column}, '\\n'), l -> {_normalised('l')})"
    whole = _normalised(column)
    return f"array_distinct(transform(filter(concat(array({whole}), {lines}), p -> p <> ''), p -> xxhash64(p, length(p))))"


def link_quotations(
    messages: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per message: its text without quotations, what it replies to, and its place in reply order.

    Every line of a quoted passage, and the passage as a whole, belongs to the
    earliest message of the conversation that has it among its own words. A
    passage's original is the one with most of its lines, the latest of these
    on a tie. ``parent_turn`` is the original of the shallowest passage, and
    again the latest on a tie. A message that quotes nothing known has no
    parent and begins a thread. ``path`` has the turns from the beginning of
    the thread down to the message; ordered by ``conv_id, path``, a message
    follows what it answers. ``n_unlinked`` counts passages without original.

    A null text is empty. A message without a conversation or a turn keeps its
    row, without parent and with no links to it. Rows alike in conversation,
    turn, role and text are one message; rows alike only in conversation and
    turn each keep their row and share the path of the one with the least
    role and text. An empty table gives no rows. Other columns are not read.
    """
    chosen = messages.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"), F.col(role).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).distinct()
    parsed = parse_quotes(chosen).withColumn("copy", F.xxhash64("role", "text"))
    key = ["conv_id", "turn", "copy"]

    passages = parsed.filter("size(passages) > 0").select(*key, F.posexplode("passages").alias("number", "passage"))
    asked = passages.select(
        *key, "number", F.col("passage.level").alias("level"),
        F.explode(F.expr(_paragraphs("passage.text"))).alias("hash"),
    )
    # Only conversations with quotations offer their words, and each line but once.
    quoting = passages.select("conv_id").distinct()
    offered = (
        parsed.join(quoting, "conv_id", "left_semi")
        .select("conv_id", "turn", F.explode(F.expr(_paragraphs("own"))).alias("hash"))
        .groupBy("conv_id", "hash")
        .agg(F.min("turn").alias("source"))
    )
    found = asked.join(offered, ["conv_id", "hash"]).filter("source < turn")
    counted = found.groupBy(*key, "number", "level", "source").agg(F.count("*").alias("lines"))
    originals = counted.groupBy(*key, "number", "level").agg(
        F.max_by("source", F.struct("lines", "source")).alias("source")
    )
    replies = stored(
        originals.groupBy(*key).agg(
            F.min_by("source", F.struct("level", F.expr("-source"))).alias("parent_turn"), F.count("*").alias("linked")
        ),
        "replies",
    )
    paths = _paths(replies)
    step = _step("turn")
    return (
        parsed.join(replies, key, "left")
        .join(paths, ["conv_id", "turn"], "left")
        .select(
            "conv_id", "turn", "role", F.col("own").alias("text"), "parent_turn",
            F.coalesce("path", F.expr(step)).alias("path"),
            F.size("passages").cast("long").alias("n_quotes"),
            (F.size("passages") - F.coalesce("linked", F.lit(0))).cast("long").alias("n_unlinked"),
        )
    )


def _step(column: str) -> str:
    """A turn as text that sorts as turns do: twelve digits, longer ones behind all of these, negative ones before."""
    return (
        f"CASE WHEN {column} < 0 THEN concat('-', lpad(CAST({column} & 9223372036854775807 AS STRING), 19, '0')) "
        f"WHEN {column} < 1000000000000 THEN lpad(CAST({column} AS STRING), 12, '0') "
        f"ELSE concat('~', lpad(CAST({column} AS STRING), 19, '0')) END"
    )


def _paths(replies: DataFrame) -> DataFrame:
    """``conv_id, turn, path`` of every turn with a parent; each round doubles the reach of all of them."""
    # A turn is one place in the conversation, whatever number of rows it has.
    hops = replies.groupBy("conv_id", "turn").agg(F.min_by("parent_turn", "copy").alias("up"))
    hops = stored(hops.withColumn("path", F.expr(_step("turn"))), "hops")
    while hops.filter("up IS NOT NULL").limit(1).count():
        above = hops.toDF("conv_id", "up", "up_up", "up_path")
        joined = hops.join(above, ["conv_id", "up"], "left")
        # Above the last known parent stands a turn that begins a thread.
        path = f"IF(up IS NULL, path, concat(coalesce(up_path, {_step('up')}), '/', path))"
        hops = stored(joined.selectExpr("conv_id", "turn", "up_up AS up", f"{path} AS path"), "hops")
    return hops.select("conv_id", "turn", "path")
