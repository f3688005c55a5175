"""Chat formatting by perspective rotation (native).

For every participant of a conversation the dialogue is rendered with that
speaker as the assistant and all others as named users; the training mask
marks what that speaker says.  One row is one rendered turn of one
perspective, with its place in the rendered dialogue: the segments of a
perspective, in order of ``position``, joined without anything between, are
the dialogue.  A conversation is never gathered into one row or task:
places are prefix sums over blocks of turns and then within a block.

Only built-in DataFrame functions are used.

Defined cases: a repeated row is rendered as often as it occurs; turns with the same number
follow each other by role, then the text's MD5; a null turn comes first; null role
and text are empty; roles in ``INSTRUCTIONS`` are no participants (their
turns are rendered as they are, in every perspective), so a conversation of
instructions alone gives no rows; a null conversation id is a conversation;
``<|`` inside a text or name becomes ``< |`` and line breaks in a name
become blanks, so no turn can forge markup; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INSTRUCTIONS = ("system",)
BLOCK_TURNS = 256
#: Repeats of a row that one row is turned into at once.
REPEATS = 4096
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _plain(col: Column) -> Column:
    return F.replace(col, F.lit("<|"), F.lit("< |"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", instructions: tuple[str, ...] = INSTRUCTIONS) -> DataFrame:
    """``[conv_col, perspective, position, turn_col, speaker, segment, start,
    mask_start, mask_end]``: ``start`` is the segment's first character in
    the rendered dialogue; the mask is empty (nulls) unless the perspective
    speaks, and then covers the text and its end mark.

    Places are worked out on rows without text; the texts are shuffled once
    and meet their places there."""
    conv, turn = F.col(conv_col), F.col(turn_col)
    rows = turns.select(conv.alias("conv"), turn.alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    # A turn is known by (k, h): conversation, number and role, and the text.
    rows = rows.withColumn("h", F.md5("body")).withColumn(
        "k", F.xxhash64("conv", F.col("conv").isNull(), "turn", F.col("turn").isNull(), "role"))
    texts = rows.groupBy("k", "h").agg(F.first(_plain(F.col("body"))).alias("content"))

    speaks = ~F.col("role").isin(*instructions)
    name = F.translate(_plain(F.col("role")), "\n\r", "  ")
    as_other = F.concat(F.lit(OPEN), F.when(speaks, F.concat(F.lit("user name="), name)).otherwise(name), F.lit("\n"))
    own_head, tail = OPEN + "assistant\n", len(CLOSE)
    thin = rows.select("k", "h", "conv", "turn", "role", F.length(_plain(F.col("body"))).alias("n_chars"))
    # Equal rows travel as one with their number.
    thin = thin.groupBy(*thin.columns).agg(F.count(F.lit(1)).alias("repeats"))
    block = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62)))
    thin = thin.withColumns({"block": block, "speaks": speaks, "head": as_other})
    # A turn's length for others, and how much that changes in its speaker's own perspective.
    thin = thin.withColumn("size", F.length("head") + F.col("n_chars") + tail).withColumn(
        "change", F.lit(len(own_head)) - F.length("head"))

    speakers = thin.where("speaks").groupBy("conv", F.col("role").alias("perspective")).agg(
        F.count(F.lit(1)).alias("_n")).drop("_n")
    blocks = thin.groupBy("conv", "block").agg(
        F.sum(F.col("size") * F.col("repeats")).alias("size"), F.sum("repeats").alias("n"))
    own = thin.where("speaks").groupBy("conv", "block", F.col("role").alias("perspective")).agg(
        F.sum(F.col("change") * F.col("repeats")).alias("change"))
    # Blocks of a conversation in every perspective, with all that comes before them.
    by_block = (blocks.join(speakers, blocks["conv"].eqNullSafe(speakers["conv"])).drop(speakers["conv"]))
    same = (by_block["conv"].eqNullSafe(own["conv"]) & (by_block["block"] == own["block"])
            & (by_block["perspective"] == own["perspective"]))
    by_block = by_block.join(own, same, "left").select(
        by_block["conv"], by_block["block"], by_block["perspective"], "n",
        (F.col("size") + F.coalesce("change", F.lit(0))).alias("size"))
    earlier = Window.partitionBy("conv", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    by_block = by_block.select(
        F.col("conv").alias("_conv"), F.col("block").alias("_block"), "perspective",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("size_before"))
    seen = thin.join(by_block, thin["conv"].eqNullSafe(by_block["_conv"]) & (thin["block"] == by_block["_block"]))
    seen = seen.withColumn("own", F.col("speaks") & (F.col("role") == F.col("perspective"))).withColumn(
        "own_size", F.col("size") + F.when(F.col("own"), F.col("change")).otherwise(0))
    order = Window.partitionBy("conv", "perspective", "block").orderBy("turn", "role", "h")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    all_before = [F.coalesce(F.sum(c).over(before), F.lit(0)) for c in (F.col("repeats"), F.col("own_size") * F.col("repeats"))]
    first = seen.select(
        "k", "h", "conv", "perspective", "turn", "role", "own", "own_size", "repeats",
        F.when(F.col("own"), F.lit(own_head)).otherwise(F.col("head")).alias("head"),
        (F.col("n_before") + all_before[0]).alias("position"), (F.col("size_before") + all_before[1]).alias("start"))
    # Each repeat at its own place, in two steps that keep arrays short.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("repeats") - 1, F.lit(REPEATS).cast("long"))).alias("part")
    parts = first.select("*", part)
    nth = F.explode(F.sequence("part", F.least(F.col("part") + REPEATS, F.col("repeats")) - 1)).alias("nth")
    placed = parts.select("*", nth).select(
        "k", "h", "conv", "perspective", "turn", "role", "own", "head",
        (F.col("position") + F.col("nth")).alias("position"),
        (F.col("start") + F.col("nth") * F.col("own_size")).alias("start"))
    mask_start = F.when(F.col("own"), F.col("start") + F.length("head"))
    return placed.join(texts, ["k", "h"]).select(
        F.col("conv").alias(conv_col), "perspective", "position", F.col("turn").alias(turn_col),
        F.col("role").alias("speaker"), F.concat("head", "content", F.lit(CLOSE)).alias("segment"), "start",
        mask_start.alias("mask_start"),
        (mask_start + F.length("content") + len(CLOSE.rstrip("\n"))).alias("mask_end"))


#: The same rows in DuckDB SQL.
ORACLE = """
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS speaker, coalesce(text, '') AS body FROM conversations),
p AS (SELECT DISTINCT conv_id AS c, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT conv_id, perspective, turn, speaker, body, speaker = perspective AS own,
         '<|im_start|>' || CASE WHEN speaker = perspective THEN 'assistant'
           WHEN speaker = 'system' THEN 'system'
           ELSE 'user name=' || translate(replace(speaker, '<|', '< |'), chr(10) || chr(13), '  ') END || chr(10) AS head,
         replace(body, '<|', '< |') AS content
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.c),
s AS (
  SELECT *, row_number() OVER w - 1 AS position,
         coalesce(sum(length(head) + length(content) + 11) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
           AS start
  FROM r WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, md5(body)))
SELECT conv_id, perspective, position, turn, speaker, head || content || '<|im_end|>' || chr(10) AS segment,
       start::BIGINT AS start, CASE WHEN own THEN (start + length(head))::BIGINT END AS mask_start,
       CASE WHEN own THEN (start + length(head) + length(content) + 10)::BIGINT END AS mask_end
FROM s
"""
