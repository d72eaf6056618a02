"""Chat formatting by perspective rotation.

Every participant of a conversation gets the dialogue from their own seat: their
turns are the assistant's and are learned, everybody else is a named user, system
turns stay system turns; what is not learned is masked. Dialogues come in parts
of bounded size, so no conversation has to fit into one row. Where a turn starts
is a running sum in two steps, within blocks of turns and over blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from marketpulse.llm.common import n_points, table

#: A part takes turns until it has this many code points. Ordinary dialogues are one part.
PART = 65_536
#: Turn numbers in a block
BLOCK = 256
SYSTEM, NOBODY = "system", "unknown"


def _opening(role: Column, perspective: Column) -> Column:
    return (F.when(role == SYSTEM, F.lit("<|system|>\n")).when(role == perspective, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), role, F.lit("|>\n"))))


def perspectives(conversations: DataFrame) -> DataFrame:
    """One row per participant's turn: ``conv_id, perspective, turn, segment``
    (the turn as rendered), ``learned`` (whether it is the perspective's own),
    ``start`` (code points before the segment in the dialogue), ``from_point`` and
    ``to_point`` (its text with the closing mark, within the dialogue).

    Participants are the roles of a conversation but system. A null role is a user
    named unknown, whose perspective is not taken; a null text is empty; turns without a number
    come first; a null ``conv_id`` is a conversation of its own. Turns of one number
    follow by role and text, repeated rows are repeated turns. Texts of any length
    are taken whole. A conversation without participants, and an empty table, give
    no rows; further columns are not looked at."""
    turns = conversations.select("conv_id", "turn", F.col("role").alias("speaker"), F.coalesce("role", F.lit(NOBODY)).alias("role"),
                                 F.coalesce("text", F.lit("")).alias("text"))
    seats = turns.where(F.col("speaker").isNotNull() & (F.col("speaker") != SYSTEM)).select(
        F.col("conv_id").alias("s_conv"), F.col("speaker").alias("perspective")).distinct()
    rows = turns.join(seats, F.col("conv_id").eqNullSafe(F.col("s_conv"))).drop("s_conv")
    own = F.coalesce(F.col("speaker") == F.col("perspective"), F.lit(False))
    opening = F.when(F.col("speaker").isNull(), F.lit(f"<|user name={NOBODY}|>\n")).otherwise(_opening(F.col("role"), F.col("perspective")))
    rows = (rows.select("conv_id", "perspective", "turn", "role", "text", own.alias("learned"), opening.alias("opening"),
                        F.floor(F.coalesce("turn", F.lit(-1)) / BLOCK).alias("block"))
            .withColumn("segment", F.concat("opening", "text", F.lit("<|end|>\n")))
            .withColumn("size", n_points(F.col("segment"))))
    in_block = Window.partitionBy("conv_id", "perspective", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    over_blocks = Window.partitionBy("conv_id", "perspective").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "perspective", "block").agg(F.sum("size").alias("all")).select(
        F.col("conv_id").alias("b_conv"), F.col("perspective").alias("b_seat"), F.col("block").alias("b_block"),
        F.coalesce(F.sum("all").over(over_blocks), F.lit(0)).alias("before"))
    there = F.col("conv_id").eqNullSafe(F.col("b_conv")) & (F.col("perspective") == F.col("b_seat")) & (F.col("block") == F.col("b_block"))
    rows = (rows.withColumn("start", F.sum("size").over(in_block.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
            .join(blocks, there).withColumn("start", F.col("start") + F.col("before")))
    from_point = F.col("start") + n_points(F.col("opening"))
    return rows.select("conv_id", "perspective", "turn", "segment", "learned", "start", from_point.alias("from_point"),
                       (F.col("start") + F.col("size") - 1).alias("to_point"))


def dialogues(conversations: DataFrame) -> DataFrame:
    """One row per participant and part: ``conv_id, perspective, part, n_turns, text,
    spans, n_learned``. ``spans`` are the learned ranges of code points in ``text``,
    ``from:to`` with a comma between, the rest is masked; ``n_learned`` is their
    length. What ``perspectives`` says of nulls and ties holds here."""
    rows = perspectives(conversations).withColumn("part", F.floor(F.col("start") / PART))
    turn = F.struct("start", "segment", "learned", "from_point", "to_point")
    parts = rows.groupBy("conv_id", "perspective", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    first = F.col("turns")[0]["start"]
    own = F.filter("turns", lambda t: t["learned"])
    spans = F.transform(own, lambda t: F.concat_ws(":", (t["from_point"] - first).cast("string"), (t["to_point"] - first).cast("string")))
    return parts.select(
        "conv_id", "perspective", "part", F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: t["segment"]), "").alias("text"), F.array_join(spans, ",").alias("spans"),
        F.aggregate(own, F.lit(0).cast("long"), lambda n, t: n + t["to_point"] - t["from_point"]).alias("n_learned"))


def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogues(table(spark, sf_dir, "conversations"))


OP1_SQL = r"""
WITH t AS (SELECT conv_id, turn, role AS speaker, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations),
s AS (SELECT DISTINCT conv_id AS s_conv, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (
  SELECT t.*, perspective, coalesce(speaker = perspective, false) AS learned,
    CASE WHEN speaker = 'system' THEN '<|system|>' WHEN speaker = perspective THEN '<|assistant|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS opening
  FROM t JOIN s ON conv_id IS NOT DISTINCT FROM s_conv),
g AS (SELECT *, opening || text || '<|end|>' || chr(10) AS segment FROM r),
o AS (
  SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) - length(segment) AS start FROM g),
p AS (SELECT *, start // 65536 AS part FROM o),
q AS (SELECT *, start - min(start) OVER (PARTITION BY conv_id, perspective, part) AS base FROM p)
SELECT conv_id, perspective, part::BIGINT AS part, count(*) AS n_turns, string_agg(segment, '' ORDER BY start) AS text,
  coalesce(string_agg((base + length(opening))::BIGINT || ':' || (base + length(segment) - 1)::BIGINT, ',' ORDER BY start) FILTER (learned), '') AS spans,
  coalesce(sum(length(segment) - 1 - length(opening)) FILTER (learned), 0)::BIGINT AS n_learned
FROM q GROUP BY conv_id, perspective, part
"""
