"""Chat formatting after cumulative-snapshot collapse.

A logged conversation is often a prefix of a longer one. Each turn's position,
role and text are hashed twice; the running xor of these hashes identifies a
turn prefix. Conversations whose whole hash is also a shorter prefix of another
one are removed by an anti-join, copies keep their smallest ``conv_id``, and the
rest are rendered as ``<|im_start|>role\\ntext<|im_end|>\\n`` blocks.

Native. Prefix hashes are reduced to distinct ones before the join, so a common
first turn is one row there. Running values are taken in blocks of
``BLOCK_TURNS`` turn numbers, so a very long log isn't one window; only its
rendering, one output row, needs it whole.

Edge cases: turns are ordered by (turn, role, text), nulls first, and exact
repeats of a turn count once; position is the rank in that order, so gaps in
``turn`` don't matter; rows without ``conv_id`` belong to no conversation and
are left out; null role or text renders as empty but hashes unlike an empty one;
an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace

BLOCK_TURNS = 1024


def positions(turns: DataFrame) -> DataFrame:
    """Distinct turns with ``pos``, their rank in the conversation from 1."""
    t = turns.filter(F.col("conv_id").isNotNull()).select("conv_id", "turn", "role", "text").distinct()
    t = t.withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(-(1 << 62))))
    sizes = t.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    return t.join(sizes, ["conv_id", "block"]).withColumn("pos", F.col("before") + F.row_number().over(inside)).drop("before")


def prefixes(pos: DataFrame) -> DataFrame:
    """Every turn prefix: conv_id, pos and its two rolling hashes."""
    def h(seed: str):
        # isNull flags keep null apart from empty
        return F.xxhash64(F.lit(seed), "pos", "role", F.col("role").isNull(), "text", F.col("text").isNull())

    t = pos.select("conv_id", "block", "pos", h("a").alias("a"), h("b").alias("b"))
    parts = t.groupBy("conv_id", "block").agg(F.bit_xor("a").alias("pa"), F.bit_xor("b").alias("pb"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("pa", "pb")])
    inside = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return t.join(parts, ["conv_id", "block"]).select(
        "conv_id", "pos", F.col("pa").bitwiseXOR(F.bit_xor("a").over(inside)).alias("h1"),
        F.col("pb").bitwiseXOR(F.bit_xor("b").over(inside)).alias("h2"))


def maximal(ws: Workspace, pos: DataFrame) -> DataFrame:
    """conv_id, n_turns and n_copies of the conversations that prefix no longer one."""
    pre = ws.stage(prefixes(pos), "prefixes")
    length = pre.groupBy("conv_id").agg(F.max("pos").alias("n_turns"))
    marked = pre.join(length, "conv_id")
    whole = (marked.filter("pos = n_turns").groupBy("h1", "h2", "n_turns")
             .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies")))
    shorter = marked.filter("pos < n_turns").select("h1", "h2").distinct()
    return whole.join(shorter, ["h1", "h2"], "left_anti").select("conv_id", "n_turns", "n_copies")


def render(pos: DataFrame, keep: DataFrame) -> DataFrame:
    """One chat text per kept conversation."""
    turn = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"),
                    F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"))
    rows = pos.join(keep, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(
        F.sort_array(F.collect_list(F.struct("pos", turn.alias("t")))).alias("ts"))
    return rows.select("conv_id", F.col("n_turns").cast("long"), F.col("n_copies").cast("long"),
                       F.array_join(F.col("ts.t"), "").alias("chat"))


def collapse_and_format(ws: Workspace, turns: DataFrame) -> DataFrame:
    """conv_id, n_turns, n_copies and chat text of every maximal conversation."""
    pos = ws.stage(positions(turns), "positions")
    return render(pos, ws.stage(maximal(ws, pos), "maximal"))
