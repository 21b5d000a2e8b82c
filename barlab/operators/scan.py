"""Prefix "last non-null" over an ordered series, in blocks (B6, and B3 by union).

A forward fill looks arbitrarily far back, so a halo is not enough. Each
block computes its local running ``last(x, ignorenulls)``; a summary table
with one row per (key, block) (``n / block_rows`` rows) keeps each block's
last non-null value; a running ``last`` over that small table gives the value
carried into each block, which is joined back and used where the local value
is missing. The only full-size shuffle is the one into (key, block).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.operators.series import BLK, NATIVE, RN, SKEY, _as_list, blocked, finish


def prefix_last(df: DataFrame, key, order, cols: list[str], block_rows: int = 16384,
                segment: str = "year", keep_helpers: bool = False) -> DataFrame:
    """Replace each of ``cols`` by its last non-null value at or before the row."""
    key = _as_list(key)
    b = blocked(df, key, order, block_rows, back=0, ahead=0, segment=segment)
    w = Window.partitionBy(SKEY, BLK).orderBy(RN).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumns({f"_loc_{c}": F.last(F.col(c), ignorenulls=True).over(w) for c in cols})
    # per block: last non-null value of each column
    summary = b.groupBy(SKEY, BLK).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(RN))).alias(f"_end_{c}") for c in cols])
    wb = Window.partitionBy(SKEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(SKEY, BLK, *[F.last(F.col(f"_end_{c}"), ignorenulls=True).over(wb).alias(f"_carry_{c}")
                                         for c in cols])
    joined = b.join(carry, [SKEY, BLK], "left")
    out = joined.withColumns({c: F.coalesce(F.col(f"_loc_{c}"), F.col(f"_carry_{c}")) for c in cols})
    drop = [f"_loc_{c}" for c in cols] + [f"_carry_{c}" for c in cols]
    return finish(out.drop(*drop), keep_helpers=keep_helpers)


def prefix_sum(df: DataFrame, key, order, col: str, out: str, block_rows: int = 16384,
               segment: str = "year") -> DataFrame:
    """Running sum of ``col`` per key in order (NULL counts as 0), in blocks:
    local running sum + the sum of all earlier blocks' totals (small table)."""
    key = _as_list(key)
    b = blocked(df, key, order, block_rows, back=0, ahead=0, segment=segment)
    x = F.coalesce(F.col(col).cast("double"), F.lit(0.0))
    w = Window.partitionBy(SKEY, BLK).orderBy(RN).rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("_loc", F.sum(x).over(w))
    totals = b.groupBy(SKEY, BLK).agg(F.sum(x).alias("_tot"))
    wb = Window.partitionBy(SKEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(SKEY, BLK, F.coalesce(F.sum("_tot").over(wb), F.lit(0.0)).alias("_carry"))
    j = b.join(carry, [SKEY, BLK], "left").withColumn(out, F.col("_loc") + F.coalesce(F.col("_carry"), F.lit(0.0)))
    return finish(j.drop("_loc", "_carry"))
