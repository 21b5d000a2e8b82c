"""Backward as-of join.

For each left row, the latest right row of the same key whose ``right_on``
is at or before the left row's ``left_on`` (exact match allowed); no match
gives NULLs. Among right rows with the same key and time the last one (by
``right_tiebreak``) wins, even if its values are NULL.

Two plans:

* ``range``: right rows are cut to one per (key, time), each gets the next
  time of its key, and the left side joins the broadcast right side on key
  with ``time in [t_i, t_next)``. Used when the right side's row count,
  checked with a count, is under ``max_broadcast_rows``.
* ``scan``: left and right rows are unioned into one series per key (right
  before left on equal times) and the last right row is carried forward with
  the blocked prefix scan of ``scan.prefix_last``. No size limit, skew-safe.

The carried value is a struct, so a matched right row with NULL fields
stays matched (its fields stay NULL) rather than falling back further.

Both plans give the same rows: every left row stays; a NULL key or time on
either side matches nothing; a date and a timestamp are compared as timestamps;
the tie-break keeps its own type, and a NULL one loses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.operators.quarterly import QUARTERLY_FEATURE_COLS
from barlab.operators.scan import prefix_last
from barlab.session import cut_lineage


def _matchable(right: DataFrame, by: list[str], right_on: str) -> DataFrame:
    return right.dropna(subset=[*by, right_on])


def _dedupe_right(right: DataFrame, by: list[str], right_on: str, tiebreak: str | None) -> DataFrame:
    if tiebreak is None:
        return right.dropDuplicates([*by, right_on])
    w = Window.partitionBy(*by, right_on).orderBy(F.col(tiebreak).desc_nulls_last())
    return right.withColumn("_dup", F.row_number().over(w)).filter("_dup = 1").drop("_dup")


def asof_backward(left: DataFrame, right: DataFrame, by, left_on: str, right_on: str,
                  right_cols: list[str], right_tiebreak: str | None = None, strategy: str = "auto",
                  max_broadcast_rows: int = 2_000_000, block_rows: int = 16384) -> DataFrame:
    by = [by] if isinstance(by, str) else list(by)
    if strategy in ("auto", "range"):
        right = cut_lineage(right)  # counted, then joined: made once
    if strategy in ("auto", "range") and right.count() > max_broadcast_rows:
        strategy = "scan"  # too many rows to broadcast
    elif strategy == "auto":
        strategy = "range"
    right = _matchable(right, by, right_on)
    if strategy == "range":
        return _asof_range(left, right, by, left_on, right_on, right_cols, right_tiebreak)
    if strategy == "scan":
        return _asof_scan(left, right, by, left_on, right_on, right_cols, right_tiebreak, block_rows)
    raise ValueError(f"unknown strategy {strategy}")


def _asof_range(left, right, by, left_on, right_on, right_cols, tiebreak):
    r = _dedupe_right(right.select(*by, right_on, *right_cols, *([tiebreak] if tiebreak and tiebreak not in right_cols else [])),
                      by, right_on, tiebreak)
    w = Window.partitionBy(*by).orderBy(right_on)
    r = r.withColumn("_t_next", F.lead(right_on, 1).over(w))
    r = r.select(*[F.col(k).alias(f"_r_{k}") for k in by], F.col(right_on).alias("_t_from"), "_t_next",
                 F.struct(*right_cols).alias("_match"))
    cond = [left[k] == r[f"_r_{k}"] for k in by] + [
        left[left_on] >= r["_t_from"], r["_t_next"].isNull() | (left[left_on] < r["_t_next"])]
    j = left.join(F.broadcast(r), cond, "left")
    return j.select(*left.columns, *[F.col("_match")[c].alias(c) for c in right_cols])


def _asof_scan(left, right, by, left_on, right_on, right_cols, tiebreak, block_rows):
    lcols = left.columns
    kinds = {left.schema[left_on].dataType, right.schema[right_on].dataType}
    time = kinds.pop() if len(kinds) == 1 else T.TimestampType()  # the wider of date and timestamp
    tb = right.schema[tiebreak].dataType if tiebreak else T.StringType()
    lft = left.select(*by, F.col(left_on).cast(time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(tb).alias("_tb"),
                      F.struct(*lcols).alias("_lrow"))
    rt = right.select(*by, F.col(right_on).cast(time).alias("_t"), F.lit(0).alias("_side"),
                      (F.col(tiebreak) if tiebreak else F.lit(None).cast(tb)).alias("_tb"),
                      F.struct(*right_cols).alias("_rrow"))
    u = lft.unionByName(rt, allowMissingColumns=True)
    scanned = prefix_last(u, by, ["_t", "_side", "_tb"], ["_rrow"], block_rows=block_rows)
    out = scanned.filter(F.col("_side") == 1)
    return out.select(*[F.col("_lrow")[c].alias(c) for c in lcols], *[F.col("_rrow")[c].alias(c) for c in right_cols])


def attach_quarterly(prices: DataFrame, history: DataFrame | None, strategy: str = "auto") -> DataFrame:
    """B4 (+ A13): revenue, net income and the five growth features as of each bar;
    without quarterly data the columns are NULL."""
    cols = ["revenue", "net_income", *QUARTERLY_FEATURE_COLS]
    if history is None:
        return prices.withColumns({c: F.lit(None).cast("int" if c == "earnings_growth_streak" else "double") for c in cols})
    return asof_backward(prices, history, "ticker", "bar_date", "available_date", cols,
                         right_tiebreak="quarter_end", strategy=strategy)


def match_coverage(attached: DataFrame) -> DataFrame:
    """Rows with a matched quarter (non-null revenue) and all rows."""
    return attached.agg(F.count("revenue").alias("matched_rows"), F.count(F.lit(1)).alias("rows"))
