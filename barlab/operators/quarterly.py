"""Quarterly history per ticker.

The quarterly table has one row per (ticker, quarter): its rows per key are
bounded by the calendar (four a year), so plain per-ticker windows are safe
here whatever the size of the price data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import tdiv
from barlab.params import QuarterlyParams

QUARTERLY_FEATURE_COLS = (
    "revenue_yoy_growth", "net_income_yoy_growth",
    "revenue_qoq_growth", "net_income_qoq_growth",
    "earnings_growth_streak",
)
HISTORY_COLS = ("ticker", "quarter_end", "available_date", "revenue", "net_income",
                "revenue_qoq_growth", "net_income_qoq_growth",
                "revenue_yoy_growth", "net_income_yoy_growth", "earnings_growth_streak")


def last_n_quarters(q: DataFrame, n: int) -> DataFrame:
    """Newest ``n`` quarters per ticker (cut before growth is computed)."""
    w = Window.partitionBy("ticker").orderBy(F.col("quarter_end").desc())
    return q.withColumn("_qrank", F.row_number().over(w)).filter(F.col("_qrank") <= n).drop("_qrank")


def quarterly_history(raw: DataFrame, qp: QuarterlyParams = QuarterlyParams()) -> DataFrame:
    """Last-N cut, availability date, QoQ / YoY growth and streak for every ticker."""
    q = raw.select("ticker", "quarter_end", F.col("revenue").cast("double"), F.col("net_income").cast("double"))
    # a ticker without any revenue contributes nothing
    q = q.withColumn("_has_rev", F.max(F.col("revenue").isNotNull().cast("int")).over(Window.partitionBy("ticker")))
    q = q.filter(F.col("_has_rev") == 1).drop("_has_rev")
    q = last_n_quarters(q, qp.lookback)
    w = Window.partitionBy("ticker").orderBy("quarter_end")
    filled = {c: F.last(F.col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
              for c in ("revenue", "net_income")}
    q = q.withColumns({"_rev_f": filled["revenue"], "_ni_f": filled["net_income"]})
    q = q.withColumns({
        "available_date": F.date_add(F.col("quarter_end"), qp.report_lag_days),
        "revenue_qoq_growth": tdiv(F.col("_rev_f"), F.lag("_rev_f", 1).over(w)) - 1,
        "net_income_qoq_growth": tdiv(F.col("_ni_f"), F.lag("_ni_f", 1).over(w)) - 1,
        "revenue_yoy_growth": tdiv(F.col("_rev_f"), F.lag("_rev_f", 4).over(w)) - 1,
        "net_income_yoy_growth": tdiv(F.col("_ni_f"), F.lag("_ni_f", 4).over(w)) - 1,
    })
    cls = F.when(F.col("net_income_yoy_growth").isNull(), 0).when(F.col("net_income_yoy_growth") > 0, 1).otherwise(-1)
    q = q.withColumn("_cls", cls)
    q = q.withColumn("_chg", F.when(F.lag("_cls", 1).over(w).eqNullSafe(F.col("_cls")), 0).otherwise(1))
    q = q.withColumn("_island", F.sum("_chg").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    run = F.row_number().over(Window.partitionBy("ticker", "_island").orderBy("quarter_end"))
    q = q.withColumn("earnings_growth_streak", (F.col("_cls") * run).cast("int"))
    return q.select(*HISTORY_COLS)
