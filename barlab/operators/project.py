"""Price projection from historical growth, for every ticker at once.

Per ticker: first/last close by date, day span, closes counted, and the
sample standard deviation of bar-to-bar returns. All are partial aggregates
grouped by ticker; the returns come from the blocked window layout, so no
ticker is ever one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import tdiv
from barlab.operators.series import blocked, block_window, finish

MIN_CLOSES = 60


def bar_returns(bars: DataFrame, key: str = "ticker", order: str = "bar_date", block_rows: int = 16384) -> DataFrame:
    """Close-to-close returns over the rows with a close (lag 1 in the blocked layout)."""
    valid = bars.select(key, order, "close").filter(F.col("close").isNotNull())
    b = blocked(valid, [key], order, block_rows, back=1, ahead=0)
    w = block_window([key])
    b = b.withColumn("ret", tdiv(F.col("close"), F.lag("close", 1).over(w)) - 1)
    return finish(b)


def growth_stats(bars: DataFrame, key: str = "ticker", order: str = "bar_date", min_closes: int = MIN_CLOSES,
                 trading_days: int = 252) -> DataFrame:
    """L1 + L2: last close, CAGR, annual volatility, history years (1 decimal).
    Tickers with fewer than ``min_closes`` closes, no elapsed time or a
    non-positive first close get no row."""
    r = bar_returns(bars, key, order)
    s = r.groupBy(key).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min_by("close", order).alias("_first"), F.max_by("close", order).alias("last_close"),
        F.min(order).alias("_d0"), F.max(order).alias("last_date"),
        F.stddev_samp("ret").alias("_sd"),
    )
    years = F.datediff("last_date", "_d0") / F.lit(365.25)
    s = s.withColumn("_years", years)
    s = s.filter((F.col("_n") >= min_closes) & (F.col("_years") > 0) & (F.col("_first") > 0))
    return s.select(
        key, "last_date", "last_close",
        (F.pow(F.col("last_close") / F.col("_first"), 1 / F.col("_years")) - 1).alias("cagr"),
        (F.col("_sd") * F.sqrt(F.lit(float(trading_days)))).alias("annual_vol"),
        F.round(F.col("_years"), 1).alias("history_years"),
    )


def project_price(bars: DataFrame, years: int = 5, key: str = "ticker", order: str = "bar_date") -> DataFrame:
    """Base / optimistic / pessimistic paths at the next ``years`` year ends."""
    g = growth_stats(bars, key, order)
    t = F.explode(F.sequence(F.lit(1), F.lit(years))).alias("t")
    p = g.select("*", t)
    pess = F.greatest(F.col("cagr") - F.col("annual_vol"), F.lit(-0.95))
    return p.select(
        key, "t",
        F.make_date(F.year("last_date") + F.col("t"), F.lit(12), F.lit(31)).alias("future_date"),
        (F.col("last_close") * F.pow(1 + F.col("cagr"), F.col("t"))).alias("base"),
        (F.col("last_close") * F.pow(1 + F.col("cagr") + F.col("annual_vol"), F.col("t"))).alias("optimistic"),
        (F.col("last_close") * F.pow(1 + pess, F.col("t"))).alias("pessimistic"),
    )
