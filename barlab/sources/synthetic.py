"""Synthetic bars, index series and fundamentals for smoke runs.

Values are random (seeded), so results equal the reference's generator only
in distribution, not value by value. The generators are distributed: dates
come from ``range``/``sequence``, draws from ``randn``/``rand`` per row, and
the cumulative product of a random walk is ``exp(sum(log1p(r)))`` over the
blocked prefix scan's per-key order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def business_days(spark: SparkSession, start: str, n: int) -> DataFrame:
    """The first ``n`` weekdays from ``start`` (inclusive), with their index."""
    span = int(n * 7 / 5) + 7
    days = spark.range(span).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("bar_date"))
    days = days.filter(F.dayofweek("bar_date").between(2, 6))
    w = Window.orderBy("bar_date")
    return days.withColumn("_i", F.row_number().over(w) - 1).filter(F.col("_i") < n)


def synthetic_bars(spark: SparkSession, tickers: list[str], n: int = 800, start: str = "2023-01-01",
                   seed: int = 42) -> DataFrame:
    """Geometric random walk per ticker on business days; high >= max(open, close),
    low <= min(open, close); volume uniform in [1M, 8M)."""
    days = business_days(spark, start, n)
    tick = spark.createDataFrame([(t,) for t in tickers], "ticker string")
    grid = tick.crossJoin(F.broadcast(days))  # tickers x calendar, both inputs of bounded size
    r = F.lit(0.0004) + F.lit(0.018) * F.randn(seed)
    g = grid.withColumn("_r", r)
    w = Window.partitionBy("ticker").orderBy("bar_date").rowsBetween(Window.unboundedPreceding, 0)
    g = g.withColumn("close", F.lit(1000.0) * F.exp(F.sum(F.log1p("_r")).over(w)))
    g = g.withColumn("open", F.col("close") * (1 + F.lit(0.005) * F.randn(seed + 1)))
    hi = F.greatest("open", "close") * (1 + F.abs(F.lit(0.006) * F.randn(seed + 2)))
    lo = F.least("open", "close") * (1 - F.abs(F.lit(0.006) * F.randn(seed + 3)))
    vol = F.floor(F.lit(1_000_000) + F.rand(seed + 4) * F.lit(7_000_000)).cast("double")
    return g.select("ticker", "bar_date", "open", hi.alias("high"), lo.alias("low"), "close", vol.alias("volume"))


def synthetic_index(spark: SparkSession, name: str, n: int = 800, start: str = "2023-01-01",
                    seed: int = 42) -> DataFrame:
    """vix = |normal(15, 4)| + 8; any other index = 18000 x cumulative product of 1 + normal(0.0003, 0.01)."""
    days = business_days(spark, start, n)
    if name == "vix":
        return days.select("bar_date", (F.abs(F.lit(15.0) + F.lit(4.0) * F.randn(seed)) + 8).alias(name))
    w = Window.orderBy("bar_date").rowsBetween(Window.unboundedPreceding, 0)
    r = F.lit(0.0003) + F.lit(0.01) * F.randn(seed)
    return days.withColumn("_r", r).select("bar_date", (F.lit(18000.0) * F.exp(F.sum(F.log1p("_r")).over(w))).alias(name))


def synthetic_fundamentals(spark: SparkSession, tickers: list[str], seed: int = 42) -> DataFrame:
    """Uniform draws per ticker."""
    tick = spark.createDataFrame([(t,) for t in tickers], "ticker string")

    def u(lo, hi, k):
        return F.lit(lo) + F.rand(seed + k) * F.lit(hi - lo)

    return tick.select("ticker", u(10, 45, 0).alias("pe_ratio"), u(5, 120, 1).alias("eps"),
                       u(5e10, 2e12, 2).alias("market_cap"), u(0, 120, 3).alias("debt_to_equity"),
                       u(0.8, 3, 4).alias("current_ratio"))
