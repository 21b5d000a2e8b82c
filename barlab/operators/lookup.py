"""Lookup queries behind the data service and the dashboard (M1-M8).

Filters reach the parquet scan (pushed filters); newest-first reads with a
limit plan as ``TakeOrderedAndProject`` (a per-task top-k, then a merge of
k rows per task), never a full sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PRICE_LIMIT_DEFAULT, PRICE_LIMIT_MAX = 100, 1000
FEATURE_LIMIT_DEFAULT, FEATURE_LIMIT_MAX = 50, 500


def _check_limit(limit: int, max_limit: int) -> int:
    if limit < 1 or limit > max_limit:
        raise ValueError(f"limit must be in [1, {max_limit}]")
    return limit


def tickers(df: DataFrame) -> DataFrame:
    """M1: distinct tickers, sorted."""
    return df.select("ticker").distinct().orderBy("ticker")


def ticker_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("ticker").alias("count"))


def price_lookup(prices: DataFrame, ticker: str, start: str | None = None, end: str | None = None,
                 limit: int = PRICE_LIMIT_DEFAULT) -> DataFrame:
    """M2: one ticker's rows, optional inclusive start / end, newest first."""
    limit = _check_limit(limit, PRICE_LIMIT_MAX)
    q = prices.filter(F.col("ticker") == ticker)
    if start:
        q = q.filter(F.col("bar_date") >= F.lit(start).cast("date"))
    if end:
        q = q.filter(F.col("bar_date") <= F.lit(end).cast("date"))
    return q.orderBy(F.col("bar_date").desc()).limit(limit)


def fundamentals_lookup(fund: DataFrame, ticker: str) -> DataFrame:
    """M3: the snapshot row of one ticker."""
    return fund.filter(F.col("ticker") == ticker).limit(1)


def feature_lookup(featured: DataFrame, ticker: str, limit: int = FEATURE_LIMIT_DEFAULT) -> DataFrame:
    """M4: one ticker's feature rows, newest first."""
    limit = _check_limit(limit, FEATURE_LIMIT_MAX)
    return featured.filter(F.col("ticker") == ticker).orderBy(F.col("bar_date").desc()).limit(limit)


def row_counts(spark: SparkSession, tables: dict[str, object]) -> DataFrame:
    """M5: rows per table; a table that fails to load or count gets its error
    text and does not stop the others. Values are DataFrames or loaders."""
    rows = []
    for name, t in tables.items():
        try:
            df = t() if callable(t) else t
            rows.append((name, int(df.count()), None))
        except Exception as e:  # reported per table, as the service does
            rows.append((name, None, f"error: {e}".splitlines()[0]))
    return spark.createDataFrame(rows, "table string, rows long, error string")


def last_n_history(featured: DataFrame, ticker: str, n: int = 180) -> DataFrame:
    """M6: newest ``n`` rows of one ticker, returned oldest first."""
    top = featured.filter(F.col("ticker") == ticker).orderBy(F.col("bar_date").desc()).limit(n)
    return top.orderBy("bar_date")


def latest_price(prices: DataFrame, ticker: str) -> DataFrame:
    """M7: date, close and volume of the newest row of one ticker."""
    return price_lookup(prices, ticker, limit=1).select("bar_date", "close", "volume")


def ticker_sample(df: DataFrame, k: int = 5) -> DataFrame:
    """M8: ticker count and the first ``k`` tickers in sorted order (top-k, not a full sort)."""
    d = df.select("ticker").distinct()
    count = d.agg(F.count(F.lit(1)).alias("ticker_count"))
    sample = d.orderBy("ticker").limit(k).agg(F.array_sort(F.collect_list("ticker")).alias("sample"))
    return count.crossJoin(sample)
