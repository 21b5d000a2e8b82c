"""Bar sources: read typed bars, build bars from trades, combine series (A1-A5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BAR_SCHEMA = T.StructType([
    T.StructField("ticker", T.StringType(), False),
    T.StructField("bar_date", T.DateType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

# Column names of the daily-bar download (flattened), mapped to ours.
DOWNLOAD_NAMES = {"Date": "bar_date", "Open": "open", "High": "high", "Low": "low",
                  "Close": "close", "Volume": "volume"}


def normalise_bars(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """A1: rename download-style columns, type them, add ``ticker`` if given."""
    for src, dst in DOWNLOAD_NAMES.items():
        if src in df.columns and src != dst:
            df = df.withColumnRenamed(src, dst)
    if ticker is not None:
        df = df.withColumn("ticker", F.lit(ticker))
    typed = [
        F.col("ticker").cast("string").alias("ticker"),
        F.to_date(F.col("bar_date")).alias("bar_date"),
        *[F.col(c).cast("double").alias(c) for c in ("open", "high", "low", "close", "volume")],
    ]
    rest = [F.col(c) for c in df.columns if c not in {f.name for f in BAR_SCHEMA.fields}]
    return df.select(*typed, *rest)


def read_bars(spark: SparkSession, path: str, fmt: str = "parquet", ticker: str | None = None) -> DataFrame:
    """Typed bars from parquet (default) or CSV with a header; no inference."""
    if fmt == "csv":
        df = spark.read.option("header", True).csv(path)
    else:
        df = spark.read.format(fmt).load(path)
    return normalise_bars(df, ticker)


def build_bars(trades: DataFrame, key: str, ts: str, price: Column | str, qty: str,
               grain: str = "day", tiebreak: tuple[str, ...] = ()) -> DataFrame:
    """A2: trades -> open/high/low/close/volume per key and period.

    Open/close are the first/last trade by (ts, *tiebreak, price); the
    aggregation runs map-side first (partial aggregates), so a hot key is
    combined before the shuffle.
    """
    sums = trade_sums(trades, key, ts, price, qty, grain, tiebreak)
    return sums.select("ticker", "bar_date", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"),
                       F.col("volume").cast("double").alias("volume"))


def trade_sums(trades: DataFrame, key: str, ts: str, price: Column | str, qty: str, grain: str = "day",
               tiebreak: tuple[str, ...] = (), within: tuple[Column, ...] = (), also: tuple[Column, ...] = ()) -> DataFrame:
    """What a bar is made of, per key, period and the further groups ``within``: first and last trade as ordered
    structs, high, low, volume, and the aggregates ``also``. ``bars_of`` puts the groups of a period together."""
    p = F.col(price) if isinstance(price, str) else price
    trade = F.struct(F.col(ts), *[F.col(t) for t in tiebreak], p.alias("price"))
    period = F.to_date(F.date_trunc(grain, F.col(ts)))
    # the period leads: rows are sorted by the groups, and a date tells more of them apart than a name's start
    return trades.groupBy(period.alias("bar_date"), F.col(key).alias("ticker"), *within).agg(
        F.min(trade).alias("first"), F.max(p).alias("high"), F.min(p).alias("low"), F.max(trade).alias("last"),
        F.sum(F.col(qty)).alias("volume"), *also)


def bars_of(sums: DataFrame) -> DataFrame:
    """The bars of ``build_bars`` from finer ``trade_sums``."""
    whole = sums.groupBy("ticker", "bar_date").agg(
        F.min("first").alias("first"), F.max("high").alias("high"), F.min("low").alias("low"), F.max("last").alias("last"),
        F.sum("volume").alias("volume"))
    return whole.select("ticker", "bar_date", F.col("first.price").alias("open"), "high", "low", F.col("last.price").alias("close"),
                        F.col("volume").cast("double").alias("volume"))


def union_series(frames: list[DataFrame]) -> DataFrame:
    """A3: concatenate series; None and empty frames are skipped, nothing left is an error.

    ``isEmpty`` reads at most one row of a frame.
    """
    frames = [f for f in frames if f is not None and not f.isEmpty()]
    if not frames:
        raise RuntimeError("No price data for any ticker.")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def index_series(df: DataFrame, name: str, date_col: str = "bar_date", value_col: str = "close") -> DataFrame:
    """A4: keep the date and the index level, renamed to the index name."""
    return df.select(F.col(date_col).alias("bar_date"), F.col(value_col).cast("double").alias(name))


def join_index(prices: DataFrame, *indexes: DataFrame) -> DataFrame:
    """A5: left join each index series on the date; unmatched dates stay NULL.

    An index has one row per calendar period, so it is bounded by the
    calendar, not by the data; Spark's size estimate decides the broadcast.
    """
    out = prices
    for idx in indexes:
        out = out.join(idx, "bar_date", "left")
    return out
