"""Driver tables and the fixtures derived from them (see FIXTURES.md).

Every fixture is a lazy DataFrame over the parquet tables, so its work grows
with the tables: bars from every ``lineitem`` row, quarterly figures from
every ``lineitem`` row, the index from every ``orders`` row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.session import cut_lineage
from barlab.sources.bars import bars_of, build_bars, trade_sums

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def priced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).withColumn(
        "price", F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")))


_WEEKLY = {"key": "p_brand", "ts": "l_shipdate", "price": "price", "qty": "l_quantity", "grain": "week",
           "tiebreak": ("l_orderkey", "l_linenumber")}


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly bars per brand (ticker = p_brand); open/close by (ship date, order, line, price)."""
    return build_bars(priced_lines(spark, sf_dir), **_WEEKLY)


def _quarter_end():
    return F.date_sub(F.add_months(F.to_date(F.date_trunc("quarter", F.col("l_shipdate"))), 3), 1).alias("quarter_end")


def _incomes():
    """Exact decimal sums of revenue and net income."""
    ext = F.col("l_extendedprice").cast("decimal(18,2)")
    return (F.sum(ext * (F.lit(1) - F.col("l_discount")).cast("decimal(4,2)")).alias("revenue"),
            F.sum(ext * (F.lit(0.05) - F.col("l_discount")).cast("decimal(4,2)")).alias("net_income"))


def quarterly_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly revenue / net income per brand with exact decimal sums."""
    sums = priced_lines(spark, sf_dir).groupBy(F.col("p_brand").alias("ticker"), _quarter_end()).agg(*_incomes())
    return sums.select("ticker", "quarter_end", F.col("revenue").cast("double"), F.col("net_income").cast("double"))


def bars_and_quarters(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``bars`` and ``quarterly_raw`` from one pass over the lines: sums per brand, week and quarter are
    stored (their number is bounded by brands and calendar), and both tables are put together from them."""
    sums = cut_lineage(trade_sums(priced_lines(spark, sf_dir), **_WEEKLY, within=(_quarter_end(),), also=_incomes()))
    quarters = sums.groupBy("ticker", "quarter_end").agg(F.sum("revenue").cast("double").alias("revenue"),
                                                         F.sum("net_income").cast("double").alias("net_income"))
    return bars_of(sums), quarters


def index_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekly index series from orders: vix = sample std of totals / 1000, nifty = mean total."""
    o = table(spark, sf_dir, "orders").select("o_orderdate", "o_totalprice")
    return o.groupBy(F.to_date(F.date_trunc("week", F.col("o_orderdate"))).alias("bar_date")).agg(
        (F.stddev_samp("o_totalprice") / 1000).alias("vix"), F.avg("o_totalprice").alias("nifty"))


NULL_RATIO_TICKERS = ("Brand#3", "Brand#17")


def fundamentals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot per brand; two brands get a NULL P/E ratio."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_retailprice", "p_size", "p_partkey")
    return p.groupBy(F.col("p_brand").alias("ticker")).agg(
        F.when(F.col("p_brand").isin(*NULL_RATIO_TICKERS), F.lit(None).cast("double"))
        .otherwise(F.avg("p_retailprice") / F.avg("p_size")).alias("pe_ratio"),
        (F.avg("p_retailprice") / 10).alias("eps"),
        (F.sum("p_retailprice") * 1e6).alias("market_cap"),
        (F.avg("p_size") * 2).alias("debt_to_equity"),
        (F.avg("p_size") / 25).alias("current_ratio"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic pseudo-scores p in [0, 1] with a 0/1 label (for metrics and buckets)."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = ((F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31) % 1001) / F.lit(1000.0)
    return li.select(p.alias("p"), (F.col("l_quantity") > 25).cast("int").alias("label"))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table recast as a training run log."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("run_id"),
        F.col("event_type").alias("run_name"),
        F.col("ts").alias("start_time"),
        (F.col("value") / 500).alias("accuracy"),
        F.col("user_id").cast("string").alias("model_name"),
        F.col("props"),
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form statement lines (ticker, item, period, value): quarterly revenue and
    net income, yearly cash flows and current assets / liabilities per brand."""
    q = quarterly_raw(spark, sf_dir)
    quarterly = q.select("ticker", F.lit("Total Revenue").alias("item"), F.col("quarter_end").alias("period"),
                         F.col("revenue").alias("value")).unionByName(
        q.select("ticker", F.lit("Net Income").alias("item"), F.col("quarter_end").alias("period"),
                 F.col("net_income").alias("value")))
    li = priced_lines(spark, sf_dir)
    yearly = li.groupBy(F.col("p_brand").alias("ticker"),
                        F.make_date(F.year("l_shipdate"), F.lit(12), F.lit(31)).alias("period")).agg(
        F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("ocf"),
        F.sum(F.col("l_extendedprice") * (F.lit(0.03) - F.col("l_discount"))).alias("fcf"),
        F.sum("l_extendedprice").alias("ca"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("cl"),
    )
    items = F.array(*[F.struct(F.lit(n).alias("item"), F.col(c).alias("value")) for n, c in
                      (("Operating Cash Flow", "ocf"), ("Free Cash Flow", "fcf"),
                       ("Current Assets", "ca"), ("Current Liabilities", "cl"))])
    long_yearly = yearly.select("ticker", "period", F.explode(items).alias("s")).select(
        "ticker", "s.item", "period", "s.value")
    return quarterly.unionByName(long_yearly)
