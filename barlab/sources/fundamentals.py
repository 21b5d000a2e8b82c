"""Company data: statement line items and the per-ticker snapshot.

Statements arrive in long form ``(ticker, item, period, value)``: one row per
reported line item and period. Everything here is one conditional
aggregation grouped by ticker (partial aggregates before the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import tdiv

# Statement line items read by the snapshot (fixed names of the quote service).
REVENUE = "Total Revenue"
NET_INCOME = "Net Income"
OPERATING_CF = "Operating Cash Flow"
FREE_CF = "Free Cash Flow"
CURRENT_ASSETS = "Current Assets"
CURRENT_LIABILITIES = "Current Liabilities"

SNAPSHOT_COLS = ("pe_ratio", "eps", "market_cap", "debt_to_equity", "latest_revenue", "latest_net_income",
                 "operating_cash_flow", "free_cash_flow", "current_ratio")
SCORING_SNAPSHOT_COLS = ("pe_ratio", "eps", "market_cap", "debt_to_equity", "current_ratio")


def latest_item(item: str) -> Column:
    """A6 as an aggregate: value of ``item`` in its newest period (the value may be NULL)."""
    is_item = F.col("item") == item
    return F.max_by(F.when(is_item, F.col("value")), F.when(is_item, F.col("period")))


def latest_statement_item(long_stmt: DataFrame, item: str, alias: str) -> DataFrame:
    """Newest-period value of one line item per ticker."""
    return long_stmt.groupBy("ticker").agg(latest_item(item).alias(alias))


def current_ratio(assets: Column, liabilities: Column) -> Column:
    """Current assets / current liabilities; NULL when either is missing or liabilities are 0."""
    return tdiv(assets, liabilities)


def fundamentals_snapshot(info: DataFrame, long_stmt: DataFrame, scoring: bool = False) -> DataFrame:
    """One row per ticker with the nine measures (``scoring``: the five the scorer reads).

    ``info`` carries pe_ratio, eps, market_cap, debt_to_equity per ticker.
    """
    items = long_stmt.groupBy("ticker").agg(
        latest_item(REVENUE).alias("latest_revenue"),
        latest_item(NET_INCOME).alias("latest_net_income"),
        latest_item(OPERATING_CF).alias("operating_cash_flow"),
        latest_item(FREE_CF).alias("free_cash_flow"),
        current_ratio(latest_item(CURRENT_ASSETS), latest_item(CURRENT_LIABILITIES)).alias("current_ratio"),
    )
    base = info.select("ticker", "pe_ratio", "eps", "market_cap", "debt_to_equity")
    snap = base.join(items, "ticker", "full")
    cols = SCORING_SNAPSHOT_COLS if scoring else SNAPSHOT_COLS
    return snap.select("ticker", *[F.col(c).cast("double").alias(c) for c in cols])
