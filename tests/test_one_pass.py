"""What several steps read is made once, and tables put together from one pass are those of their own passes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlab.operators import score as J
from barlab.operators.asof import asof_backward
from barlab.plans import registry_models as R
from barlab.plans.registry_models import _RULES
from barlab.sources import tables as T

BAR = "ticker string, bar_date date, open double, high double, low double, close double, volume double"


def counted(df, seen):
    """The same rows; ``seen`` adds up how many were made."""
    def note(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf
    return df.mapInPandas(note, df.schema)


@pytest.fixture
def seen(spark):
    return spark.sparkContext.accumulator(0)


def daily(spark, tickers=("A", "B"), n=90):
    day = dt.date(2020, 1, 1)
    rows = [(t, day + dt.timedelta(i), 10.0 + i % 7, 12.0 + i % 7, 9.0 + i % 7, 10.0 + (i * 5 + len(t)) % 11, 100.0 + i) for t in tickers for i in range(n)]
    return spark.createDataFrame(rows, BAR)


def test_scoring_makes_bars_and_history_once(spark, seen):
    bars = daily(spark)
    fund = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "ticker string, pe_ratio double")
    params = spark.createDataFrame([("pe_ratio", "standard", 1.5, 0.5)], "column string, kind string, a double, b double")
    out = J.score_tickers(counted(bars, seen), fund, None, params, _RULES)
    assert out.count() == 2 * len(_RULES)
    assert seen.value == bars.count()


@pytest.mark.parametrize("strategy", ["auto", "range"])
def test_asof_makes_the_right_side_once(spark, seen, strategy):
    left = daily(spark)
    right = spark.createDataFrame([("A", dt.date(2020, 1, 5), 1.0), ("B", dt.date(2020, 2, 1), 2.0), (None, dt.date(2020, 1, 1), 3.0)],
                                  "ticker string, available_date date, revenue double")
    out = asof_backward(left, counted(right, seen), "ticker", "bar_date", "available_date", ["revenue"], strategy=strategy)
    assert out.filter("revenue = 1").count() == 86 and out.count() == 180
    assert seen.value == 3


@pytest.fixture
def lines(spark, tmp_path):
    """Lines over six quarters, with weeks that span two of them, nulls, equal rows, and one key twice at two prices."""
    day = dt.datetime(2019, 11, 1)
    rows = [(i // 3, i % 3, i % 5, 1.0 + i % 4, 100.0 + i * 37 % 91 + 0.25, (i % 11) / 100, day + dt.timedelta(i)) for i in range(540)]
    rows += [rows[8], rows[9], (*rows[10][:4], 999.5, *rows[10][5:]), (7, 1, 2, None, 5.0, 0.01, day), (7, 1, 2, 2.0, None, 0.01, day),
             (7, 1, 2, 2.0, 8.0, None, day), (7, 1, 3, 2.0, 8.0, 0.02, None), (7, 1, None, 2.0, 8.0, 0.02, day), (7, 1, 4, 0.0, 8.0, 0.02, day)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_shipdate timestamp_ntz").write.parquet(f"{tmp_path}/lineitem.parquet")
    part = [(0, "A", 3, 10.0), (1, "A", 4, 11.0), (2, "B", 5, 12.0), (3, "B", 6, 13.0), (4, None, 7, 14.0)]
    spark.createDataFrame(part, "p_partkey long, p_brand string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    orders = [(i, 100.0 + i % 17, day + dt.timedelta(i)) for i in range(540)]
    spark.createDataFrame(orders, "o_orderkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path), len(rows)


def same(a, b):
    assert a.schema.simpleString() == b.schema.simpleString()
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_bars_and_quarters_are_those_of_their_own_passes(spark, lines):
    bars, quarters = T.bars_and_quarters(spark, lines[0])
    assert bars.count() > 150 and quarters.count() > 12
    same(bars, T.bars(spark, lines[0]))
    same(quarters, T.quarterly_raw(spark, lines[0]))


def test_open_and_close_are_first_and_last_trades(spark, lines):
    priced = T.priced_lines(spark, lines[0])
    order = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "price")
    week = F.to_date(F.date_trunc("week", "l_shipdate"))
    was = priced.groupBy(F.col("p_brand").alias("ticker"), week.alias("bar_date")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.sum("l_quantity").alias("volume"))
    same(T.bars(spark, lines[0]), was)


@pytest.mark.parametrize("step", ["_pre", "_full"])
def test_model_tables_read_the_lines_once(spark, seen, lines, monkeypatch, step):
    monkeypatch.setattr(R, "_CACHE", {})
    priced = T.priced_lines
    monkeypatch.setattr(T, "priced_lines", lambda *a: counted(priced(*a), seen))
    out = getattr(R, step)(spark, lines[0])
    assert (out.table if step == "_pre" else out).columns
    assert seen.value == priced(spark, lines[0]).count() == lines[1] - 1  # one has no part
