"""Blocked layout: results must not depend on the block size, and the column
EWM must equal the pandas recursion."""

import datetime

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from barlab.operators.ewm import EwmSpec, add_ewm, carries, depth, ewm_column, ewm_series_pandas, sub_rows_for
from barlab.operators.indicators import compute_features
from barlab.operators.series import blocked, finish, number_rows
from barlab.params import LabelParams, SeriesLayout
from barlab.sources import tables as T
from conftest import SF_SMALL, approx_equal_frames


def test_number_rows_is_dense_per_key(spark):
    bars = T.bars(spark, SF_SMALL)
    got = number_rows(bars, ["ticker"], "bar_date", segment="month").toPandas()
    for _, g in got.groupby("ticker"):
        g = g.sort_values("bar_date")
        assert list(g["_rn"]) == list(range(len(g)))
        assert (g["_n"] == len(g)).all()


def test_features_do_not_depend_on_block_size(spark):
    bars = T.bars(spark, SF_SMALL)  # gappy weekly series, 91-231 rows per ticker
    labels = LabelParams(horizon=5, neutral_zone_pct=0.10)
    one = compute_features(bars, labels=labels).toPandas()
    small = compute_features(bars, layout=SeriesLayout(block_rows=37, segment="month"), labels=labels).toPandas()
    approx_equal_frames(one, small, ["ticker", "bar_date"], rel=1e-9, abs_=1e-7)


def test_ewm_matches_pandas_across_blocks(spark):
    rng = np.random.default_rng(7)
    n = 3000
    vals = np.cumsum(rng.normal(0, 1, n)) + 50
    vals[:17] = np.nan  # leading missing values seed later
    pdf = pd.DataFrame({"ticker": "X", "bar_date": pd.date_range("2000-01-03", periods=n, freq="D").date, "x": vals})
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    alphas = [0.2, 2 / 27, 1 / 14, 0.6]
    s = sub_rows_for(alphas)
    back = max(depth(a, s) for a in alphas)
    specs = [EwmSpec(f"y{i}", "x", a) for i, a in enumerate(alphas)]
    b = blocked(df, ["ticker"], "bar_date", block_rows=500, back=back, ahead=0, segment="year", sub_rows=s)
    got = finish(add_ewm(b, ["ticker"], specs, s)).orderBy("bar_date").toPandas()
    for i, a in enumerate(alphas):
        want = ewm_series_pandas(vals, a)
        y = got[f"y{i}"].to_numpy(dtype=float)
        assert np.isnan(y[:17]).all()
        np.testing.assert_allclose(y[17:], want[17:], rtol=1e-12, atol=1e-9)


def test_carries_cover_precision():
    for a in (0.2, 2 / 13, 2 / 27, 1 / 14, 0.01):
        s = sub_rows_for([a])
        m = carries(a, s)
        assert (1 - a) ** (m * s) / a < 1e-16


def test_hot_key_spreads_over_blocks(spark):
    """One ticker with most of the rows: its rows go to many (key, block)
    partitions, and the features equal the single-block computation."""
    import datetime as dt

    rows = []
    for t, n in (("HOT", 2400), ("A", 300), ("B", 300)):
        for i in range(n):
            c = 100 + ((i * 37) % 23) - ((i * 11) % 7) + (0 if t == "HOT" else 5)
            rows.append((t, dt.date(2000, 1, 3) + dt.timedelta(days=i), c - 0.5, c + 1.0, c - 1.5, float(c), 1000.0 + i))
    bars = spark.createDataFrame(rows, "ticker string, bar_date date, open double, high double, low double, close double, volume double")
    blocked_df = blocked(bars, ["ticker"], "bar_date", block_rows=400, back=64, ahead=0, segment="year")
    per_key = blocked_df.groupBy("ticker").agg(F.countDistinct("_blk").alias("blocks")).collect()
    assert {r.ticker: r.blocks for r in per_key}["HOT"] == 6
    small = compute_features(bars, layout=SeriesLayout(block_rows=400)).toPandas()
    one = compute_features(bars).toPandas()
    approx_equal_frames(one, small, ["ticker", "bar_date"], rel=1e-9, abs_=1e-7)


def _series(spark, values):
    rows = [("X", datetime.date(2000, 1, 1) + datetime.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, x double")


def test_ewm_weighs_a_gap(spark):
    got = ewm_column(_series(spark, [None, 1.0, 2.0, None, 4.0, 5.0]), "x", "y", alpha=0.5).orderBy("bar_date").collect()
    want = [None, 1.0, 1.5, 1.5, 3.0 + 1 / 6, 4.0 + 1 / 12]
    assert [r.y is None for r in got] == [w is None for w in want]
    np.testing.assert_allclose([r.y for r in got[1:]], want[1:], rtol=1e-12)


def test_ewm_with_gaps_matches_pandas_across_blocks(spark):
    rng = np.random.default_rng(11)
    vals = np.where(rng.random(2500) < 0.4, np.nan, np.cumsum(rng.normal(0, 1, 2500)) + 80)
    df = _series(spark, [None if np.isnan(v) else float(v) for v in vals])
    got = ewm_column(df, "x", "y", span=12, block_rows=500).orderBy("bar_date").toPandas()["y"].to_numpy(dtype=float)
    np.testing.assert_allclose(got, ewm_series_pandas(vals, 2 / 13), rtol=1e-11)


def test_rows_without_a_date_stay(spark):
    rows = [("X", None, 5.0), ("X", datetime.date(2000, 1, 2), None), (None, None, 1.0), ("X", datetime.date(2000, 1, 1), 2.0)]
    df = spark.createDataFrame(rows, "ticker string, bar_date date, x double")
    from barlab.operators.clean import ffill

    got = sorted((str(r.ticker), str(r.bar_date), r.x) for r in ffill(df, ["x"]).collect())
    assert got == [("None", "None", 1.0), ("X", "2000-01-01", 2.0), ("X", "2000-01-02", 2.0), ("X", "None", 5.0)]


def test_ewm_keeps_its_value_over_long_gaps(spark):
    rng = np.random.default_rng(5)
    n = 9000
    vals = np.cumsum(rng.normal(0, 1, n)) + 60
    vals[:3], vals[400:4700], vals[4701:5300], vals[5302:8900] = np.nan, np.nan, np.nan, np.nan  # thousands of rows, one and two observations between
    df = _series(spark, [None if np.isnan(v) else float(v) for v in vals])
    for span, block_rows in ((10, 16384), (12, 1000), (26, 300), (27, 2500)):
        got = ewm_column(df, "x", "y", span=span, block_rows=block_rows).orderBy("bar_date").toPandas()["y"].to_numpy(dtype=float)
        np.testing.assert_allclose(got, ewm_series_pandas(vals, 2 / (span + 1)), rtol=1e-11, err_msg=f"{span} {block_rows}")


def test_padded_changes_over_a_long_gap(spark):
    """Changes between padded values and the candle trend don't depend on where blocks end, however long a gap is."""
    import pandas as pd

    n = 7000
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"ticker": "T", "bar_date": pd.date_range("2000-01-01", periods=n), "open": 100 + rng.normal(0, 1, n)})
    pdf["close"] = pdf["open"] + rng.normal(0, 1, n)
    pdf["high"], pdf["low"], pdf["volume"] = pdf[["open", "close"]].max(axis=1) + 1, pdf[["open", "close"]].min(axis=1) - 1, rng.integers(1, 99, n) * 1.0
    pdf.loc[900:5900, ["close", "volume"]] = np.nan
    pdf["bar_date"] = pdf["bar_date"].dt.date
    bars = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                                 "ticker string, bar_date date, open double, close double, high double, low double, volume double")
    want = {c: pdf[s].ffill().pct_change(fill_method=None).to_numpy() for c, s in (("daily_return", "close"), ("volume_change", "volume"))}
    seen = []
    for block_rows in (512, 1024, 16384):
        out = compute_features(bars, layout=SeriesLayout(block_rows=block_rows)).select(
            "bar_date", "daily_return", "volume_change", "candle_hammer", "candle_inverted_hammer", "candle_shooting_star").orderBy("bar_date").toPandas()
        for c, w in want.items():
            np.testing.assert_allclose(out[c].to_numpy(dtype=float), w, rtol=1e-12, err_msg=f"{c} {block_rows}")
        seen.append(out.drop(columns=["daily_return", "volume_change"]).to_numpy().tolist())
    assert seen[0] == seen[1] == seen[2]
