"""Known-answer edge rows (FIXTURES.md part 3) and small property checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barlab.operators import clean, confidence, eda, labels, metrics, project
from barlab.operators.asof import asof_backward
from barlab.operators.indicators import compute_features, run_feature_engineering
from barlab.operators.quarterly import quarterly_history
from barlab.operators.series import number_rows
from barlab.params import LabelParams, SeriesLayout
from barlab.sources.synthetic import synthetic_bars, synthetic_fundamentals, synthetic_index


def _bars(spark, closes, opens=None, highs=None, lows=None, vols=None, ticker="T", start=dt.date(2020, 1, 6)):
    n = len(closes)
    opens = opens or closes
    highs = highs or [max(o, c) for o, c in zip(opens, closes)]
    lows = lows or [min(o, c) for o, c in zip(opens, closes)]
    vols = vols or [100.0] * n
    rows = [(ticker, start + dt.timedelta(days=7 * i), float(opens[i]), float(highs[i]), float(lows[i]),
             float(closes[i]), float(vols[i])) for i in range(n)]
    return spark.createDataFrame(rows, "ticker string, bar_date date, open double, high double, low double, close double, volume double")


def test_rising_closes_rsi_is_null(spark):
    f = compute_features(_bars(spark, [float(i) for i in range(1, 20)])).orderBy("bar_date").collect()
    assert f[14]["RSI_14"] is None and f[18]["RSI_14"] is None  # avg loss 0 -> NULL, not 100
    assert f[13]["RSI_14"] is None  # fewer than 14 differences


def test_flat_bars_flags_zero_and_stoch_null(spark):
    f = compute_features(_bars(spark, [5.0] * 20)).collect()
    for r in f:
        assert r["candle_doji"] == 0 and r["candle_bullish_marubozu"] == 0 and r["candle_hammer"] == 0
        assert r["Stoch_K"] is None


def test_zero_previous_volume(spark):
    f = compute_features(_bars(spark, [1.0, 2.0, 3.0], vols=[0.0, 10.0, 20.0])).orderBy("bar_date").collect()
    assert f[1]["volume_change"] is None
    assert f[2]["volume_change"] == pytest.approx(1.0)


def test_forward_return_exactly_at_zone_is_dropped(spark):
    closes = [100.0, 100.0, 110.0, 90.0]  # horizon 1: +0 %, +10 %, -18.2 %
    out = compute_features(_bars(spark, closes), labels=LabelParams(horizon=1, neutral_zone_pct=0.10)).orderBy("bar_date").collect()
    assert [r["label"] for r in out] == [0]  # +0 neutral, exactly +10 % neutral (strict), -18 % -> 0
    assert out[0]["bar_date"] == dt.date(2020, 1, 20)


def test_short_series_has_no_labelled_rows(spark):
    out = run_feature_engineering(_bars(spark, [float(i % 5 + 1) for i in range(20)]),
                                  labels=LabelParams(horizon=5, neutral_zone_pct=0.0))
    assert out.count() == 0


def test_rsi_zones(spark):
    df = spark.createDataFrame([(30.0,), (70.0,), (-1.0,), (102.0,), (30.0001,)], "RSI_14 double")
    got = [r[0] for r in df.select(eda.rsi_zone()).collect()]
    assert got == ["Oversold", "Neutral", None, None, "Neutral"]


def test_confidence_one_in_no_bucket(spark):
    df = spark.createDataFrame([(1.0, 1), (0.0, 0), (0.51, 1), (0.6, 0)], "p double, label int")
    b = {r["confidence_range"]: r for r in confidence.confidence_buckets(df).collect()}
    assert sum(r["n_predictions"] for r in b.values()) == 2
    # |0.6 - 0.5| * 2 is 0.19999999999999996 in floating point: bucket [0.15, 0.20)
    assert b["0.00-0.05"]["accuracy"] == 1.0 and b["0.15-0.20"]["accuracy"] == 0.0


def test_threshold_sweep_empty(spark):
    df = spark.createDataFrame([(0.5, 1), (0.52, 0)], "p double, label int")
    rows = {r["threshold"]: r for r in confidence.threshold_sweep(df).collect()}
    assert rows[0.7]["n_acted"] == 0 and rows[0.7]["coverage_pct"] == 0.0 and rows[0.7]["accuracy_on_acted"] is None
    assert rows[0.5]["n_acted"] == 2


def test_metrics_when_class_one_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 0)], "label int, prediction int")
    m = metrics.binary_metrics(df).first()
    assert m["precision"] == 0.0 and m["f1_score"] == 0.0 and m["recall"] == 0.0
    assert m["accuracy"] == pytest.approx(1 / 3)


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), 5.0, 2.0, None), ("B", dt.date(2020, 1, 1), 5.0, 2.0, None)],
                               "ticker string, bar_date date, open double, pe_ratio double, current_ratio double")
    mm = clean.minmax_transform(df, clean.minmax_fit(df, ["open"]), ["open"]).collect()
    assert all(r["open_norm"] == 0.0 for r in mm)
    st = clean.standard_transform(df, clean.standard_fit(df, ["pe_ratio", "current_ratio"]),
                                  ["pe_ratio", "current_ratio"]).collect()
    assert all(r["pe_ratio"] == 0.0 and r["current_ratio"] == 0.0 for r in st)


def test_all_null_column_median_stays_null(spark):
    df = spark.createDataFrame([("A", dt.date(2020, 1, 1), None), ("A", dt.date(2020, 1, 8), None)],
                               "ticker string, bar_date date, x double")
    out = clean.impute(df, ["x"]).collect()
    assert all(r["x"] is None for r in out)


def test_ffill_crosses_blocks(spark):
    rows = [("A", dt.date(2020, 1, 1) + dt.timedelta(days=i), 1.0 if i == 0 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "ticker string, bar_date date, x double")
    out = clean.ffill(df, ["x"], block_rows=4).collect()
    assert all(r["x"] == 1.0 for r in out)


def test_streak_sequence(spark):
    # YoY net-income growth +,+,0,-,NULL,+ needs values 4 quarters back: build 10 quarters
    ni = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 1.0, 0.5, None, 5.0]
    rows = [("T", dt.date(2019, 3, 31) + dt.timedelta(days=91 * i), 10.0, ni[i]) for i in range(10)]
    raw = spark.createDataFrame(rows, "ticker string, quarter_end date, revenue double, net_income double")
    h = quarterly_history(raw.withColumn("quarter_end", F.last_day("quarter_end")), qp=__import__(
        "barlab.params", fromlist=["QuarterlyParams"]).QuarterlyParams(lookback=10)).orderBy("quarter_end").collect()
    yoy = [r["net_income_yoy_growth"] for r in h]
    streak = [r["earnings_growth_streak"] for r in h]
    # padded NULL (row 8) keeps the previous value 0.5 -> 0.5 / 1 - 1 < 0
    assert yoy[4] == pytest.approx(1.0) and yoy[5] == pytest.approx(2.0) and yoy[6] == pytest.approx(0.0)
    assert streak[4:7] == [1, 2, -1]


def test_asof_duplicate_keys_last_wins_with_null(spark):
    left = spark.createDataFrame([("T", dt.date(2020, 3, 1)), ("T", dt.date(2020, 1, 1))], "ticker string, bar_date date")
    right = spark.createDataFrame([("T", dt.date(2020, 2, 1), "q1", 1.0), ("T", dt.date(2020, 2, 1), "q2", None)],
                                  "ticker string, available_date date, quarter_end string, revenue double")
    for strategy in ("range", "scan"):
        out = {r["bar_date"]: r["revenue"] for r in asof_backward(left, right, "ticker", "bar_date", "available_date",
                                                                   ["revenue", "quarter_end"], "quarter_end", strategy).collect()}
        assert out[dt.date(2020, 3, 1)] is None and out[dt.date(2020, 1, 1)] is None


def test_asof_plans_agree(spark):
    left = spark.range(3000).select((F.col("id") % 7).cast("string").alias("ticker"),
                                    F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 13 % 900).cast("int")).alias("bar_date")).dropDuplicates()
    right = spark.range(400).select((F.col("id") % 7).cast("string").alias("ticker"),
                                    F.date_add(F.lit("2019-12-01").cast("date"), (F.col("id") * 37 % 950).cast("int")).alias("available_date"),
                                    F.col("id").cast("string").alias("quarter_end"), (F.col("id") * 1.5).alias("revenue"))
    a = asof_backward(left, right, "ticker", "bar_date", "available_date", ["revenue"], "quarter_end", "range")
    b = asof_backward(left, right, "ticker", "bar_date", "available_date", ["revenue"], "quarter_end", "scan", block_rows=50)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_projection_rules(spark):
    short = _bars(spark, [float(i + 1) for i in range(59)])
    assert project.growth_stats(short).count() == 0
    rows = [("T", dt.date(2018, 12, 31) - dt.timedelta(days=7 * (79 - i)), 10.0 + i) for i in range(80)]
    df = spark.createDataFrame(rows, "ticker string, bar_date date, close double")
    p = project.project_price(df).orderBy("t").collect()
    assert p[0]["future_date"] == dt.date(2019, 12, 31) and p[4]["future_date"] == dt.date(2023, 12, 31)


def test_global_rank_is_dense(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), F.col("id"))
    r = eda.global_rank(df, ["v", "id"], partitions=7).orderBy("_rank").collect()
    assert [x["_rank"] for x in r] == list(range(1, 1001))
    assert [x["v"] for x in r] == sorted(x["v"] for x in r)


def test_walk_forward_folds_cover_tail(spark):
    df = spark.range(600).select((F.col("id") % 3).cast("string").alias("ticker"),
                                 F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 3).cast("int")).alias("bar_date"))
    s = labels.fold_summary(labels.walk_forward_folds(df, 5, align="row")).orderBy("fold").collect()
    assert [r["test_rows"] for r in s] == [100] * 5
    assert s[0]["train_rows"] == 100
    # date alignment: a date is never split between folds
    d = labels.walk_forward_folds(df, 5, align="date")
    assert d.groupBy("bar_date").agg(F.countDistinct(F.coalesce("fold", F.lit(-1))).alias("k")).filter("k > 1").count() == 0
    assert d.filter(F.col("fold").isNotNull()).count() == 498


def test_number_rows_segments(spark):
    df = spark.range(100).select(F.lit("A").alias("k"), F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") * 5).cast("int")).alias("d"))
    r = number_rows(df, ["k"], "d", segment="month").orderBy("d").collect()
    assert [x["_rn"] for x in r] == list(range(100))


def test_synthetic_generators(spark):
    b = synthetic_bars(spark, ["A", "B"], n=120, seed=42)
    assert b.count() == 240
    assert b.filter((F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close"))).count() == 0
    assert synthetic_index(spark, "vix", n=50).filter(F.col("vix") < 8).count() == 0
    assert synthetic_fundamentals(spark, ["A", "B"]).count() == 2


def test_relational_sink_skips_empty_quarterly(spark):
    from barlab.sources import sinks

    prices = _bars(spark, [1.0, 2.0])
    fund = spark.createDataFrame([("T", 10.0)], "ticker string, pe_ratio double")
    empty = spark.createDataFrame([], "ticker string, revenue double")
    written = sinks.write_raw_tables(prices, fund, empty, prefix="t_")
    assert written == ["t_raw_prices", "t_raw_fundamentals"]
    assert sinks.read_table(spark, "t_raw_prices").count() == 2
    assert sinks.sql_source(spark, "SELECT count(*) AS n FROM t_raw_fundamentals").first()["n"] == 1


def test_correlation_pairwise_and_constant(spark):
    rows = [(float(i), 2.0 * i + 1 if i % 3 else None, 0.1, float((i * 7) % 5)) for i in range(30)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    r = {(x["a"], x["b"]): x["r"] for x in eda.correlation_long(df, ["a", "b", "c", "d"]).collect()}
    assert r[("a", "b")] == pytest.approx(1.0)          # pairwise complete rows only
    assert r[("a", "c")] is None and r[("b", "c")] is None  # constant column
    pdf = df.toPandas()
    assert r[("a", "d")] == pytest.approx(pdf["a"].corr(pdf["d"]))


def test_run_pipeline_writes_stage_tables(spark):
    import os
    import tempfile

    from barlab.operators.quarterly import quarterly_history
    from barlab.plans.pipeline import run_pipeline
    from barlab.sources import bars as B
    from barlab.sources import tables as T
    from conftest import SF_SMALL

    out = tempfile.mkdtemp(prefix="barlab-pipe-")
    prices = B.join_index(T.bars(spark, SF_SMALL), T.index_levels(spark, SF_SMALL))
    paths = run_pipeline(prices, T.fundamentals(spark, SF_SMALL), quarterly_history(T.quarterly_raw(spark, SF_SMALL)), out)
    for k in ("processed", "featured", "price_params", "ratio_params"):
        assert os.path.isdir(paths[k])
    featured = spark.read.parquet(paths["featured"])
    assert featured.count() > 0
    assert featured.filter(F.col("label").isNull()).count() == 0
    assert "pe_ratio" in featured.columns and "earnings_growth_streak" in featured.columns


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    rows = [(i % 3, float((i * 7919) % 101) if i % 5 else None, float(i % 4)) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, x double, y double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r["column"]: r["q"] for r in eda.exact_quantiles(df, ["x", "y"], probs).collect()}
    pdf = df.toPandas()
    for c in ("x", "y"):
        np.testing.assert_allclose(got[c], np.nanpercentile(pdf[c].to_numpy(dtype=float), [p * 100 for p in probs]))
    by = {(r["g"], r["column"]): r["q"] for r in eda.exact_quantiles(df, ["x"], [0.5], by="g").collect()}
    for g in range(3):
        assert by[(g, "x")][0] == pytest.approx(float(np.nanmedian(pdf[pdf.g == g]["x"].to_numpy(dtype=float))))


def test_duplicate_quintile_edges_raise(spark):
    df = spark.createDataFrame([(15.0, 0)] * 10 + [(16.0, 1)], "vix double, label int")
    with pytest.raises(ValueError):
        eda.sell_rate_by_quantile(df, "vix", 5)


def test_row_counts_isolate_errors(spark):
    from barlab.operators import lookup

    def broken():
        return spark.read.parquet("/nonexistent/barlab/table")

    out = {r["table"]: r for r in lookup.row_counts(spark, {"ok": lambda: _bars(spark, [1.0, 2.0]), "bad": broken}).collect()}
    assert out["ok"]["rows"] == 2 and out["ok"]["error"] is None
    assert out["bad"]["rows"] is None and out["bad"]["error"].startswith("error:")


def test_replaced_table_survives_a_broken_write(spark, tmp_path):
    from barlab.sources import sinks

    df = spark.createDataFrame([(1, "a"), (2, "b")], "i int, s string")
    with pytest.raises(Exception):
        sinks.read_replaced(spark, str(tmp_path), "t")
    first = sinks.replace_table(df, str(tmp_path), "t")
    second = sinks.replace_table(df.filter("i = 2"), str(tmp_path), "t")
    with pytest.raises(Exception, match="broken"):
        sinks.replace_table(df.withColumn("s", F.raise_error(F.lit("broken")).cast("string")), str(tmp_path), "t")
    assert [tuple(r) for r in sinks.read_replaced(spark, str(tmp_path), "t").collect()] == [(2, "b")]
    assert sinks.read_replaced(spark, str(tmp_path), "t", first).count() == 2
    assert [r.version for r in sinks.table_versions(spark, str(tmp_path), "t").collect()] == [first, second]
    sinks.replace_table(df.limit(0), str(tmp_path), "t")
    assert sinks.read_replaced(spark, str(tmp_path), "t").count() == 0


def test_describe_dates(spark):
    import datetime as dt

    rows = [(dt.date(2020, 1, d), None) for d in (1, 2, 4, 9)] + [(None, None)]
    got = {r["column"]: r for r in clean.describe_dates(spark.createDataFrame(rows, "a date, b timestamp")).collect()}
    a = got["a"]
    assert (a["count"], a["min"], a["q50"], a["mean"], a["max"]) == (4, dt.datetime(2020, 1, 1), dt.datetime(2020, 1, 3), dt.datetime(2020, 1, 4),
                                                                    dt.datetime(2020, 1, 9))
    assert got["b"]["count"] == 0 and got["b"]["q50"] is None
