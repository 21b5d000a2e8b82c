"""Registered queries for groups A6-A13, G (metrics), H, I, L, M and N."""

from __future__ import annotations

from pyspark.sql import functions as F

from barlab import oracle as O
from barlab.operators import confidence as H
from barlab.operators import eda as I
from barlab.operators import lookup as M
from barlab.operators import metrics as G
from barlab.operators import runlog as N
from barlab.operators.asof import attach_quarterly
from barlab.operators.indicators import run_feature_engineering
from barlab.operators.project import growth_stats, project_price
from barlab.operators.quarterly import quarterly_history
from barlab.plans.registry import FIXTURE_LABELS, register
from barlab.sources import fundamentals as FU
from barlab.sources import tables as T

W = O.with_
FEAT = (O.BARS, O.features_ctes())
CTX_SQL = ("ctx AS MATERIALIZED (SELECT f.*, i.vix, i.nifty, d.pe_ratio, d.eps, d.market_cap, d.debt_to_equity, "
           "d.current_ratio FROM featured f LEFT JOIN idx i ON f.bar_date = i.bar_date LEFT JOIN fund d ON f.ticker = d.ticker)")
CTX = FEAT + (O.INDEX, O.FUND, CTX_SQL)


def _featured(spark, sf, ticker=None):
    """Featured rows; with a ticker, of that one alone: the filter reaches the scan."""
    bars = T.bars(spark, sf)
    return run_feature_engineering(bars.filter(F.col("ticker") == ticker) if ticker else bars, labels=FIXTURE_LABELS)


def _ctx(spark, sf):
    return _featured(spark, sf).join(T.index_levels(spark, sf), "bar_date", "left") \
        .join(T.fundamentals(spark, sf), "ticker", "left")


def _scored(spark, sf):
    return T.scored(spark, sf).withColumn("prediction", (F.col("p") >= 0.5).cast("int"))


# ---------------------------------------------------------------- A6-A8, A13
@register("a06_latest_statement_item", W(O.QUARTERLY_RAW, O.STATEMENTS) +
          f"SELECT ticker, {O.rnd(O.latest_item_sql('Total Revenue'))} AS latest_revenue FROM statements GROUP BY ticker")
def _a06(spark, sf):
    return FU.latest_statement_item(T.statements(spark, sf), FU.REVENUE, "latest_revenue")


@register("a07_current_ratio", W(O.QUARTERLY_RAW, O.STATEMENTS) +
          "SELECT ticker, " + O.rnd(f"{O.latest_item_sql('Current Assets')} / NULLIF({O.latest_item_sql('Current Liabilities')}, 0)")
          + " AS current_ratio FROM statements GROUP BY ticker")
def _a07(spark, sf):
    st = T.statements(spark, sf)
    return st.groupBy("ticker").agg(
        FU.current_ratio(FU.latest_item(FU.CURRENT_ASSETS), FU.latest_item(FU.CURRENT_LIABILITIES)).alias("current_ratio"))


@register("a08_fundamentals_snapshot", W(O.QUARTERLY_RAW, O.STATEMENTS, O.FUND, O.SNAPSHOT) +
          "SELECT ticker, " + O.r6(*FU.SNAPSHOT_COLS) + " FROM snapshot")
def _a08(spark, sf):
    return FU.fundamentals_snapshot(T.fundamentals(spark, sf), T.statements(spark, sf))


@register("a08_scoring_snapshot", W(O.QUARTERLY_RAW, O.STATEMENTS, O.FUND, O.SNAPSHOT) +
          "SELECT ticker, " + O.r6(*FU.SCORING_SNAPSHOT_COLS) + " FROM snapshot")
def _a08s(spark, sf):
    return FU.fundamentals_snapshot(T.fundamentals(spark, sf), T.statements(spark, sf), scoring=True)


_Q_COLS = ("revenue", "net_income", "revenue_yoy_growth", "net_income_yoy_growth", "revenue_qoq_growth",
           "net_income_qoq_growth")


@register("a13_missing_quarterly", W(O.BARS) + "SELECT ticker, bar_date, " +
          ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in _Q_COLS) + ", CAST(NULL AS INTEGER) AS earnings_growth_streak FROM bars")
def _a13(spark, sf):
    return attach_quarterly(T.bars(spark, sf).select("ticker", "bar_date"), None)


# ---------------------------------------------------------------- G metrics
_SC_CELLS = ("count(*) FILTER (WHERE label = 1 AND p >= 0.5) AS tp, count(*) FILTER (WHERE label = 0 AND p >= 0.5) AS fp, "
             "count(*) FILTER (WHERE label = 1 AND p < 0.5) AS fn, count(*) FILTER (WHERE label = 0 AND p < 0.5) AS tn")


@register("g08_binary_metrics", W(O.SCORED) + "SELECT " + ", ".join([
    O.rnd("(tp + tn) / NULLIF(CAST(tp + fp + fn + tn AS DOUBLE), 0)") + " AS accuracy",
    O.rnd("coalesce(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0)") + " AS precision",
    O.rnd("coalesce(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0)") + " AS recall",
    O.rnd("coalesce(2 * tp / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0)") + " AS f1_score"])
          + f" FROM (SELECT {_SC_CELLS} FROM scored)")
def _g08(spark, sf):
    return G.binary_metrics(_scored(spark, sf))


@register("g09_confusion_matrix", W(O.SCORED) +
          "SELECT label, CAST(p >= 0.5 AS INTEGER) AS prediction, count(*) AS n FROM scored GROUP BY ALL")
def _g09(spark, sf):
    return G.confusion_matrix(_scored(spark, sf))


def _report_sql() -> str:
    p1, r1 = "coalesce(tp / NULLIF(CAST(tp + fp AS DOUBLE), 0), 0)", "coalesce(tp / NULLIF(CAST(tp + fn AS DOUBLE), 0), 0)"
    p0, r0 = "coalesce(tn / NULLIF(CAST(tn + fn AS DOUBLE), 0), 0)", "coalesce(tn / NULLIF(CAST(tn + fp AS DOUBLE), 0), 0)"
    f1 = "coalesce(2 * tp / NULLIF(CAST(2 * tp + fp + fn AS DOUBLE), 0), 0)"
    f0 = "coalesce(2 * tn / NULLIF(CAST(2 * tn + fn + fp AS DOUBLE), 0), 0)"
    s1, s0, n = "(tp + fn)", "(tn + fp)", "(tp + fn + tn + fp)"
    rows = [
        ("'0'", p0, r0, f0, s0), ("'1'", p1, r1, f1, s1),
        ("'macro avg'", f"({p0} + {p1}) / 2", f"({r0} + {r1}) / 2", f"({f0} + {f1}) / 2", n),
        ("'weighted avg'", f"coalesce(({p0} * {s0} + {p1} * {s1}) / NULLIF(CAST({n} AS DOUBLE), 0), 0)",
         f"coalesce(({r0} * {s0} + {r1} * {s1}) / NULLIF(CAST({n} AS DOUBLE), 0), 0)",
         f"coalesce(({f0} * {s0} + {f1} * {s1}) / NULLIF(CAST({n} AS DOUBLE), 0), 0)", n),
    ]
    parts = [f"SELECT {c} AS class, {O.rnd(p)} AS precision, {O.rnd(r)} AS recall, {O.rnd(f)} AS f1, {s} AS support FROM cells"
             for c, p, r, f, s in rows]
    return W(O.SCORED, f"cells AS (SELECT {_SC_CELLS} FROM scored)") + " UNION ALL ".join(parts)


@register("g10_classification_report", _report_sql())
def _g10(spark, sf):
    return G.classification_report(_scored(spark, sf))


@register("g02_class_weights", W(*FEAT) +
          "SELECT label, " + O.rnd("sum(count(*)) OVER () / (2.0 * count(*))") + " AS weight FROM featured GROUP BY label")
def _g02(spark, sf):
    return G.class_weights(_featured(spark, sf))


@register("g03_positive_weight", W(*FEAT) +
          "SELECT " + O.rnd("count(*) FILTER (WHERE label = 0) / CAST(greatest(count(*) FILTER (WHERE label = 1), 1) AS DOUBLE)")
          + " AS pos_weight FROM featured")
def _g03(spark, sf):
    return G.positive_weight(_featured(spark, sf))


# ---------------------------------------------------------------- H confidence
@register("h01_confidence_score", W(O.SCORED) +
          "SELECT " + O.rnd("p") + " AS p, label, CAST(p >= 0.5 AS INTEGER) AS prediction, " + O.rnd("abs(p - 0.5) * 2") +
          " AS confidence, CAST(CAST(p >= 0.5 AS INTEGER) = label AS INTEGER) AS correct FROM scored")
def _h01(spark, sf):
    return H.with_confidence(T.scored(spark, sf))


def _half_away(expr: str, d: int) -> str:
    m = 10 ** d
    return f"(round(({expr}) * {m}) / {m})"


def _buckets_sql() -> str:
    edges = H.CONFIDENCE_EDGES
    case = "CASE " + " ".join(
        f"WHEN conf >= {lo} AND conf < {hi} THEN '{lo:.2f}-{hi:.2f}'" for lo, hi in zip(edges[:-1], edges[1:])) + " END"
    return (W(O.SCORED, "s AS (SELECT abs(p - 0.5) * 2 AS conf, CAST(CAST(p >= 0.5 AS INTEGER) = label AS INTEGER) AS correct FROM scored)",
              f"g AS (SELECT {case} AS confidence_range, count(*) AS n_predictions, avg(correct) AS acc FROM s GROUP BY 1)")
            + "SELECT confidence_range, n_predictions, "
            + O.rnd(_half_away("100 * n_predictions / CAST(sum(n_predictions) OVER () AS DOUBLE)", 1)) + " AS coverage_pct, "
            + O.rnd(_half_away("acc", 4)) + " AS accuracy FROM g QUALIFY confidence_range IS NOT NULL")


@register("h02_confidence_buckets", _buckets_sql())
def _h02(spark, sf):
    return H.confidence_buckets(T.scored(spark, sf))


def _sweep_sql() -> str:
    parts = []
    for t in H.THRESHOLDS:
        lo = repr(1 - t)
        acted = f"(p >= {t} OR p <= CAST('{lo}' AS DOUBLE))"
        parts.append(
            f"SELECT CAST({t} AS DOUBLE) AS threshold, count(*) FILTER (WHERE {acted}) AS n_acted, "
            f"count(*) FILTER (WHERE {acted} AND CAST(p >= 0.5 AS INTEGER) = label) AS c, count(*) AS n FROM scored")
    return (W(O.SCORED, "sw AS (" + " UNION ALL ".join(parts) + ")")
            + "SELECT " + O.rnd("threshold") + " AS threshold, n_acted, "
            + O.rnd(f"CASE WHEN n_acted = 0 THEN 0.0 ELSE {_half_away('100 * n_acted / CAST(n AS DOUBLE)', 1)} END") + " AS coverage_pct, "
            + O.rnd(f"CASE WHEN n_acted > 0 THEN {_half_away('c / CAST(n_acted AS DOUBLE)', 4)} END") + " AS accuracy_on_acted FROM sw")


@register("h03_threshold_sweep", _sweep_sql())
def _h03(spark, sf):
    return H.threshold_sweep(T.scored(spark, sf))


def _report_parts_sql() -> str:
    """The three tables of the report under one heading."""
    null = "CAST(NULL AS {})".format
    return (f"SELECT 'overall' AS part, 'all' AS item, {null('BIGINT')} AS n, {null('DOUBLE')} AS coverage_pct, "
            f"(SELECT accuracy FROM ({_overall_sql()})) AS accuracy "
            f"UNION ALL SELECT 'buckets', confidence_range, n_predictions, coverage_pct, accuracy FROM ({_buckets_sql()}) "
            f"UNION ALL SELECT 'thresholds', printf('%.2f', threshold), n_acted, coverage_pct, accuracy_on_acted FROM ({_sweep_sql()})")


def _overall_sql() -> str:
    return W(O.SCORED) + "SELECT " + O.rnd("avg(CAST(CAST(p >= 0.5 AS INTEGER) = label AS INTEGER))") + " AS accuracy FROM scored"


@register("h04_model_report", _report_parts_sql())
def _h04(spark, sf):
    r = H.model_report(T.scored(spark, sf), "pseudo")
    null = lambda t: F.lit(None).cast(t)
    return r["overall"].select(
        F.lit("overall").alias("part"), F.lit("all").alias("item"), null("long").alias("n"), null("double").alias("coverage_pct"), "accuracy"
    ).union(r["buckets"].select(F.lit("buckets"), "confidence_range", "n_predictions", "coverage_pct", "accuracy")).union(
        r["thresholds"].select(F.lit("thresholds"), F.format_string("%.2f", "threshold"), "n_acted", "coverage_pct", "accuracy_on_acted"))


# ---------------------------------------------------------------- I EDA
# every numeric column of the featured table with its index and snapshot columns
CORR_COLS = ("open", "high", "low", "close", "volume", *O.INDICATOR_DOUBLES, "MA_crossover", *O.CANDLE_INTS,
             "forward_close", "forward_return", "label", "vix", "nifty", "pe_ratio", "eps", "market_cap", "debt_to_equity",
             "current_ratio")


def _r_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return (f"covar_samp({a}, {b}) / NULLIF(stddev_samp({a}) FILTER (WHERE {both}) * "
            f"stddev_samp({b}) FILTER (WHERE {both}), 0)")


def _corr_sql() -> str:
    cells = ", ".join(f"{{'c': '{c}', 'k': {i}, 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(CORR_COLS))
    return (W(*CTX, f"cells AS (SELECT ticker, bar_date, unnest([{cells}], recursive := true) FROM ctx)",
              "pr AS (SELECT x.c AS a, y.c AS b, x.k AS i, y.k AS j, x.v AS u, y.v AS w FROM cells x JOIN cells y "
              "ON x.ticker = y.ticker AND x.bar_date = y.bar_date AND x.k < y.k)")
            + f"SELECT a, b, {O.rnd(_r_sql('u', 'w'))} AS r FROM pr GROUP BY a, b")


@register("i01_correlation_matrix", _corr_sql())
def _i01(spark, sf):
    return I.correlation_long(_ctx(spark, sf), list(CORR_COLS))


def _label_corr_sql() -> str:
    cols = [c for c in CORR_COLS if c != "label"]
    items = ", ".join(f"{{'feature': '{c}', 'r': {_r_sql(c, 'label')}}}" for c in cols)
    return (W(*CTX) + f"SELECT feature, {O.rnd('r')} AS r FROM (SELECT unnest([{items}], recursive := true) FROM ctx) "
            "ORDER BY abs(r) DESC NULLS LAST, feature")


@register("i02_label_correlations", _label_corr_sql())
def _i02(spark, sf):
    return I.label_correlations(_ctx(spark, sf), cols=[c for c in CORR_COLS if c != "label"])


_ZONE_SQL = ("CASE WHEN RSI_14 > -1 AND RSI_14 <= 30 THEN 'Oversold' WHEN RSI_14 > 30 AND RSI_14 <= 70 THEN 'Neutral' "
             "WHEN RSI_14 > 70 AND RSI_14 <= 101 THEN 'Overbought' END")


@register("i03_rsi_zone", W(*FEAT) + f"SELECT ticker, bar_date, {_ZONE_SQL} AS RSI_zone FROM featured")
def _i03(spark, sf):
    return _featured(spark, sf).select("ticker", "bar_date", I.rsi_zone().alias("RSI_zone"))


@register("i04_pe_terciles", W(*CTX, "rk AS (SELECT ticker, bar_date, pe_ratio, row_number() OVER (ORDER BY pe_ratio, ticker, bar_date) AS rnk, "
                              "count(*) OVER () AS n FROM ctx WHERE pe_ratio IS NOT NULL)") +
          "SELECT ticker, bar_date, CASE WHEN rnk = 1 OR 3 * (rnk - 1) < n - 1 THEN 'Value' WHEN 3 * (rnk - 1) < 2 * (n - 1) "
          "THEN 'Growth' ELSE 'Overvalued' END AS PE_zone FROM rk "
          "UNION ALL SELECT ticker, bar_date, NULL FROM ctx WHERE pe_ratio IS NULL")
def _i04(spark, sf):
    return I.pe_terciles(_ctx(spark, sf).select("ticker", "bar_date", "pe_ratio")).select("ticker", "bar_date", "PE_zone")


@register("i05_zone_counts", W(*FEAT) + f"SELECT RSI_zone, count(*) AS n FROM (SELECT {_ZONE_SQL} AS RSI_zone FROM featured) "
          "WHERE RSI_zone IS NOT NULL GROUP BY 1")
def _i05(spark, sf):
    z = _featured(spark, sf).select(I.rsi_zone().alias("RSI_zone")).filter(F.col("RSI_zone").isNotNull())
    return I.value_counts(z, "RSI_zone")


def _hist_sql(col: str, bins: int, by: str | None) -> str:
    keys = f"{by}, " if by else ""
    return (W(*FEAT, f"rg AS (SELECT min({col}) AS lo, max({col}) AS hi FROM featured)",
              f"hb AS (SELECT {keys}least(CASE WHEN hi - lo = 0 THEN 0 ELSE CAST(floor(({col} - lo) * ({float(bins)} / (hi - lo))) AS BIGINT) END, "
              f"{bins - 1}) AS bin, lo, hi FROM featured, rg WHERE {col} IS NOT NULL)")
            + f"SELECT {keys}CAST(bin AS INTEGER) AS bin, {O.rnd(f'any_value(lo) + bin * ((any_value(hi) - any_value(lo)) / {bins})')} AS lo, "
            f"{O.rnd(f'any_value(lo) + (bin + 1) * ((any_value(hi) - any_value(lo)) / {bins})')} AS hi, count(*) AS n "
            f"FROM hb GROUP BY {keys}bin")


@register("i06_return_histogram", _hist_sql("daily_return", 50, "ticker"))
def _i06(spark, sf):
    return I.histogram(_featured(spark, sf), "daily_return", 50, by="ticker")


@register("i07_rsi_histogram", _hist_sql("RSI_14", 40, None))
def _i07(spark, sf):
    return I.histogram(_featured(spark, sf), "RSI_14", 40)


@register("i08_box_stats", W(*FEAT, "q AS (SELECT label, quantile_cont(MACD_hist, 0.25) AS q1, quantile_cont(MACD_hist, 0.5) AS med, "
                             "quantile_cont(MACD_hist, 0.75) AS q3 FROM featured GROUP BY label)") +
          "SELECT f.label, " + O.rnd("q.q1") + " AS q1, " + O.rnd("q.med") + " AS median, " + O.rnd("q.q3") + " AS q3, "
          + O.rnd("min(CASE WHEN MACD_hist >= q1 - 1.5 * (q3 - q1) AND MACD_hist <= q3 + 1.5 * (q3 - q1) THEN MACD_hist END)") + " AS whisker_low, "
          + O.rnd("max(CASE WHEN MACD_hist >= q1 - 1.5 * (q3 - q1) AND MACD_hist <= q3 + 1.5 * (q3 - q1) THEN MACD_hist END)") + " AS whisker_high, "
          "count(*) FILTER (WHERE NOT (MACD_hist >= q1 - 1.5 * (q3 - q1) AND MACD_hist <= q3 + 1.5 * (q3 - q1))) AS n_outliers, count(*) AS n "
          "FROM featured f JOIN q ON f.label = q.label WHERE MACD_hist IS NOT NULL GROUP BY f.label, q.q1, q.med, q.q3")
def _i08(spark, sf):
    return I.box_stats(_featured(spark, sf))


@register("i09_scatter_points", W(*CTX) + "SELECT ticker, bar_date, " + O.r6("pe_ratio", "daily_return") +
          ", label FROM ctx WHERE pe_ratio IS NOT NULL AND daily_return IS NOT NULL")
def _i09(spark, sf):
    return I.scatter_points(_ctx(spark, sf))


def _sell_rate_sql() -> str:
    e = "quantile_cont(vix, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])"
    case = "CASE " + " ".join(
        f"WHEN vix {'>=' if i == 0 else '>'} e[{i + 1}] AND vix <= e[{i + 2}] THEN {i}" for i in range(5)) + " END"
    return (W(*CTX, f"ed AS (SELECT {e} AS e FROM ctx)", f"bd AS (SELECT {case} AS bin, e, label FROM ctx, ed)")
            + "SELECT bin, " + O.rnd("any_value(e[bin + 1])") + " AS lo, " + O.rnd("any_value(e[bin + 2])") + " AS hi, "
            "count(*) AS n, " + O.rnd("avg(CAST(label = 0 AS DOUBLE))") + " AS sell_rate FROM bd WHERE bin IS NOT NULL GROUP BY bin")


@register("i10_sell_rate_by_vix_quintile", _sell_rate_sql())
def _i10(spark, sf):
    return I.sell_rate_by_quantile(_ctx(spark, sf)).withColumn("bin", F.col("bin").cast("int"))


# ---------------------------------------------------------------- L projection
_GROWTH_CTES = (O.BARS,
                "rt AS (SELECT ticker, bar_date, close, close / NULLIF(lag(close) OVER (PARTITION BY ticker ORDER BY bar_date), 0) - 1 AS ret "
                "FROM bars WHERE close IS NOT NULL)",
                "gs AS (SELECT ticker, count(*) AS n, arg_min(close, bar_date) AS first_close, arg_max(close, bar_date) AS last_close, "
                "min(bar_date) AS d0, max(bar_date) AS last_date, stddev_samp(ret) AS sd, "
                "date_diff('day', min(bar_date), max(bar_date)) / 365.25 AS yrs FROM rt GROUP BY ticker)",
                "g AS (SELECT ticker, last_date, last_close, pow(last_close / first_close, 1 / yrs) - 1 AS cagr, sd * sqrt(252.0) AS annual_vol, "
                "round(yrs, 1) AS history_years FROM gs WHERE n >= 60 AND yrs > 0 AND first_close > 0)")


@register("l01_growth_stats", W(*_GROWTH_CTES) + "SELECT ticker, last_date, " +
          O.r6("last_close", "cagr", "annual_vol", "history_years") + " FROM g")
def _l01(spark, sf):
    return growth_stats(T.bars(spark, sf))


@register("l05_project_price", W(*_GROWTH_CTES) +
          "SELECT ticker, CAST(t AS INTEGER) AS t, make_date(CAST(year(last_date) + t AS BIGINT), 12, 31) AS future_date, "
          + O.rnd("last_close * pow(1 + cagr, t)") + " AS base, "
          + O.rnd("last_close * pow(1 + cagr + annual_vol, t)") + " AS optimistic, "
          + O.rnd("last_close * pow(1 + greatest(cagr - annual_vol, -0.95), t)") + " AS pessimistic "
          "FROM g, range(1, 6) r(t)")
def _l05(spark, sf):
    return project_price(T.bars(spark, sf))


# ---------------------------------------------------------------- M lookups
TICKER = "Brand#1"
_BAR_COLS = ("open", "high", "low", "close", "volume")


@register("m01_tickers", W(O.BARS) + "SELECT DISTINCT ticker FROM bars")
def _m01(spark, sf):
    return M.tickers(T.bars(spark, sf))


@register("m01_ticker_count", W(O.BARS) + "SELECT count(DISTINCT ticker) AS count FROM bars")
def _m01c(spark, sf):
    return M.ticker_count(T.bars(spark, sf))


@register("m02_price_lookup", W(O.BARS) + "SELECT ticker, bar_date, " + O.r6(*_BAR_COLS) +
          f" FROM bars WHERE ticker = '{TICKER}' AND bar_date >= DATE '1995-01-01' AND bar_date <= DATE '1996-12-31' "
          "ORDER BY bar_date DESC LIMIT 100")
def _m02(spark, sf):
    return M.price_lookup(T.bars(spark, sf), TICKER, "1995-01-01", "1996-12-31", 100)


@register("m03_fundamentals_lookup", W(O.QUARTERLY_RAW, O.STATEMENTS, O.FUND, O.SNAPSHOT) +
          "SELECT ticker, " + O.r6(*FU.SNAPSHOT_COLS) + f" FROM snapshot WHERE ticker = '{TICKER}'")
def _m03(spark, sf):
    return M.fundamentals_lookup(FU.fundamentals_snapshot(T.fundamentals(spark, sf), T.statements(spark, sf)), TICKER)


@register("m04_feature_lookup", W(*FEAT) + "SELECT ticker, bar_date, " + O.r6("close", "RSI_14", "MACD_hist") +
          f", label FROM featured WHERE ticker = '{TICKER}' ORDER BY bar_date DESC LIMIT 50")
def _m04(spark, sf):
    return M.feature_lookup(_featured(spark, sf, TICKER), TICKER, 50).select("ticker", "bar_date", "close", "RSI_14", "MACD_hist", "label")


@register("m05_row_counts", W(O.BARS, O.QUARTERLY_RAW, O.HIST, O.FUND) +
          "SELECT 'raw_prices' AS \"table\", count(*) AS rows, CAST(NULL AS VARCHAR) AS error FROM bars "
          "UNION ALL SELECT 'raw_fundamentals', count(*), NULL FROM fund "
          "UNION ALL SELECT 'raw_quarterly_fundamentals', count(*), NULL FROM hist")
def _m05(spark, sf):
    return M.row_counts(spark, {"raw_prices": lambda: T.bars(spark, sf),
                                "raw_fundamentals": lambda: T.fundamentals(spark, sf),
                                "raw_quarterly_fundamentals": lambda: quarterly_history(T.quarterly_raw(spark, sf))})


@register("m06_last_n_history", W(*FEAT) + "SELECT * FROM (SELECT ticker, bar_date, " + O.r6("close", "MA21") +
          f" FROM featured WHERE ticker = '{TICKER}' ORDER BY bar_date DESC LIMIT 30) ORDER BY bar_date")
def _m06(spark, sf):
    return M.last_n_history(_featured(spark, sf, TICKER), TICKER, 30).select("ticker", "bar_date", "close", "MA21")


@register("m07_latest_price", W(O.BARS) + "SELECT bar_date, " + O.r6("close", "volume") +
          f" FROM bars WHERE ticker = '{TICKER}' ORDER BY bar_date DESC LIMIT 1")
def _m07(spark, sf):
    return M.latest_price(T.bars(spark, sf), TICKER)


@register("m08_ticker_sample", W(O.BARS) +
          "SELECT (SELECT count(DISTINCT ticker) FROM bars) AS ticker_count, "
          "(SELECT string_agg(ticker, ',' ORDER BY ticker) FROM (SELECT DISTINCT ticker FROM bars ORDER BY ticker LIMIT 5)) AS sample")
def _m08(spark, sf):
    return M.ticker_sample(T.bars(spark, sf)).withColumn("sample", F.array_join("sample", ","))


# ---------------------------------------------------------------- N run log
@register("n02_recent_runs", W(O.RUNS) + "SELECT CASE WHEN run_id % 3 = 0 THEN left(CAST(run_id AS VARCHAR), 8) ELSE run_name END AS run_name, "
          "run_id, CASE WHEN accuracy IS NULL THEN 'FAILED' ELSE 'FINISHED' END AS status, start_time, " + O.r6("accuracy") +
          " FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 20")
def _n02(spark, sf):
    r = T.runs(spark, sf).withColumn("run_name", F.when(F.col("run_id") % 3 != 0, F.col("run_name")))
    r = r.withColumn("status", F.when(F.col("accuracy").isNull(), "FAILED").otherwise("FINISHED"))
    return N.recent_runs(r, 20, metrics=("accuracy",))


_RUN_ID = 42


@register("n03_run_detail", W(O.RUNS) +
          "SELECT run_id, run_name, start_time, " + O.rnd("accuracy") + " AS accuracy, "
          "'k=' || CAST(json_extract(props, '$.k') AS VARCHAR) AS tags "
          f"FROM runs WHERE run_id = {_RUN_ID}")
def _n03(spark, sf):
    r = T.runs(spark, sf).withColumn(
        "tags", F.create_map(F.lit("mlflow.runName"), F.col("run_name"),
                             F.lit("k"), F.get_json_object("props", "$.k")))
    d = N.run_detail(r.withColumn("params", F.create_map()).withColumn("metrics", F.create_map(F.lit("accuracy"), F.col("accuracy"))),
                     _RUN_ID)
    flat = F.array_join(F.transform(F.array_sort(F.map_entries("tags")), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return d.select("run_id", "run_name", "start_time", F.col("metrics")["accuracy"].alias("accuracy"), flat.alias("tags"))


@register("n04_latest_run_per_name", W(O.RUNS) + "SELECT run_name, run_id, start_time, " + O.rnd("accuracy") +
          " AS accuracy, model_name FROM runs QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) = 1")
def _n04(spark, sf):
    return N.latest_per_name(T.runs(spark, sf).drop("props"))


@register("n05_metrics_long", W(O.RUNS) + "SELECT run_name, 'accuracy' AS metric, " + O.rnd("accuracy") +
          " AS value FROM runs QUALIFY row_number() OVER (PARTITION BY run_name ORDER BY start_time DESC, run_id DESC) = 1")
def _n05(spark, sf):
    return N.metrics_long(N.latest_per_name(T.runs(spark, sf).drop("props")), metrics=("accuracy",))


@register("n06_model_versions", W(O.RUNS) +
          "SELECT model_name, CAST(row_number() OVER (PARTITION BY model_name ORDER BY start_time, run_id) AS INTEGER) AS version, "
          "run_id, start_time AS created FROM runs WHERE model_name IS NOT NULL")
def _n06(spark, sf):
    return N.model_versions(T.runs(spark, sf))


@register("n06_latest_versions", W(O.RUNS) +
          "SELECT model_name, CAST(count(*) AS INTEGER) AS latest_version, arg_max(run_id, (start_time, run_id)) AS run_id "
          "FROM runs WHERE model_name IS NOT NULL GROUP BY model_name")
def _n06b(spark, sf):
    return N.latest_versions(T.runs(spark, sf))


@register("n07_newest_run_id", W(O.RUNS) + "SELECT arg_max(run_id, (start_time, run_id)) AS latest_run_id FROM runs")
def _n07(spark, sf):
    return N.newest_run_id(T.runs(spark, sf))


# ---------------------------------------------------------------- D / F rows not covered above
from barlab.operators.ewm import ewm_column  # noqa: E402
from barlab.operators.indicators import WARMUP_COLS, compute_features  # noqa: E402
from barlab.operators.labels import fold_summary, split_summary, time_ordered_split, walk_forward_folds  # noqa: E402
from barlab.operators.scan import prefix_sum  # noqa: E402


@register("d06_ewm_span10", W(O.BARS) + "SELECT ticker, bar_date, " + O.rnd(
    "list_reduce(list(close) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), "
    "lambda acc, v: acc * (1 - (2.0 / 11)) + v * (2.0 / 11))") + " AS ewm FROM bars")
def _d06(spark, sf):
    return ewm_column(T.bars(spark, sf).select("ticker", "bar_date", "close"), "close", "ewm", span=10).drop("close")


def _extra_query(name, sql_cols, spark_cols):
    def fn(spark, sf):
        f = compute_features(T.bars(spark, sf), extra=tuple(spark_cols))
        return f.select("ticker", "bar_date", *[F.col(s).alias(o) for s, o in zip(spark_cols, sql_cols)])
    sel = ", ".join(f"{O.rnd(c)} AS {o}" for c, o in zip(sql_cols, sql_cols))
    register(name, W(*FEAT) + f"SELECT ticker, bar_date, {sel} FROM feat")(fn)


_extra_query("d16_true_range", ["tr"], ["_tr"])
_extra_query("d18_directional_movement", ["pdm", "mdm"], ["_pdm", "_mdm"])
_extra_query("d19_directional_index", ["pdi", "mdi"], ["_pdi", "_mdi"])
_extra_query("d20_dx", ["DX"], ["DX"])


@register("d22_obv_level", W(*FEAT) + "SELECT ticker, bar_date, " + O.rnd(
    "sum(dir * volume) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)")
          + " AS OBV FROM feat")
def _d22(spark, sf):
    f = compute_features(T.bars(spark, sf), extra=("_dir",)).select(
        "ticker", "bar_date", (F.col("_dir") * F.col("volume")).alias("_dv"))
    return prefix_sum(f, "ticker", "bar_date", "_dv", "OBV", block_rows=64).drop("_dv")


@register("d28_warmup_drop", W(*FEAT) + "SELECT ticker, bar_date FROM labelled WHERE " +
          " OR ".join(f"{c} IS NULL" for c in WARMUP_COLS))
def _d28(spark, sf):
    lab = compute_features(T.bars(spark, sf), labels=FIXTURE_LABELS)
    cond = None
    for c in WARMUP_COLS:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return lab.filter(cond).select("ticker", "bar_date")


@register("f01_forward_return", W(*FEAT) + "SELECT ticker, bar_date, " + O.r6("forward_close", "forward_return") + " FROM feat")
def _f01(spark, sf):
    return compute_features(T.bars(spark, sf), labels=FIXTURE_LABELS, drop_unlabelled=False).select(
        "ticker", "bar_date", "forward_close", "forward_return")


@register("f02_label", W(*FEAT) + "SELECT ticker, bar_date, label FROM feat")
def _f02(spark, sf):
    return compute_features(T.bars(spark, sf), labels=FIXTURE_LABELS, drop_unlabelled=False).select(
        "ticker", "bar_date", "label")


_CUT = ("cut AS (SELECT bar_date AS cutoff FROM featured ORDER BY bar_date "
        "LIMIT 1 OFFSET (SELECT CAST(floor(count(*) * CAST(0.7 AS DOUBLE)) AS BIGINT) FROM featured))")


@register("f06_time_split", W(*FEAT, _CUT) +
          "SELECT any_value(cutoff) AS cutoff, count(*) FILTER (WHERE bar_date < cutoff) AS train_rows, "
          "count(*) FILTER (WHERE bar_date >= cutoff) AS test_rows FROM featured, cut")
def _f06(spark, sf):
    return split_summary(_featured(spark, sf), 0.70)


_FOLDS = (
    "tr AS (SELECT f.* FROM featured f, cut WHERE f.bar_date < cut.cutoff)",
    "dc AS (SELECT bar_date, CAST(sum(count(*)) OVER (ORDER BY bar_date) - count(*) AS BIGINT) AS before, "
    "CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM tr GROUP BY bar_date)",
    "rp AS (SELECT tr.ticker, tr.bar_date, dc.before, dc.total, "
    "dc.before + row_number() OVER (PARTITION BY tr.bar_date ORDER BY tr.ticker) - 1 AS pos FROM tr JOIN dc ON tr.bar_date = dc.bar_date)",
    "fz AS (SELECT *, floor(total / 6) AS size, total - 5 * floor(total / 6) AS fs FROM rp)",
    "fd AS (SELECT *, CASE WHEN before >= fs THEN least(floor((before - fs) / size), 4) END AS fold FROM fz)",
)


@register("f07_walk_forward_folds", W(*FEAT, _CUT, *_FOLDS) +
          "SELECT CAST(fold AS INTEGER) AS fold, CAST(min(pos) AS BIGINT) AS train_rows, count(*) AS test_rows, "
          "min(bar_date) AS test_first_date, max(bar_date) AS test_last_date FROM fd WHERE fold IS NOT NULL GROUP BY fold")
def _f07(spark, sf):
    train, _ = time_ordered_split(_featured(spark, sf), 0.70)
    return fold_summary(walk_forward_folds(train, 5))


@register("f08_purged_split", W(*FEAT, _CUT) +
          "SELECT count(*) FILTER (WHERE bar_date < cutoff - INTERVAL 35 DAY) AS train_rows, "
          "count(*) FILTER (WHERE bar_date >= cutoff) AS test_rows FROM featured, cut")
def _f08(spark, sf):
    train, test = time_ordered_split(_featured(spark, sf), 0.70, purge_days=35)
    return train.agg(F.count(F.lit(1)).alias("train_rows")).crossJoin(test.agg(F.count(F.lit(1)).alias("test_rows")))


# ---------------------------------------------------------------- A9-A12, I11
import uuid  # noqa: E402

from barlab.session import ensure_checkpoint_dir  # noqa: E402
from barlab.sources import sinks as S  # noqa: E402
from barlab.sources.bars import BAR_SCHEMA  # noqa: E402

_BAR_SQL = W(O.BARS) + "SELECT ticker, bar_date, " + O.r6("open", "high", "low", "close", "volume") + " FROM bars"


@register("a09_csv_source", _BAR_SQL)
def _a09(spark, sf):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-csv-{uuid.uuid4().hex}/raw_prices"
    S.write_stage(T.bars(spark, sf).select(*BAR_SCHEMA.fieldNames()), path, fmt="csv")
    return S.read_stage_csv(spark, path)


@register("a10_stage_sink", _BAR_SQL)
def _a10(spark, sf):
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-parquet-{uuid.uuid4().hex}/raw_prices"
    S.write_stage(T.bars(spark, sf), path, partition_by=["ticker"])
    return spark.read.parquet(path).select("ticker", "bar_date", "open", "high", "low", "close", "volume")


@register("a11_replace_table", _BAR_SQL)
def _a11(spark, sf):
    """Replaced twice, the second time by all bars; a third write breaks on its way."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables-{uuid.uuid4().hex}"
    bars = T.bars(spark, sf)
    S.replace_table(bars.filter("volume > 1000"), root, "raw_prices")
    S.replace_table(bars, root, "raw_prices")
    try:
        S.replace_table(bars.withColumn("close", F.raise_error(F.lit("broken")).cast("double")), root, "raw_prices")
    except Exception as e:
        if "broken" not in str(e):
            raise
    return S.read_replaced(spark, root, "raw_prices").select("ticker", "bar_date", "open", "high", "low", "close", "volume")


@register("a12_relational_source", W(O.BARS) + "SELECT DISTINCT ticker FROM bars")
def _a12(spark, sf):
    return S.sql_source(spark, "SELECT DISTINCT ticker FROM raw_prices ORDER BY ticker", {"raw_prices": T.bars(spark, sf)})


@register("i11_run_eda", None)
def _i11(spark, sf):
    from barlab.plans.pipeline import run_eda
    tables = run_eda(_ctx(spark, sf), list(CORR_COLS))
    rows = [(name, df.count()) for name, df in tables.items()]
    return spark.createDataFrame(rows, "table string, rows long")


# ---------------------------------------------------------------- rows with their own entry
from barlab.operators import clean as CL  # noqa: E402
from barlab.operators.indicators import candle_geometry, pct_change, rolling_stats  # noqa: E402


@register("d26_rolling_stats", W(O.BARS) + "SELECT ticker, bar_date, " + ", ".join(
    f"{O.rnd(O._full(agg, 'close', 10))} AS close_{nm}10" for agg, nm in
    (("avg", "mean"), ("stddev_samp", "std"), ("min", "min"), ("max", "max"), ("sum", "sum"))) + " FROM bars")
def _d26(spark, sf):
    return rolling_stats(T.bars(spark, sf).select("ticker", "bar_date", "close"), "close", 10).drop("close")


@register("d27_pct_change", W(O.BARS) + "SELECT ticker, bar_date, " +
          O.rnd("close / NULLIF(lag(close, 3) OVER (PARTITION BY ticker ORDER BY bar_date), 0) - 1") + " AS close_pct3 FROM bars")
def _d27(spark, sf):
    return pct_change(T.bars(spark, sf).select("ticker", "bar_date", "close"), "close", 3).drop("close")


@register("e00_candle_geometry", W(*FEAT) + "SELECT ticker, bar_date, " + ", ".join(
    f"{O.rnd(a)} AS {b}" for a, b in (("body", "body"), ("rng", "range"), ("upper_sh", "upper"), ("lower_sh", "lower"),
                                      ("trend", "trend"))) + " FROM feat")
def _e00(spark, sf):
    return candle_geometry(T.bars(spark, sf)).select("ticker", "bar_date", "body", "range", "upper", "lower", "trend")


@register("c07_all_ticker_history", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, count(*) AS quarters, "
          "min(quarter_end) AS first_quarter, max(quarter_end) AS last_quarter FROM hist GROUP BY ticker")
def _c07(spark, sf):
    h = quarterly_history(T.quarterly_raw(spark, sf))
    return h.groupBy("ticker").agg(F.count(F.lit(1)).alias("quarters"), F.min("quarter_end").alias("first_quarter"),
                                   F.max("quarter_end").alias("last_quarter"))


def _params_sql() -> str:
    parts = []
    for c in CL.PRICE_COLS:
        parts.append(f"SELECT '{c}' AS column, 'minmax' AS kind, {O.rnd(f'min({c})')} AS a, "
                     + O.rnd(f"CASE WHEN max({c}) - min({c}) = 0 THEN 1.0 ELSE max({c}) - min({c}) END") + " AS b FROM imputed")
    for c in CL.RATIO_COLS:
        x = f"coalesce(CAST({c} AS DOUBLE), 0)"
        parts.append(f"SELECT '{c}' AS column, 'standard' AS kind, {O.rnd(f'avg({x})')} AS a, "
                     + O.rnd(f"CASE WHEN stddev_pop({x}) = 0 THEN 1.0 ELSE stddev_pop({x}) END") + " AS b FROM imputed")
    from barlab.plans.registry_more import _IMPUTED_CTES
    return W(*_IMPUTED_CTES) + " UNION ALL ".join(parts)


@register("b13_scaler_persist_load", _params_sql())
def _b13(spark, sf):
    from barlab.plans.registry_more import _merged
    imp = CL.impute(_merged(spark, sf), list(O.MERGED_NUMERIC))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scalers-{uuid.uuid4().hex}"
    CL.save_scaler(CL.minmax_fit(imp).unionByName(CL.standard_fit(imp)), path)
    return CL.load_scaler(spark, path)


@register("l02_annual_volatility", W(*_GROWTH_CTES)
          + "SELECT ticker, " + O.rnd("annual_vol") + " AS annual_vol FROM g")
def _l02(spark, sf):
    return growth_stats(T.bars(spark, sf)).select("ticker", "annual_vol")


@register("l03_projection_paths", W(*_GROWTH_CTES) + "SELECT ticker, CAST(t AS INTEGER) AS t, "
          + O.rnd("last_close * pow(1 + cagr, t)") + " AS base, "
          + O.rnd("last_close * pow(1 + cagr + annual_vol, t)") + " AS optimistic, "
          + O.rnd("last_close * pow(1 + greatest(cagr - annual_vol, -0.95), t)") + " AS pessimistic FROM g, range(1, 6) r(t)")
def _l03(spark, sf):
    return project_price(T.bars(spark, sf)).select("ticker", "t", "base", "optimistic", "pessimistic")


@register("l04_future_dates", W(*_GROWTH_CTES) + "SELECT ticker, CAST(t AS INTEGER) AS t, "
          "make_date(CAST(year(last_date) + t AS BIGINT), 12, 31) AS future_date FROM g, range(1, 6) r(t)")
def _l04(spark, sf):
    return project_price(T.bars(spark, sf)).select("ticker", "t", "future_date")


@register("n01_append_run", None)
def _n01(spark, sf):
    import uuid
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/runlog-{uuid.uuid4().hex}"
    first = T.runs(spark, sf).agg(F.max("accuracy").alias("acc")).first()["acc"]
    N.append_run(spark, path, "r1", "random_forest", {"n_estimators": 100}, {"accuracy": first}, "stock_rf_classifier")
    N.append_run(spark, path, "r2", "xgboost", {"n_estimators": 200}, {"accuracy": first / 2}, "stock_xgb_classifier")
    return N.recent_runs(spark.read.parquet(path), 20)


# ---------------------------------------------------------------- series with missing closes and volumes
_GAPPY = ("gappy AS (SELECT * REPLACE (CASE WHEN CAST(volume AS BIGINT) % 9 IN (0, 4) THEN NULL ELSE close END AS close, "
          "CASE WHEN CAST(volume AS BIGINT) % 11 = 0 THEN NULL ELSE volume END AS volume) FROM bars)")


def _gappy(spark, sf):
    v = F.col("volume").cast("long")
    return T.bars(spark, sf).withColumns({"close": F.when(~(v % 9).isin(0, 4), F.col("close")), "volume": F.when(v % 11 != 0, F.col("volume"))})


def _ewm_ctes(name: str, src: str, x: str, alpha: str) -> tuple:
    """Row-by-row recursion: y, and the rows since the last observation."""
    q = f"(1 - {alpha})"
    return (f"{name}_n AS (SELECT ticker, bar_date, {x} AS x, row_number() OVER (PARTITION BY ticker ORDER BY bar_date) AS rn FROM {src})",
            f"{name} AS (SELECT ticker, bar_date, rn, x AS y, 1 AS g FROM {name}_n WHERE rn = 1 UNION ALL "
            f"SELECT n.ticker, n.bar_date, n.rn, CASE WHEN n.x IS NULL THEN e.y WHEN e.y IS NULL THEN n.x "
            f"ELSE (pow({q}, e.g) * e.y + {alpha} * n.x) / (pow({q}, e.g) + {alpha}) END, CASE WHEN n.x IS NULL THEN e.g + 1 ELSE 1 END "
            f"FROM {name} e JOIN {name}_n n ON n.ticker = e.ticker AND n.rn = e.rn + 1)")


def WR(*ctes: str) -> str:
    return W(*ctes).replace("WITH ", "WITH RECURSIVE ", 1)


@register("d06_ewm_with_gaps", WR(O.BARS, _GAPPY, *_ewm_ctes("e", "gappy", "close", "(2.0 / 11)")) +
          "SELECT ticker, bar_date, " + O.rnd("y") + " AS ewm FROM e")
def _d06g(spark, sf):
    return ewm_column(_gappy(spark, sf).select("ticker", "bar_date", "close"), "close", "ewm", span=10).drop("close")


@register("d09_macd_with_gaps", WR(
    O.BARS, _GAPPY, *_ewm_ctes("fast", "gappy", "close", "(2.0 / 13)"), *_ewm_ctes("slow", "gappy", "close", "(2.0 / 27)"),
    "macd AS (SELECT f.ticker, f.bar_date, f.y - s.y AS m FROM fast f JOIN slow s ON f.ticker = s.ticker AND f.rn = s.rn)",
    *_ewm_ctes("sig", "macd", "m", "(2.0 / 10)"))
          + "SELECT m.ticker, m.bar_date, " + O.rnd("m.m") + " AS \"MACD\", " + O.rnd("s.y") + " AS \"MACD_signal\", "
          + O.rnd("m.m - s.y") + " AS \"MACD_hist\" FROM macd m JOIN sig s ON m.ticker = s.ticker AND m.bar_date = s.bar_date")
def _d09g(spark, sf):
    return compute_features(_gappy(spark, sf)).select("ticker", "bar_date", "MACD", "MACD_signal", "MACD_hist")


@register("d01_changes_with_gaps", W(O.BARS, _GAPPY, O.ffill_cte("pad", "gappy", ("close", "volume"))) + "SELECT ticker, bar_date, " + ", ".join(
    f"{O.rnd(f'{c} / NULLIF(lag({c}, {n}) OVER (PARTITION BY ticker ORDER BY bar_date), 0) - 1')} AS {o}"
    for c, n, o in (("close", 1, "daily_return"), ("volume", 1, "volume_change"))) + " FROM pad")
def _d01g(spark, sf):
    return compute_features(_gappy(spark, sf)).select("ticker", "bar_date", "daily_return", "volume_change")


@register("e00_trend_with_gaps", W(O.BARS, _GAPPY, O.ffill_cte("pad", "gappy", ("close",))) + "SELECT ticker, bar_date, "
          + O.rnd("close / NULLIF(lag(close, 5) OVER (PARTITION BY ticker ORDER BY bar_date), 0) - 1") + " AS trend FROM pad")
def _e00g(spark, sf):
    return candle_geometry(_gappy(spark, sf)).select("ticker", "bar_date", "trend")


@register("d29_rows_without_a_date", W(O.BARS) + "SELECT count(*) AS rows, count(*) FILTER (WHERE CAST(volume AS BIGINT) % 7 = 0) AS undated FROM bars")
def _d29n(spark, sf):
    b = T.bars(spark, sf)
    b = b.withColumn("bar_date", F.when(F.col("volume").cast("long") % 7 != 0, F.col("bar_date")))
    return compute_features(b).agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col("bar_date").isNull()).alias("undated"))
