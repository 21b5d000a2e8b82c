"""Registered queries for groups A (beyond bars), B and C."""

from __future__ import annotations

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from barlab import oracle as O
from barlab.operators import clean
from barlab.operators.asof import asof_backward, attach_quarterly, match_coverage
from barlab.operators.indicators import compute_features
from barlab.operators.models import FEATURE_COLS
from barlab.operators.quarterly import quarterly_history
from barlab.plans.pipeline import merge_inputs, run_preprocessing
from barlab.plans.registry import register
from barlab.session import cut_lineage, ensure_checkpoint_dir
from barlab.sources import bars as B
from barlab.sources import tables as T

W = O.with_
MERGED_CTES = (O.BARS, O.QUARTERLY_RAW, O.INDEX, O.FUND, O.HIST, O.MERGED)


def _history(spark, sf):
    return quarterly_history(T.quarterly_raw(spark, sf))


def _with_index(spark, sf):
    return B.join_index(T.bars(spark, sf), T.index_levels(spark, sf))


def _merged(spark, sf, strategy="auto"):
    return merge_inputs(_with_index(spark, sf), T.fundamentals(spark, sf), _history(spark, sf), strategy)


# ---------------------------------------------------------------- A
@register("a04_index_series", W(O.INDEX) + "SELECT bar_date, " + O.r6("vix", "nifty") + " FROM idx")
def _a04(spark, sf):
    idx = T.index_levels(spark, sf)
    return B.index_series(idx, "vix", value_col="vix").join(B.index_series(idx, "nifty", value_col="nifty"), "bar_date")


@register("a05_join_index", W(O.BARS, O.INDEX) +
          "SELECT b.ticker, b.bar_date, " + O.r6("close") + ", " + O.rnd("i.vix") + " AS vix, " + O.rnd("i.nifty") +
          " AS nifty FROM bars b LEFT JOIN idx i ON b.bar_date = i.bar_date")
def _a05(spark, sf):
    return _with_index(spark, sf).select("ticker", "bar_date", "close", "vix", "nifty")


@register("a03_union_series", W(O.BARS) +
          "SELECT ticker, bar_date, " + O.r6("close") + " FROM bars WHERE ticker < 'Brand#3' "
          "UNION ALL SELECT ticker, bar_date, " + O.r6("close") + " FROM bars WHERE ticker >= 'Brand#3'")
def _a03(spark, sf):
    b = T.bars(spark, sf).select("ticker", "bar_date", "close")
    return B.union_series([b.filter(F.col("ticker") < "Brand#3"), None, b.filter(F.col("ticker") >= "Brand#3")])


@register("a01_read_bars", W(O.BARS) + "SELECT ticker, bar_date, " + O.r6("open", "high", "low", "close", "volume") + " FROM bars")
def _a01(spark, sf):
    # a file with download-style column names in, typed bars out
    raw = T.bars(spark, sf).select(F.col("bar_date").cast("timestamp").alias("Date"), F.col("open").alias("Open"),
                                   F.col("high").alias("High"), F.col("low").alias("Low"),
                                   F.col("close").alias("Close"), F.col("volume").alias("Volume"), "ticker")
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/download-{uuid.uuid4().hex}"
    raw.write.option("header", True).csv(path)
    return B.read_bars(spark, path, "csv")


# ---------------------------------------------------------------- C
_HIST_SQL = W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end, available_date, " + O.r6(*O.HIST_COLS) + \
    ", earnings_growth_streak FROM hist"


@register("c06_quarterly_history", _HIST_SQL)
def _c06(spark, sf):
    return _history(spark, sf)


@register("c01_last_n_quarters", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end FROM hist0")
def _c01(spark, sf):
    from barlab.operators.quarterly import last_n_quarters
    return last_n_quarters(T.quarterly_raw(spark, sf), 8).select("ticker", "quarter_end")


@register("c02_available_date", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end, available_date FROM hist")
def _c02(spark, sf):
    return _history(spark, sf).select("ticker", "quarter_end", "available_date")


@register("c03_qoq_growth", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end, " +
          O.r6("revenue_qoq_growth", "net_income_qoq_growth") + " FROM hist")
def _c03(spark, sf):
    return _history(spark, sf).select("ticker", "quarter_end", "revenue_qoq_growth", "net_income_qoq_growth")


@register("c04_yoy_growth", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end, " +
          O.r6("revenue_yoy_growth", "net_income_yoy_growth") + " FROM hist")
def _c04(spark, sf):
    return _history(spark, sf).select("ticker", "quarter_end", "revenue_yoy_growth", "net_income_yoy_growth")


@register("c05_growth_streak", W(O.QUARTERLY_RAW, O.HIST) + "SELECT ticker, quarter_end, earnings_growth_streak FROM hist")
def _c05(spark, sf):
    return _history(spark, sf).select("ticker", "quarter_end", "earnings_growth_streak")


# ---------------------------------------------------------------- B
_ASOF_RAW_SQL = W(O.BARS, O.QUARTERLY_RAW) + (
    "SELECT b.ticker, b.bar_date, " + O.rnd("q.revenue") + " AS revenue, " + O.rnd("q.net_income") + " AS net_income "
    "FROM bars b ASOF LEFT JOIN (SELECT *, CAST(quarter_end + INTERVAL 45 DAY AS DATE) AS available_date FROM quarterly_raw) q "
    "ON b.ticker = q.ticker AND b.bar_date >= q.available_date")


def _asof_raw(strategy):
    def fn(spark, sf):
        q = T.quarterly_raw(spark, sf).withColumn("available_date", F.date_add("quarter_end", 45))
        left = T.bars(spark, sf).select("ticker", "bar_date")
        return asof_backward(left, q, "ticker", "bar_date", "available_date", ["revenue", "net_income"],
                             right_tiebreak="quarter_end", strategy=strategy)
    return fn


register("b03_asof_backward_scan", _ASOF_RAW_SQL)(_asof_raw("scan"))
register("b03_asof_backward_range", _ASOF_RAW_SQL)(_asof_raw("range"))

_ATTACH_COLS = ["revenue", "net_income", "revenue_yoy_growth", "net_income_yoy_growth",
                "revenue_qoq_growth", "net_income_qoq_growth"]


@register("b04_attach_quarterly", W(*MERGED_CTES) + "SELECT ticker, bar_date, " + O.r6(*_ATTACH_COLS) +
          ", earnings_growth_streak FROM merged")
def _b04(spark, sf):
    left = T.bars(spark, sf).select("ticker", "bar_date")
    return attach_quarterly(left, _history(spark, sf)).select("ticker", "bar_date", *_ATTACH_COLS, "earnings_growth_streak")


@register("b05_match_coverage", W(*MERGED_CTES) + "SELECT count(revenue) AS matched_rows, count(*) AS rows FROM merged")
def _b05(spark, sf):
    left = T.bars(spark, sf).select("ticker", "bar_date")
    return match_coverage(attach_quarterly(left, _history(spark, sf)))


@register("b01_join_snapshot", W(O.BARS, O.FUND) + "SELECT b.ticker, b.bar_date, " +
          ", ".join(f"{O.rnd('f.' + c)} AS {c}" for c in ("pe_ratio", "eps", "market_cap", "debt_to_equity", "current_ratio")) +
          " FROM bars b LEFT JOIN fund f ON b.ticker = f.ticker")
def _b01(spark, sf):
    return clean.join_snapshot(T.bars(spark, sf).select("ticker", "bar_date"), T.fundamentals(spark, sf))


@register("b02_fix_dtypes", W(O.BARS) + "SELECT CAST(ticker AS VARCHAR) AS ticker, CAST(bar_date AS DATE) AS bar_date FROM bars")
def _b02(spark, sf):
    raw = T.bars(spark, sf).select("ticker", F.col("bar_date").cast("timestamp").alias("bar_date"))
    return clean.fix_dtypes(raw)


_FFILL_SQL = W(*MERGED_CTES, O.ffill_cte("ff", "merged", O.MERGED_NUMERIC)) + "SELECT ticker, bar_date, " + O.r6(*O.MERGED_NUMERIC) + " FROM ff"


@register("b06_ffill", _FFILL_SQL)
def _b06(spark, sf):
    return clean.ffill(_merged(spark, sf), list(O.MERGED_NUMERIC)).select("ticker", "bar_date", *O.MERGED_NUMERIC)


@register("b06_ffill_blocked", _FFILL_SQL)
def _b06b(spark, sf):
    # tiny blocks: the fill must cross block boundaries through the carry table
    return clean.ffill(_merged(spark, sf), list(O.MERGED_NUMERIC), block_rows=16).select("ticker", "bar_date", *O.MERGED_NUMERIC)


@register("b07_fill_median", W(*MERGED_CTES, O.median_fill_cte("mf", "merged", O.MERGED_NUMERIC))
          + "SELECT ticker, bar_date, " + O.r6(*O.MERGED_NUMERIC) + " FROM mf")
def _b07(spark, sf):
    return clean.fill_median(_merged(spark, sf), list(O.MERGED_NUMERIC)).select("ticker", "bar_date", *O.MERGED_NUMERIC)


_IMPUTED_CTES = MERGED_CTES + (O.ffill_cte("ffm", "merged", O.MERGED_NUMERIC),
                               O.median_fill_cte("imputed", "ffm", O.MERGED_NUMERIC))


@register("b08_impute", W(*_IMPUTED_CTES) + "SELECT ticker, bar_date, " + O.r6(*O.MERGED_NUMERIC) + " FROM imputed")
def _b08(spark, sf):
    m = _merged(spark, sf)
    return clean.impute(m, list(O.MERGED_NUMERIC)).select("ticker", "bar_date", *O.MERGED_NUMERIC)


def _describe_sql() -> str:
    parts = []
    for c in O.MERGED_NUMERIC:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column, count({x}) AS count, {O.rnd(f'avg({x})')} AS mean, {O.rnd(f'stddev_samp({x})')} AS std, "
            f"{O.rnd(f'min({x})')} AS min, {O.rnd(f'quantile_cont({x}, 0.25)')} AS q25, {O.rnd(f'quantile_cont({x}, 0.5)')} AS q50, "
            f"{O.rnd(f'quantile_cont({x}, 0.75)')} AS q75, {O.rnd(f'max({x})')} AS max FROM merged")
    return W(*MERGED_CTES) + " UNION ALL ".join(parts)


@register("b09_describe", _describe_sql())
def _b09(spark, sf):
    return clean.describe(_merged(spark, sf), list(O.MERGED_NUMERIC))


_DATE_STATS = ("mean", "min", "q25", "q50", "q75", "max")


def _dates_sql() -> str:
    quartiles = ", ".join(f"{O.rnd(f'quantile_cont(d, CAST({p} AS DOUBLE))')} AS q{int(100 * p)}" for p in (0.25, 0.5, 0.75))
    parts = [f"SELECT '{c}' AS column, count(d) AS count, {O.rnd('avg(d)')} AS mean, CAST(min(d) AS DOUBLE) AS min, {quartiles}, CAST(max(d) AS DOUBLE) AS max "
             f"FROM (SELECT CAST(date_diff('day', DATE '1970-01-01', {c}) AS DOUBLE) AS d FROM {t})"
             for c, t in (("bar_date", "bars"), ("quarter_end", "quarterly_raw"))]
    return W(O.BARS, O.QUARTERLY_RAW) + " UNION ALL ".join(parts)


@register("b09_describe_dates", _dates_sql())
def _b09d(spark, sf):
    both = clean.describe_dates(T.bars(spark, sf)).union(clean.describe_dates(T.quarterly_raw(spark, sf), ["quarter_end"]))
    return both.select("column", "count", *[(F.unix_micros(c) / 86_400_000_000).alias(c) for c in _DATE_STATS])


def _missing_sql() -> str:
    cols = ["ticker", "bar_date", *O.MERGED_NUMERIC]
    parts = [f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM merged" for c in cols]
    return W(*MERGED_CTES) + "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing > 0"


@register("b10_missing_counts", _missing_sql())
def _b10(spark, sf):
    m = _merged(spark, sf)
    return clean.missing_counts(m.select("ticker", "bar_date", *O.MERGED_NUMERIC))


_NORM = [f"{c}_norm" for c in clean.PRICE_COLS]


def _minmax_sql() -> str:
    sel = ", ".join(
        O.rnd(f"({c} - min({c}) OVER ()) / CASE WHEN max({c}) OVER () - min({c}) OVER () = 0 THEN 1 "
              f"ELSE max({c}) OVER () - min({c}) OVER () END") + f" AS {c}_norm" for c in clean.PRICE_COLS)
    return W(*_IMPUTED_CTES) + f"SELECT ticker, bar_date, {sel} FROM imputed"


@register("b11_minmax_scale", _minmax_sql())
def _b11(spark, sf):
    imp = clean.impute(_merged(spark, sf), list(O.MERGED_NUMERIC))
    return clean.minmax_transform(imp, clean.minmax_fit(imp)).select("ticker", "bar_date", *_NORM)


def _standard_sql(src: str = "imputed") -> str:
    sel = ", ".join(
        O.rnd(f"(coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) / CASE WHEN stddev_pop(coalesce({c}, 0)) OVER () = 0 "
              f"THEN 1 ELSE stddev_pop(coalesce({c}, 0)) OVER () END") + f" AS {c}" for c in clean.RATIO_COLS)
    return f"SELECT ticker, bar_date, {sel} FROM {src}"


@register("b12_standard_scale", W(*_IMPUTED_CTES) + _standard_sql())
def _b12(spark, sf):
    imp = clean.impute(_merged(spark, sf), list(O.MERGED_NUMERIC))
    return clean.standard_transform(imp, clean.standard_fit(imp)).select("ticker", "bar_date", *clean.RATIO_COLS)


def _saved_sql() -> str:
    stats = ", ".join(f"avg(coalesce({c}, 0)) AS {c}_m, stddev_pop(coalesce({c}, 0)) AS {c}_s" for c in clean.RATIO_COLS)
    sel = ", ".join(O.rnd(f"(coalesce({c}, 0) - {c}_m) / CASE WHEN {c}_s = 0 THEN 1 ELSE {c}_s END") + f" AS {c}" for c in clean.RATIO_COLS)
    return f"SELECT ticker, bar_date, {sel} FROM imputed, (SELECT {stats} FROM imputed WHERE ticker < 'Brand#5')"


@register("b14_apply_saved_scaler", W(*_IMPUTED_CTES) + _saved_sql())
def _b14(spark, sf):
    imp = cut_lineage(clean.impute(_merged(spark, sf), list(O.MERGED_NUMERIC)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/scaler-{uuid.uuid4().hex}"
    # fitted without the last tickers, which are unseen when it is applied
    clean.save_scaler(clean.standard_fit(imp.filter(F.col("ticker") < "Brand#5")), path)
    return clean.apply_saved_scaler(imp, clean.load_scaler(spark, path)).select("ticker", "bar_date", *clean.RATIO_COLS)


@register("b15_one_hot", W(O.BARS, "ix AS (SELECT ticker, bar_date, CAST(dense_rank() OVER (ORDER BY ticker) - 1 AS INTEGER) AS ticker_index FROM bars)",
                          "nt AS (SELECT max(ticker_index) AS top FROM ix)") +
          "SELECT ticker, bar_date, ticker_index, array_to_string([CASE WHEN i = ticker_index THEN 1 ELSE 0 END FOR i IN range(0, top + 1)], '') "
          "AS ticker_onehot FROM ix, nt")
def _b15(spark, sf):
    hot = clean.one_hot(T.bars(spark, sf).select("ticker", "bar_date"))
    slots = F.transform(vector_to_array("ticker_onehot"), lambda x: x.cast("int").cast("string"))
    return hot.select("ticker", "bar_date", "ticker_index", F.array_join(slots, "").alias("ticker_onehot"))


_SANE_X = "CASE WHEN CAST(volume AS BIGINT) % 7 = 0 THEN {inf} WHEN CAST(volume AS BIGINT) % 11 = 0 THEN {nan} ELSE close END"


@register("b16_inf_to_null", W(O.BARS) + "SELECT ticker, bar_date, " +
          O.rnd("CASE WHEN isinf(x) OR isnan(x) THEN NULL ELSE x END") + " AS x FROM (SELECT ticker, bar_date, " +
          _SANE_X.format(inf="CAST('inf' AS DOUBLE)", nan="CAST('nan' AS DOUBLE)") + " AS x FROM bars)")
def _b16(spark, sf):
    b = T.bars(spark, sf)
    v = F.col("volume").cast("long")
    x = F.when(v % 7 == 0, F.lit(float("inf"))).when(v % 11 == 0, F.lit(float("nan"))).otherwise(F.col("close"))
    return clean.sanitise(b.select("ticker", "bar_date", x.alias("x")), ["x"])


@register("b17_fill_zero", W(*MERGED_CTES, O.features_ctes("merged")) + "SELECT ticker, bar_date, " +
          ", ".join(f"{O.rnd(f'coalesce(CAST({c} AS DOUBLE), 0)')} AS {c}" for c in FEATURE_COLS) + " FROM feat")
def _b17(spark, sf):
    f = compute_features(_merged(spark, sf))
    f = f.select("ticker", "bar_date", *[F.col(c).cast("double").alias(c) for c in FEATURE_COLS])
    return clean.fill_zero(f, list(FEATURE_COLS))


_PROCESSED_OUT = ["ticker", "bar_date", *O.MERGED_NUMERIC, *_NORM]


def _processed_sql() -> str:
    ratio = set(clean.RATIO_COLS)
    sel = []
    for c in O.MERGED_NUMERIC:
        if c in ratio:
            sel.append(O.rnd(f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END") + f" AS {c}")
        else:
            sel.append(f"{O.rnd(c)} AS {c}")
    for c in clean.PRICE_COLS:
        sel.append(O.rnd(f"({c} - min({c}) OVER ()) / CASE WHEN max({c}) OVER () - min({c}) OVER () = 0 THEN 1 "
                         f"ELSE max({c}) OVER () - min({c}) OVER () END") + f" AS {c}_norm")
    sel.append("CAST(dense_rank() OVER (ORDER BY ticker) - 1 AS INTEGER) AS ticker_index")
    return W(*_IMPUTED_CTES) + "SELECT ticker, bar_date, " + ", ".join(sel) + " FROM imputed"


@register("b18_run_preprocessing", _processed_sql())
def _b18(spark, sf):
    pre = run_preprocessing(_with_index(spark, sf), T.fundamentals(spark, sf), _history(spark, sf))
    return pre.table.select(*_PROCESSED_OUT, "ticker_index")


# ---------------------------------------------------------------- as-of join with missing keys and times, ties, and times of day
_ODD_LEFT = ("lf AS (SELECT CASE WHEN CAST(volume AS BIGINT) % 5 <> 0 THEN ticker END AS ticker, "
             "CASE WHEN CAST(volume AS BIGINT) % 7 <> 0 THEN bar_date END AS bar_date, close FROM bars)")
_ODD_RIGHT = ("rg AS (SELECT CASE WHEN extract(month FROM quarter_end) = 6 AND ticker = 'Brand#11' THEN NULL ELSE ticker END AS ticker, "
              "date_trunc('week', quarter_end) + INTERVAL 17 HOUR AS ts, revenue, n FROM quarterly_raw, (VALUES (9), (10)) v(n))")
_ODD_SQL = W(O.BARS, O.QUARTERLY_RAW, _ODD_LEFT, _ODD_RIGHT,
             "lr AS (SELECT row_number() OVER () AS r, * FROM lf)",
             "mt AS (SELECT r, arg_max(revenue, (ts, n)) AS revenue, arg_max(n, (ts, n)) AS n FROM lr JOIN rg ON lr.ticker = rg.ticker "
             "AND rg.ts <= CAST(lr.bar_date AS TIMESTAMP) GROUP BY r)") + \
    "SELECT ticker, bar_date, " + O.rnd("close") + " AS close, " + O.rnd("revenue") + " AS revenue, n FROM lr LEFT JOIN mt USING (r)"


def _asof_odd(strategy):
    def fn(spark, sf):
        v = F.col("volume").cast("long")
        left = T.bars(spark, sf).select(F.when(v % 5 != 0, F.col("ticker")).alias("ticker"),
                                        F.when(v % 7 != 0, F.col("bar_date")).alias("bar_date"), "close")
        odd = (F.month("quarter_end") == 6) & (F.col("ticker") == "Brand#11")
        right = T.quarterly_raw(spark, sf).select(
            F.when(~odd, F.col("ticker")).alias("ticker"),
            (F.date_trunc("week", "quarter_end") + F.expr("INTERVAL 17 HOURS")).alias("ts"), "revenue",
            F.explode(F.array(F.lit(9), F.lit(10))).alias("n"))
        return asof_backward(left, right, "ticker", "bar_date", "ts", ["revenue", "n"], right_tiebreak="n", strategy=strategy)
    return fn


register("b03_asof_odd_rows_scan", _ODD_SQL)(_asof_odd("scan"))
register("b03_asof_odd_rows_range", _ODD_SQL)(_asof_odd("range"))
