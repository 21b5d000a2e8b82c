"""DuckDB SQL for the correctness gate: the same fixtures and operators written
as plain ANSI-style SQL over the driver's parquet views.

Conventions (shared with the Spark side): computed doubles go through ``rnd``,
the twin of ``functions.columns.round_compare`` (the coarser of 6 decimals and 8
significant digits, exact power-of-ten literals); every division that Spark
writes as ``try_divide`` is written with ``NULLIF(den, 0)``; windows order by
``bar_date`` within ``ticker``.
"""

from __future__ import annotations


_POW = "[" + ", ".join(f"1e{i}" for i in range(23)) + "]"


def rnd(expr: str, decimals: int = 6, digits: int = 8) -> str:
    """SQL twin of ``functions.columns.round_compare``."""
    k = f"least({decimals}, {digits - 1} - CAST(floor(log10(abs({expr}))) AS BIGINT))"
    p = f"{_POW}[least(abs({k}), 22) + 1]"
    return (f"(CASE WHEN ({expr}) IS NULL OR ({expr}) = 0 THEN CAST({expr} AS DOUBLE) "
            f"WHEN {k} >= 0 THEN round(({expr}) * {p}) / {p} ELSE round(({expr}) / {p}) * {p} END)")


def r6(*cols: str) -> str:
    return ", ".join(f"{rnd(c)} AS {c}" for c in cols)


BARS = """
bars AS (
  SELECT p_brand AS ticker, CAST(date_trunc('week', l_shipdate) AS DATE) AS bar_date,
         first(price ORDER BY l_shipdate, l_orderkey, l_linenumber, price) AS open,
         max(price) AS high, min(price) AS low,
         last(price ORDER BY l_shipdate, l_orderkey, l_linenumber, price) AS close,
         CAST(sum(l_quantity) AS DOUBLE) AS volume
  FROM (SELECT *, l_extendedprice / NULLIF(l_quantity, 0) AS price FROM lineitem JOIN part ON l_partkey = p_partkey)
  GROUP BY 1, 2
)"""

QUARTERLY_RAW = """
quarterly_raw AS (
  SELECT p_brand AS ticker,
         CAST(date_trunc('quarter', l_shipdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(1 - l_discount AS DECIMAL(4,2))) AS DOUBLE) AS revenue,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(0.05 - l_discount AS DECIMAL(4,2))) AS DOUBLE) AS net_income
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2
)"""

INDEX = """
idx AS (
  SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS bar_date,
         stddev_samp(o_totalprice) / 1000 AS vix, avg(o_totalprice) AS nifty
  FROM orders GROUP BY 1
)"""

FUND = """
fund AS (
  SELECT p_brand AS ticker,
         CASE WHEN p_brand IN ('Brand#3', 'Brand#17') THEN NULL ELSE avg(p_retailprice) / avg(p_size) END AS pe_ratio,
         avg(p_retailprice) / 10 AS eps,
         sum(p_retailprice) * 1e6 AS market_cap,
         avg(p_size) * 2 AS debt_to_equity,
         avg(p_size) / 25 AS current_ratio
  FROM part GROUP BY 1
)"""

SCORED = """
scored AS (
  SELECT ((l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 1001) / CAST(1000 AS DOUBLE) AS p,
         CAST(l_quantity > 25 AS INTEGER) AS label
  FROM lineitem
)"""

RUNS = """
runs AS (
  SELECT event_id AS run_id, event_type AS run_name, ts AS start_time,
         value / 500 AS accuracy, CAST(user_id AS VARCHAR) AS model_name, props
  FROM events
)"""


def _ewm(x: str, alpha: str, where: str | None = None) -> str:
    filt = f" FILTER (WHERE {where})" if where else ""
    return (f"list_reduce(list({x}){filt} OVER wu, "
            f"lambda acc, v: acc * (1 - ({alpha})) + v * ({alpha}))")


def _full(agg: str, x: str, n: int) -> str:
    return (f"CASE WHEN count({x}) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) = {n} "
            f"THEN {agg}({x}) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END")


def _flag(cond: str) -> str:
    return f"CAST(CASE WHEN {cond} THEN 1 ELSE 0 END AS INTEGER)"


def features_ctes(src: str = "bars", horizon: int = 5, zone: float = 0.10) -> str:
    """CTE chain f1..f7 computing every indicator, candle flag and label on ``src``."""
    return f"""
f1 AS (
  SELECT s.*,
    lag(close, 1) OVER w AS pc, lag(high, 1) OVER w AS ph, lag(low, 1) OVER w AS pl,
    lag(volume, 1) OVER w AS pv, lag(close, 5) OVER w AS c5,
    lag(open, 1) OVER w AS o1, lag(close, 1) OVER w AS c1, lag(open, 2) OVER w AS o2, lag(close, 2) OVER w AS c2,
    lead(close, {horizon}) OVER w AS fwd_close,
    row_number() OVER w - 1 AS rn, count(*) OVER (PARTITION BY ticker) AS n_rows
  FROM {src} s WINDOW w AS (PARTITION BY ticker ORDER BY bar_date)
),
f2 AS (
  SELECT *,
    close / NULLIF(pc, 0) - 1 AS daily_return,
    {_full('avg', 'close', 7)} AS MA7,
    {_full('avg', 'close', 21)} AS MA21,
    CASE WHEN close - pc IS NOT NULL THEN greatest(close - pc, 0.0) END AS gain,
    CASE WHEN close - pc IS NOT NULL THEN greatest(-(close - pc), 0.0) END AS loss,
    {_full('avg', 'close', 20)} AS bb_mid,
    {_full('stddev_samp', 'close', 20)} AS bb_std,
    volume / NULLIF(pv, 0) - 1 AS volume_change,
    (high - low) / NULLIF(low, 0) AS price_range,
    {_full('min', 'low', 14)} AS ll,
    {_full('max', 'high', 14)} AS hh,
    greatest(high - low, abs(high - pc), abs(low - pc)) AS tr,
    high - ph AS up_move, pl - low AS down_move,
    coalesce(CAST(sign(close - pc) AS DOUBLE), 0.0) AS dir,
    abs(close - open) AS body, NULLIF(high - low, 0) AS rng,
    high - greatest(open, close) AS upper_sh, least(open, close) - low AS lower_sh,
    close / NULLIF(c5, 0) - 1 AS trend
  FROM f1
),
f3 AS (
  SELECT *,
    {_flag('MA7 > MA21')} AS MA_crossover,
    100 - 100 / (1 + ({_full('avg', 'gain', 14)}) / NULLIF({_full('avg', 'loss', 14)}, 0)) AS RSI_14,
    bb_mid + 2 * bb_std AS BB_upper,
    bb_mid - 2 * bb_std AS BB_lower,
    100 * (close - ll) / NULLIF(hh - ll, 0) AS Stoch_K,
    {_full('avg', 'tr', 14)} AS ATR_14,
    CASE WHEN up_move > down_move AND up_move > 0 THEN up_move ELSE 0.0 END AS pdm,
    CASE WHEN down_move > up_move AND down_move > 0 THEN down_move ELSE 0.0 END AS mdm,
    CASE WHEN count(*) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) = 6
         THEN sum(dir * volume) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
              / NULLIF({_full('sum', 'volume', 5)}, 0) END AS OBV_roc_5,
    lag(daily_return, 1) OVER w AS daily_return_lag1,
    lag(daily_return, 2) OVER w AS daily_return_lag2,
    lag(daily_return, 3) OVER w AS daily_return_lag3,
    {_flag('body <= 0.1 * rng')} AS candle_doji,
    {_flag('body >= 0.9 * rng AND close > open')} AS candle_bullish_marubozu,
    {_flag('body >= 0.9 * rng AND close < open')} AS candle_bearish_marubozu,
    {_flag('lower_sh >= 2 * body AND upper_sh <= 0.3 * body AND body > 0 AND trend < 0')} AS candle_hammer,
    {_flag('upper_sh >= 2 * body AND lower_sh <= 0.3 * body AND body > 0 AND trend < 0')} AS candle_inverted_hammer,
    {_flag('upper_sh >= 2 * body AND lower_sh <= 0.3 * body AND body > 0 AND trend > 0')} AS candle_shooting_star,
    {_flag('c1 < o1 AND close > open AND open <= c1 AND close >= o1')} AS candle_bullish_engulfing,
    {_flag('c1 > o1 AND close < open AND open >= c1 AND close <= o1')} AS candle_bearish_engulfing,
    {_flag('c2 < o2 AND abs(c2 - o2) > 0 AND abs(c1 - o1) <= 0.3 * abs(c2 - o2) AND close > open AND close >= (o2 + c2) / 2')} AS candle_morning_star,
    {_flag('c2 > o2 AND abs(c2 - o2) > 0 AND abs(c1 - o1) <= 0.3 * abs(c2 - o2) AND close < open AND close <= (o2 + c2) / 2')} AS candle_evening_star,
    {_ewm('close', '2.0 / 13')} AS ema_fast,
    {_ewm('close', '2.0 / 27')} AS ema_slow,
    {_ewm('tr', '1.0 / 14')} AS atr_w,
    {_ewm('pdm', '1.0 / 14')} AS pdm_w,
    {_ewm('mdm', '1.0 / 14')} AS mdm_w
  FROM f2
  WINDOW w AS (PARTITION BY ticker ORDER BY bar_date),
         wu AS (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
f4 AS (
  SELECT *,
    (BB_upper - BB_lower) / NULLIF(bb_mid, 0) AS BB_width,
    {_full('avg', 'Stoch_K', 3)} AS Stoch_D,
    lag(RSI_14, 1) OVER w AS RSI_14_lag1,
    lag(RSI_14, 2) OVER w AS RSI_14_lag2,
    lag(RSI_14, 3) OVER w AS RSI_14_lag3,
    candle_bullish_marubozu + candle_hammer + candle_inverted_hammer + candle_bullish_engulfing + candle_morning_star
      AS candle_bullish_signal_count,
    candle_bearish_marubozu + candle_shooting_star + candle_bearish_engulfing + candle_evening_star
      AS candle_bearish_signal_count,
    ema_fast - ema_slow AS MACD,
    100 * pdm_w / NULLIF(atr_w, 0) AS pdi,
    100 * mdm_w / NULLIF(atr_w, 0) AS mdi
  FROM f3 WINDOW w AS (PARTITION BY ticker ORDER BY bar_date)
),
f5 AS (
  SELECT *,
    candle_bullish_signal_count - candle_bearish_signal_count AS candle_net_signal,
    100 * abs(pdi - mdi) / NULLIF(pdi + mdi, 0) AS DX
  FROM f4
),
f6 AS (
  SELECT *,
    {_ewm('MACD', '2.0 / 10')} AS MACD_signal,
    {_ewm('DX', '1.0 / 14', 'DX IS NOT NULL')} AS ADX_14
  FROM f5
  WINDOW wu AS (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
feat AS (
  SELECT *, MACD - MACD_signal AS MACD_hist,
    fwd_close AS forward_close,
    (fwd_close - close) / NULLIF(close, 0) AS forward_return,
    CAST(CASE WHEN (fwd_close - close) / NULLIF(close, 0) > {zone} THEN 1
              WHEN (fwd_close - close) / NULLIF(close, 0) < -{zone} THEN 0 END AS INTEGER) AS label
  FROM f6
),
labelled AS (
  SELECT * FROM feat WHERE rn < n_rows - {horizon} AND label IS NOT NULL
),
featured AS (
  SELECT * FROM labelled
  WHERE MA21 IS NOT NULL AND RSI_14 IS NOT NULL AND MACD_signal IS NOT NULL AND BB_width IS NOT NULL
    AND Stoch_D IS NOT NULL AND ATR_14 IS NOT NULL AND ADX_14 IS NOT NULL AND OBV_roc_5 IS NOT NULL
    AND daily_return_lag3 IS NOT NULL
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


INDICATOR_DOUBLES = (
    "daily_return", "MA7", "MA21", "RSI_14", "MACD", "MACD_signal", "MACD_hist",
    "BB_upper", "BB_lower", "BB_width", "volume_change", "price_range",
    "Stoch_K", "Stoch_D", "ATR_14", "ADX_14", "OBV_roc_5",
    "daily_return_lag1", "RSI_14_lag1", "daily_return_lag2", "RSI_14_lag2",
    "daily_return_lag3", "RSI_14_lag3",
)
CANDLE_INTS = (
    "candle_doji", "candle_bullish_marubozu", "candle_bearish_marubozu", "candle_hammer",
    "candle_inverted_hammer", "candle_shooting_star", "candle_bullish_engulfing",
    "candle_bearish_engulfing", "candle_morning_star", "candle_evening_star",
    "candle_bullish_signal_count", "candle_bearish_signal_count", "candle_net_signal",
)


HIST = """
hist0 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY quarter_end DESC) AS qr FROM quarterly_raw)
  WHERE qr <= 8
),
hist1 AS (
  SELECT *,
    last_value(revenue IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY quarter_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS rev_f,
    last_value(net_income IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY quarter_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ni_f
  FROM hist0
),
hist2 AS (
  SELECT ticker, quarter_end, CAST(quarter_end + INTERVAL 45 DAY AS DATE) AS available_date, revenue, net_income,
    rev_f / NULLIF(lag(rev_f, 1) OVER w, 0) - 1 AS revenue_qoq_growth,
    ni_f / NULLIF(lag(ni_f, 1) OVER w, 0) - 1 AS net_income_qoq_growth,
    rev_f / NULLIF(lag(rev_f, 4) OVER w, 0) - 1 AS revenue_yoy_growth,
    ni_f / NULLIF(lag(ni_f, 4) OVER w, 0) - 1 AS net_income_yoy_growth
  FROM hist1 WINDOW w AS (PARTITION BY ticker ORDER BY quarter_end)
),
hist3 AS (
  SELECT *, CASE WHEN net_income_yoy_growth IS NULL THEN 0 WHEN net_income_yoy_growth > 0 THEN 1 ELSE -1 END AS cls
  FROM hist2
),
hist4 AS (
  SELECT *, CASE WHEN lag(cls) OVER (PARTITION BY ticker ORDER BY quarter_end) IS NOT DISTINCT FROM cls THEN 0 ELSE 1 END AS chg
  FROM hist3
),
hist5 AS (
  SELECT *, sum(chg) OVER (PARTITION BY ticker ORDER BY quarter_end ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island
  FROM hist4
),
hist AS (
  SELECT ticker, quarter_end, available_date, revenue, net_income,
    revenue_qoq_growth, net_income_qoq_growth, revenue_yoy_growth, net_income_yoy_growth,
    CAST(cls * row_number() OVER (PARTITION BY ticker, island ORDER BY quarter_end) AS INTEGER) AS earnings_growth_streak
  FROM hist5
)"""

HIST_COLS = ("revenue", "net_income", "revenue_qoq_growth", "net_income_qoq_growth",
             "revenue_yoy_growth", "net_income_yoy_growth")

# merged input of preprocessing: bars + index levels (ingest) + snapshot + quarterly as of each bar
MERGED = """
with_idx AS (SELECT b.*, i.vix, i.nifty FROM bars b LEFT JOIN idx i ON b.bar_date = i.bar_date),
with_fund AS (
  SELECT w.*, f.pe_ratio, f.eps, f.market_cap, f.debt_to_equity, f.current_ratio
  FROM with_idx w LEFT JOIN fund f ON w.ticker = f.ticker
),
merged AS (
  SELECT w.*, h.revenue, h.net_income, h.revenue_yoy_growth, h.net_income_yoy_growth,
         h.revenue_qoq_growth, h.net_income_qoq_growth, h.earnings_growth_streak
  FROM with_fund w ASOF LEFT JOIN hist h ON w.ticker = h.ticker AND w.bar_date >= h.available_date
)"""

MERGED_NUMERIC = ("open", "high", "low", "close", "volume", "vix", "nifty", "pe_ratio", "eps", "market_cap",
                  "debt_to_equity", "current_ratio", "revenue", "net_income", "revenue_yoy_growth",
                  "net_income_yoy_growth", "revenue_qoq_growth", "net_income_qoq_growth", "earnings_growth_streak")


def ffill_cte(name: str, src: str, cols) -> str:
    sel = ", ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY ticker ORDER BY bar_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in cols)
    return f"{name} AS (SELECT * EXCLUDE ({', '.join(cols)}), {sel} FROM {src})"


def median_fill_cte(name: str, src: str, cols) -> str:
    sel = ", ".join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM {src})) AS {c}" for c in cols)
    return f"{name} AS (SELECT * EXCLUDE ({', '.join(cols)}), {sel} FROM {src})"


STATEMENTS = """
statements AS (
  SELECT ticker, 'Total Revenue' AS item, quarter_end AS period, revenue AS value FROM quarterly_raw
  UNION ALL SELECT ticker, 'Net Income', quarter_end, net_income FROM quarterly_raw
  UNION ALL SELECT * FROM (
    WITH y AS (
      SELECT p_brand AS ticker, make_date(year(l_shipdate), 12, 31) AS period,
             sum(l_extendedprice * (1 - l_discount)) AS ocf, sum(l_extendedprice * (0.03 - l_discount)) AS fcf,
             sum(l_extendedprice) AS ca, sum(l_extendedprice * l_discount) AS cl
      FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)
    SELECT ticker, 'Operating Cash Flow', period, ocf FROM y
    UNION ALL SELECT ticker, 'Free Cash Flow', period, fcf FROM y
    UNION ALL SELECT ticker, 'Current Assets', period, ca FROM y
    UNION ALL SELECT ticker, 'Current Liabilities', period, cl FROM y)
)"""


def latest_item_sql(item: str) -> str:
    return f"arg_max(value, period) FILTER (WHERE item = '{item}')"


SNAPSHOT = """
snapshot AS (
  SELECT coalesce(f.ticker, s.ticker) AS ticker, f.pe_ratio, f.eps, f.market_cap, f.debt_to_equity,
         s.latest_revenue, s.latest_net_income, s.operating_cash_flow, s.free_cash_flow, s.current_ratio
  FROM fund f FULL JOIN (
    SELECT ticker,
      """ + latest_item_sql("Total Revenue") + """ AS latest_revenue,
      """ + latest_item_sql("Net Income") + """ AS latest_net_income,
      """ + latest_item_sql("Operating Cash Flow") + """ AS operating_cash_flow,
      """ + latest_item_sql("Free Cash Flow") + """ AS free_cash_flow,
      """ + latest_item_sql("Current Assets") + """ / NULLIF(""" + latest_item_sql("Current Liabilities") + """, 0) AS current_ratio
    FROM statements GROUP BY ticker) s ON f.ticker = s.ticker
)"""
