"""Technical indicators (D1-D29), candle flags and forward labels in one pass.

Input: bars with ``key`` columns (default ``ticker``), ``bar_date`` and
``open, high, low, close, volume``; one row per (key, bar_date); other
columns pass through. All windows count *rows*, not days.

Physical plan: one shuffle of the bars by (key, block) (plus the small row
numbering join), then a chain of Window operators that share one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.functions.columns import tdiv
from barlab.operators import candles
from barlab.operators.ewm import EwmSpec, add_ewm, depth, sub_rows_for
from barlab.operators.series import NTOT, RN, _as_list, block_window, blocked, carried, finish, full, number_rows, rows, to_blocks
from barlab.params import FeatureParams, LabelParams, SeriesLayout
from barlab.session import cut_lineage

# Output and warm-up column names (fixed values).
INDICATOR_COLS = (
    "daily_return", "MA7", "MA21", "MA_crossover", "RSI_14",
    "MACD", "MACD_signal", "MACD_hist",
    "BB_upper", "BB_lower", "BB_width",
    "volume_change", "price_range",
    "Stoch_K", "Stoch_D", "ATR_14", "ADX_14", "OBV_roc_5",
    "daily_return_lag1", "RSI_14_lag1",
    "daily_return_lag2", "RSI_14_lag2",
    "daily_return_lag3", "RSI_14_lag3",
)
LABEL_COLS = ("forward_close", "forward_return", "label")
WARMUP_COLS = (
    "MA21", "RSI_14", "MACD_signal", "BB_width",
    "Stoch_D", "ATR_14", "ADX_14", "OBV_roc_5", "daily_return_lag3",
)


def _round1_specs(fp: FeatureParams) -> list[EwmSpec]:
    return [
        EwmSpec.span("_ema_fast", "close", fp.macd_fast),
        EwmSpec.span("_ema_slow", "close", fp.macd_slow),
        EwmSpec("_atr_w", "_tr", 1.0 / fp.adx),
        EwmSpec("_pdm_w", "_pdm", 1.0 / fp.adx),
        EwmSpec("_mdm_w", "_mdm", 1.0 / fp.adx),
    ]


def _round2_specs(fp: FeatureParams) -> list[EwmSpec]:
    return [
        EwmSpec.span("MACD_signal", "MACD", fp.macd_signal),
        EwmSpec("ADX_14", "DX", 1.0 / fp.adx),
    ]


def halo_back(fp: FeatureParams) -> tuple[int, int]:
    """(rows of history a block needs, sub-block size) for the full feature set."""
    r1, r2 = _round1_specs(fp), _round2_specs(fp)
    s = sub_rows_for([sp.alpha for sp in r1 + r2])
    d1 = max(depth(sp.alpha, s) for sp in r1)
    d2 = max(depth(sp.alpha, s) for sp in r2)
    need = d1 + d2 + fp.bounded_lookback() + max(fp.lags) + fp.stoch_smooth
    return -(-need // s) * s, s


def compute_features(
    bars: DataFrame,
    fp: FeatureParams = FeatureParams(),
    layout: SeriesLayout = SeriesLayout(),
    labels: LabelParams | None = None,
    drop_unlabelled: bool = True,
    extra: tuple[str, ...] = (),
    store: bool = False,
) -> DataFrame:
    """D29 (+ E candles, + F1-F3 when ``labels`` is given). Never drops rows
    unless labels are requested (then: tail rows and neutral rows go, F3,
    unless ``drop_unlabelled`` is False). ``extra`` keeps intermediate columns
    (true range ``_tr``, directional moves ``_pdm``/``_mdm``, ``_pdi``/``_mdi``, ``DX``).
    ``store`` checkpoints the rows before either smoothing round, which reads them
    twice; without it the plan stays one, and columns nobody selects cost nothing."""
    key = _as_list(layout.key)
    back, s = halo_back(fp)
    if layout.back is not None:
        back = max(back, layout.back)
    ahead = labels.horizon if labels is not None else 0
    if layout.ahead is not None:
        ahead = max(ahead, layout.ahead)
    if layout.order != "bar_date":
        bars = bars.withColumnRenamed(layout.order, "bar_date")
    # bars are built and numbered once; windows, carries and smoothers read the stored rows
    numbered = cut_lineage(number_rows(cut_lineage(bars), key, "bar_date", layout.segment))
    b = to_blocks(numbered, layout.block_rows, back, ahead, s)
    # Expressions are SQL text: one call per expression instead of one per
    # function node, which keeps building this plan cheap. W is the block
    # window (own rows + halo, row order); R(n) its frame of n rows.
    W = "(PARTITION BY _skey, _blk ORDER BY _sub, _rn)"

    def R(n: int) -> str:
        return f"(PARTITION BY _skey, _blk ORDER BY _sub, _rn ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"

    def full(agg: str, x: str, n: int) -> str:
        return f"CASE WHEN count({x}) OVER {R(n)} = {n} THEN {agg}({x}) OVER {R(n)} END"

    def add(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
        return df.withColumns({k: F.expr(v) for k, v in exprs.items()})

    # stage A: raw differences and bounded windows over OHLCV
    upto = "(PARTITION BY _skey, _blk ORDER BY _sub, _rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    # changes are taken between padded values: a missing close or volume stands at the last one
    b = add(b, {"_pc": f"lag(close, 1) OVER {W}", "_ph": f"lag(high, 1) OVER {W}", "_pl": f"lag(low, 1) OVER {W}",
                "_cpad": f"last(close, true) OVER {upto}", "_vpad": f"last(volume, true) OVER {upto}"})
    b = carried(b, ["_cpad", "_vpad"])
    b = add(b, {"_pcpad": f"lag(_cpad, 1) OVER {W}", "_pvpad": f"lag(_vpad, 1) OVER {W}"})
    b = add(b, {
        "daily_return": "try_divide(_cpad, _pcpad) - 1",
        "MA7": full("avg", "close", fp.ma_short),
        "MA21": full("avg", "close", fp.ma_long),
        "_gain": "CASE WHEN close - _pc IS NOT NULL THEN greatest(close - _pc, 0.0D) END",
        "_loss": "CASE WHEN close - _pc IS NOT NULL THEN greatest(-(close - _pc), 0.0D) END",
        "_bb_mid": full("avg", "close", fp.bb_window),
        "_bb_std": full("stddev_samp", "close", fp.bb_window),
        "volume_change": "try_divide(_vpad, _pvpad) - 1",
        "price_range": "try_divide(high - low, low)",
        "_ll": full("min", "low", fp.stoch_window),
        "_hh": full("max", "high", fp.stoch_window),
        "_tr": "greatest(high - low, abs(high - _pc), abs(low - _pc))",
        "_up": "high - _ph",
        "_down": "_pl - low",
        "_dir": "coalesce(signum(close - _pc), 0.0D)",
        **candles.geometry_sql(W, fp.trend_window, "_cpad"),
    })

    # stage B: indicators over stage-A columns
    ow = fp.obv_window
    b = add(b, {
        "MA_crossover": "CAST(coalesce(MA7 > MA21, false) AS INT)",
        "RSI_14": f"100.0D - try_divide(100.0D, 1 + try_divide({full('avg', '_gain', fp.rsi)}, {full('avg', '_loss', fp.rsi)}))",
        "BB_upper": f"_bb_mid + {fp.bb_std!r}D * _bb_std",
        "BB_lower": f"_bb_mid - {fp.bb_std!r}D * _bb_std",
        "Stoch_K": "try_divide(100 * (close - _ll), _hh - _ll)",
        "ATR_14": full("avg", "_tr", fp.atr),
        "_pdm": "CASE WHEN _up > _down AND _up > 0 THEN _up ELSE 0.0D END",
        "_mdm": "CASE WHEN _down > _up AND _down > 0 THEN _down ELSE 0.0D END",
        "OBV_roc_5": (f"CASE WHEN count(1) OVER {R(ow + 1)} = {ow + 1} THEN "
                      f"try_divide(sum(_dir * volume) OVER {R(ow)}, {full('sum', 'volume', ow)}) END"),
        **{f"daily_return_lag{k}": f"lag(daily_return, {k}) OVER {W}" for k in fp.lags},
        **candles.flags_sql(),
    })

    # stage C: second-order bounded windows, candle counts, first smoothing round
    b = add(b, {
        "BB_width": "try_divide(BB_upper - BB_lower, _bb_mid)",
        "Stoch_D": full("avg", "Stoch_K", fp.stoch_smooth),
        **{f"RSI_14_lag{k}": f"lag(RSI_14, {k}) OVER {W}" for k in fp.lags},
        **candles.counts_sql(),
    })
    seen = layout.block_rows + back + ahead
    b = cut_lineage(b) if store else b
    b = add_ewm(b, key, _round1_specs(fp), s, layout.block_rows, seen)
    b = add(b, {"MACD": "_ema_fast - _ema_slow", "_pdi": "try_divide(100 * _pdm_w, _atr_w)",
                "_mdi": "try_divide(100 * _mdm_w, _atr_w)"})
    b = add(b, {"DX": "try_divide(100 * abs(_pdi - _mdi), _pdi + _mdi)"})

    # stage D: second smoothing round
    b = cut_lineage(b) if store else b
    b = add_ewm(b, key, _round2_specs(fp), s, layout.block_rows, seen)
    b = add(b, {"MACD_hist": "MACD - MACD_signal"})

    if labels is not None:
        z = labels.neutral_zone_pct
        b = add(b, {"forward_close": f"lead(close, {labels.horizon}) OVER {W}"})
        b = add(b, {"forward_return": "try_divide(forward_close - close, close)"})
        b = add(b, {"label": f"CAST(CASE WHEN forward_return > {z!r}D THEN 1 WHEN forward_return < -{z!r}D THEN 0 END AS INT)"})
        if drop_unlabelled:
            b = b.filter((F.col(RN) < F.col(NTOT) - labels.horizon) & F.col("label").isNotNull())

    passthrough = [x for x in bars.columns if x not in key and x != "bar_date"]
    out_cols = key + ["bar_date"] + passthrough + list(INDICATOR_COLS) + list(candles.CANDLE_COLS) + list(extra)
    if labels is not None:
        out_cols += list(LABEL_COLS)
    return finish(b).select(*out_cols)


def run_feature_engineering(
    bars: DataFrame,
    fp: FeatureParams = FeatureParams(),
    labels: LabelParams = LabelParams(),
    layout: SeriesLayout = SeriesLayout(),
) -> DataFrame:
    """features -> labels -> drop tail/neutral rows -> drop warm-up rows."""
    df = compute_features(bars, fp, layout, labels, store=True)
    return df.na.drop(subset=list(WARMUP_COLS))


def rolling_stats(bars: DataFrame, col: str, n: int, layout: SeriesLayout = SeriesLayout()) -> DataFrame:
    """Rolling mean / sample std / min / max / sum over ``n`` rows, NULL until
    ``n`` non-null values are in the frame (blocked layout, halo ``n``)."""
    key = _as_list(layout.key)
    b = blocked(bars, key, layout.order, layout.block_rows, n, 0, layout.segment)
    w = block_window(key)
    x = F.col(col)
    b = b.withColumns({f"{col}_mean{n}": full(F.avg, x, w, n), f"{col}_std{n}": full(F.stddev_samp, x, w, n),
                       f"{col}_min{n}": full(F.min, x, w, n), f"{col}_max{n}": full(F.max, x, w, n),
                       f"{col}_sum{n}": full(F.sum, x, w, n)})
    return finish(b)


def pct_change(bars: DataFrame, col: str, n: int = 1, pad: bool = True, out: str | None = None,
               layout: SeriesLayout = SeriesLayout()) -> DataFrame:
    """``x / x(n rows back) - 1``; with ``pad`` missing values are forward
    filled first (pandas 2.x default). The fill is a blocked prefix scan."""
    from barlab.operators.scan import prefix_last

    key = _as_list(layout.key)
    src = bars
    if pad:
        src = prefix_last(bars.withColumn("_pc_src", F.col(col)), key, layout.order, ["_pc_src"], layout.block_rows)
    else:
        src = bars.withColumn("_pc_src", F.col(col))
    b = blocked(src, key, layout.order, layout.block_rows, n, 0, layout.segment)
    w = block_window(key)
    b = b.withColumn(out or f"{col}_pct{n}", tdiv(F.col("_pc_src"), F.lag("_pc_src", n).over(w)) - 1)
    return finish(b).drop("_pc_src")


def candle_geometry(bars: DataFrame, fp: FeatureParams = FeatureParams(), layout: SeriesLayout = SeriesLayout()) -> DataFrame:
    """Body, range (flat -> NULL), upper / lower shadow, prior trend."""
    from barlab.operators.scan import prefix_last

    key = _as_list(layout.key)
    padded = prefix_last(bars.withColumn("_cpad", F.col("close")), key, layout.order, ["_cpad"], layout.block_rows)
    b = blocked(padded, key, layout.order, layout.block_rows, fp.trend_window, 0, layout.segment)
    b = b.withColumns({k: F.expr(v) for k, v in candles.geometry_sql("(PARTITION BY _skey, _blk ORDER BY _sub, _rn)",
                                                                       fp.trend_window, "_cpad").items()})
    b = b.select("*", *[F.col(c).alias(c[1:]) for c in ("_body", "_range", "_upper", "_lower", "_trend")])
    return finish(b).drop(*candles.GEOMETRY_TMP, "_cpad")
