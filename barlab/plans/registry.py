"""Named queries over the driver fixtures, one per inventory row, with their SQL.

Keys follow ``<id>_<name>``. Each entry pairs a Spark callable with the DuckDB
SQL that computes the same table (or ``None`` for rows-only checks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlab import oracle as O
from barlab.functions.columns import round_doubles
from barlab.operators import candles as C
from barlab.operators.indicators import compute_features, run_feature_engineering
from barlab.params import LabelParams
from barlab.sources import tables as T

# Weekly fixture returns are large; the label queries use a 10 % zone.
FIXTURE_LABELS = LabelParams(horizon=5, neutral_zone_pct=0.10)

_REG: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        _REG[name] = (lambda spark, sf_dir, _fn=fn: round_doubles(_fn(spark, sf_dir)), sql)
        return fn
    return deco


def queries() -> dict:
    _load()
    return {k: v[0] for k, v in _REG.items()}


def oracle_sql() -> dict:
    _load()
    return {k: v[1] for k, v in _REG.items() if v[1] is not None}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_doubles(run_feature_engineering(T.bars(spark, sf_dir), labels=FIXTURE_LABELS))


_loaded = False


def _load():
    global _loaded
    if _loaded:
        return
    _loaded = True
    from barlab.plans import registry_models, registry_more, registry_stats  # noqa: F401  (register the remaining groups)


# ---------------------------------------------------------------- A: bars
@register("a02_build_bars", O.with_(O.BARS) + "SELECT ticker, bar_date, " + O.r6("open", "high", "low", "close", "volume") + " FROM bars")
def _a02(spark, sf):
    return T.bars(spark, sf)


# ---------------------------------------------------------------- D/E: features
def _feat(spark, sf):
    return compute_features(T.bars(spark, sf))


def _feat_sql(cols: list[str], ints: list[str] = ()) -> str:
    sel = ["ticker", "bar_date"] + [f"{O.rnd(c)} AS {c}" for c in cols] + list(ints)
    return O.with_(O.BARS, O.features_ctes()) + "SELECT " + ", ".join(sel) + " FROM feat"


def _feat_query(name: str, cols: list[str], ints: list[str] = ()):
    def fn(spark, sf):
        return _feat(spark, sf).select("ticker", "bar_date", *cols, *ints)
    register(name, _feat_sql(cols, ints))(fn)


for _name, _cols, _ints in [
    ("d01_daily_return", ["daily_return"], []),
    ("d02_ma7", ["MA7"], []),
    ("d03_ma21", ["MA21"], []),
    ("d04_ma_crossover", [], ["MA_crossover"]),
    ("d05_rsi14", ["RSI_14"], []),
    ("d07_macd", ["MACD"], []),
    ("d08_macd_signal", ["MACD_signal"], []),
    ("d09_macd_hist", ["MACD_hist"], []),
    ("d10_bollinger", ["BB_upper", "BB_lower"], []),
    ("d11_bb_width", ["BB_width"], []),
    ("d12_volume_change", ["volume_change"], []),
    ("d13_price_range", ["price_range"], []),
    ("d14_stoch_k", ["Stoch_K"], []),
    ("d15_stoch_d", ["Stoch_D"], []),
    ("d17_atr14", ["ATR_14"], []),
    ("d21_adx14", ["ADX_14"], []),
    ("d23_obv_roc5", ["OBV_roc_5"], []),
    ("d24_return_lags", ["daily_return_lag1", "daily_return_lag2", "daily_return_lag3"], []),
    ("d25_rsi_lags", ["RSI_14_lag1", "RSI_14_lag2", "RSI_14_lag3"], []),
    ("d29_technical_features", list(O.INDICATOR_DOUBLES), list(O.CANDLE_INTS) + ["MA_crossover"]),
    ("e01_doji", [], ["candle_doji"]),
    ("e02_bullish_marubozu", [], ["candle_bullish_marubozu"]),
    ("e03_bearish_marubozu", [], ["candle_bearish_marubozu"]),
    ("e04_hammer", [], ["candle_hammer"]),
    ("e05_inverted_hammer", [], ["candle_inverted_hammer"]),
    ("e06_shooting_star", [], ["candle_shooting_star"]),
    ("e07_bullish_engulfing", [], ["candle_bullish_engulfing"]),
    ("e08_bearish_engulfing", [], ["candle_bearish_engulfing"]),
    ("e09_morning_star", [], ["candle_morning_star"]),
    ("e10_evening_star", [], ["candle_evening_star"]),
    ("e11_bullish_signal_count", [], ["candle_bullish_signal_count"]),
    ("e12_bearish_signal_count", [], ["candle_bearish_signal_count"]),
    ("e13_net_signal", [], ["candle_net_signal"]),
]:
    _feat_query(_name, _cols, _ints)


def _hits_sql(side: str) -> str:
    if side == "bullish":
        cols = ["candle_hammer", "candle_inverted_hammer", "candle_bullish_marubozu",
                "candle_bullish_engulfing", "candle_morning_star"]
        marker = "low * 0.985"
    else:
        cols = ["candle_shooting_star", "candle_bearish_marubozu", "candle_bearish_engulfing", "candle_evening_star"]
        marker = "high * 1.015"
    names = ", ".join(f"CASE WHEN {c} = 1 THEN '{C.PATTERN_NAMES[c]}' END" for c in cols)
    return (O.with_(O.BARS, O.features_ctes()) +
            f"SELECT ticker, bar_date, {O.rnd(marker)} AS marker, "
            f"array_to_string(list_filter([{names}], lambda x: x IS NOT NULL), ', ') AS patterns "
            f"FROM feat WHERE {' + '.join(cols)} > 0")


@register("e14_bullish_pattern_hits", _hits_sql("bullish"))
def _e14a(spark, sf):
    return C.pattern_hits(_feat(spark, sf), "bullish")


@register("e14_bearish_pattern_hits", _hits_sql("bearish"))
def _e14b(spark, sf):
    return C.pattern_hits(_feat(spark, sf), "bearish")


# ---------------------------------------------------------------- F: labels
_LABEL_DOUBLES = ["forward_close", "forward_return"]


@register("f03_labelled_rows",
          O.with_(O.BARS, O.features_ctes()) + "SELECT ticker, bar_date, " + O.r6(*_LABEL_DOUBLES) + ", label FROM labelled")
def _f03(spark, sf):
    return compute_features(T.bars(spark, sf), labels=FIXTURE_LABELS).select(
        "ticker", "bar_date", *_LABEL_DOUBLES, "label")


_FEATURED_COLS = (["ticker", "bar_date"] + [f"{O.rnd(c)} AS {c}" for c in
                  ["open", "high", "low", "close", "volume", *O.INDICATOR_DOUBLES, *_LABEL_DOUBLES]]
                  + ["MA_crossover", *O.CANDLE_INTS, "label"])


@register("f05_featured", O.with_(O.BARS, O.features_ctes()) + "SELECT " + ", ".join(_FEATURED_COLS) + " FROM featured")
def _f05(spark, sf):
    return run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS)


@register("f04_label_balance",
          O.with_(O.BARS, O.features_ctes()) +
          "SELECT label, n, " + O.rnd("share") + " AS share FROM (SELECT label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM featured GROUP BY label)")
def _f04(spark, sf):
    from barlab.operators.labels import label_balance
    return label_balance(run_feature_engineering(T.bars(spark, sf), labels=FIXTURE_LABELS))
