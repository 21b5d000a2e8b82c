"""Parameters passed to the operators (one frozen dataclass per concern)."""

from __future__ import annotations

from dataclasses import dataclass, field


# --- fixed values that must equal the reference for identical results ------
# Indicator windows: MA 7 / 21, RSI 14, MACD 12 / 26 / 9, Bollinger 20 x 2,
# stochastic 14 smoothed 3, ATR 14, ADX 14, OBV rate of change over 5 rows,
# lags 1, 2, 3. Labels: horizon 5 rows, neutral zone 1 %. Quarterly history:
# 8 quarters, reporting lag 45 days. Train share 0.70.
# Confidence bucket edges 0.0, 0.05, 0.10, 0.15, 0.20, 0.30, 1.0 and
# thresholds 0.50, 0.55, 0.60, 0.65, 0.70. Minimum history 60 bars.
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class FeatureParams:
    ma_short: int = 7
    ma_long: int = 21
    rsi: int = 14
    macd_fast: int = 12
    macd_slow: int = 26
    macd_signal: int = 9
    bb_window: int = 20
    bb_std: float = 2.0
    stoch_window: int = 14
    stoch_smooth: int = 3
    atr: int = 14
    adx: int = 14
    obv_window: int = 5
    trend_window: int = 5
    lags: tuple[int, ...] = (1, 2, 3)

    def bounded_lookback(self) -> int:
        """Rows of history a bounded-window feature at row t may read."""
        return max(
            self.ma_long,
            self.bb_window,
            self.rsi + 1 + max(self.lags),
            self.stoch_window + self.stoch_smooth - 1,
            self.atr + 1,
            self.obv_window + 1,
            self.trend_window + 1,
            3,
        )


@dataclass(frozen=True)
class LabelParams:
    horizon: int = 5
    neutral_zone_pct: float = 0.01

    def __post_init__(self):
        if self.horizon < 1:
            raise ValueError("horizon must be >= 1")


@dataclass(frozen=True)
class SeriesLayout:
    """How one ordered series per key is cut into blocks.

    ``block_rows`` rows per block; ``back`` / ``ahead`` halo rows copied from
    the neighbouring blocks (``None`` = derive from the operators that run);
    ``segment`` is the time unit used to number rows without a key-wide sort.
    """

    key: tuple[str, ...] = ("ticker",)
    order: str = "bar_date"
    block_rows: int = 16384
    back: int | None = None
    ahead: int | None = None
    segment: str = "year"


@dataclass(frozen=True)
class QuarterlyParams:
    lookback: int = 8
    report_lag_days: int = 45


@dataclass(frozen=True)
class SplitParams:
    train_ratio: float = 0.70
    n_folds: int = 5


CONFIDENCE_EDGES = (0.0, 0.05, 0.10, 0.15, 0.20, 0.30, 1.0)
THRESHOLDS = (0.50, 0.55, 0.60, 0.65, 0.70)
MIN_HISTORY_BARS = 60
SCORING_LOOKBACK_BARS = 150


@dataclass(frozen=True)
class PipelineParams:
    features: FeatureParams = field(default_factory=FeatureParams)
    labels: LabelParams = field(default_factory=LabelParams)
    layout: SeriesLayout = field(default_factory=SeriesLayout)
    quarterly: QuarterlyParams = field(default_factory=QuarterlyParams)
    split: SplitParams = field(default_factory=SplitParams)
