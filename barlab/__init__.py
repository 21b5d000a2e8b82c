"""barlab: market-bar analytics as Spark DataFrame operators.

Bars are built from trade rows, cleaned, joined point-in-time to company
data, turned into indicators, candlestick flags and forward labels, and then
into statistics, model jobs, recommendations, explanations and projections.

Every per-series computation runs over a *blocked* layout (see
``operators.series``): rows of one key are cut into fixed-size blocks that
carry a halo of neighbouring rows, so one very long series spreads over many
tasks instead of landing in one.
"""

from barlab.params import FeatureParams, LabelParams, SeriesLayout

__all__ = ["FeatureParams", "LabelParams", "SeriesLayout"]
