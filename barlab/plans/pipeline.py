"""Stage compositions: preprocessing (B18), features (F5), EDA (I11), full run.

Each stage is one lazy plan; ``run_pipeline`` writes parquet at the stage
ends so that lineage stays short and a lost executor only recomputes the
current stage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators import clean
from barlab.operators.asof import attach_quarterly
from barlab.operators.indicators import run_feature_engineering
from barlab.params import PipelineParams
from barlab.session import cut_lineage


@dataclass
class Preprocessed:
    table: DataFrame
    summary: DataFrame        # B9 on the merged table
    missing: DataFrame        # B10 on the merged table
    price_params: DataFrame   # B11 fit
    ratio_params: DataFrame   # B12 fit


def merge_inputs(prices: DataFrame, fund: DataFrame, history: DataFrame | None, strategy: str = "auto") -> DataFrame:
    """B1 + B2 + B4: snapshot on every bar, quarterly figures as of each bar."""
    df = clean.fix_dtypes(clean.join_snapshot(prices, fund))
    df = attach_quarterly(df, history, strategy=strategy)
    return df.withColumn("earnings_growth_streak", F.col("earnings_growth_streak").cast("double"))


def run_preprocessing(prices: DataFrame, fund: DataFrame, history: DataFrame | None,
                      params: PipelineParams = PipelineParams(), median_method: str = "distributed",
                      asof_strategy: str = "auto", materialize: bool = True) -> Preprocessed:
    """Merge -> describe / missing -> impute -> min-max prices -> standardise ratios -> ticker slot.

    The merged and the imputed tables are each read by several aggregations
    (summary, medians, scaler fits) and by the transform; with ``materialize``
    they are written once as reliable checkpoints in the shared folder, so
    every reader starts from stored rows instead of re-running the lineage.
    """
    merged = merge_inputs(prices, fund, history, asof_strategy)
    if materialize:
        merged = cut_lineage(merged)
    numeric = clean.numeric_columns(merged)
    summary = clean.describe(merged, numeric)
    missing = clean.missing_counts(merged)
    imputed = clean.impute(merged, numeric, method=median_method, block_rows=params.layout.block_rows)
    if materialize:
        imputed = cut_lineage(imputed)
    price_params = clean.minmax_fit(imputed)
    ratio_params = clean.standard_fit(imputed)
    scaled = clean.standard_transform(clean.minmax_transform(imputed, price_params), ratio_params)
    table = clean.one_hot(scaled)
    return Preprocessed(table, summary, missing, price_params, ratio_params)


def run_pipeline(prices: DataFrame, fund: DataFrame, history: DataFrame | None, out_dir: str,
                 params: PipelineParams = PipelineParams(), train: bool = True, **training) -> dict[str, str]:
    """The daily run on ingested tables: preprocess, features, EDA, training.

    Every stage is written as a parquet table below ``out_dir`` and read from
    there by the next: ``processed``, ``featured`` (partitioned by nothing: the
    per-ticker order is restored by the readers' windows), the scaler
    parameters, one table per exploratory result under ``eda``, the models and
    the run log. ``training`` goes to ``models.train_and_log`` (tuned unless it
    says otherwise); returns the paths.
    """
    from barlab.operators.labels import time_ordered_split
    from barlab.operators.models import train_and_log

    spark = prices.sparkSession
    pre = run_preprocessing(prices, fund, history, params)
    paths = {k: f"{out_dir.rstrip('/')}/{k}" for k in ("processed", "featured", "price_params", "ratio_params")}
    pre.price_params.write.mode("overwrite").parquet(paths["price_params"])
    pre.ratio_params.write.mode("overwrite").parquet(paths["ratio_params"])
    pre.table.write.mode("overwrite").parquet(paths["processed"])
    processed = spark.read.parquet(paths["processed"])
    featured = run_feature_engineering(processed, params.features, params.labels, params.layout)
    featured.write.mode("overwrite").parquet(paths["featured"])
    featured = spark.read.parquet(paths["featured"])
    for name, table in run_eda(featured).items():
        paths[f"eda/{name}"] = f"{out_dir.rstrip('/')}/eda/{name}"
        table.write.mode("overwrite").parquet(paths[f"eda/{name}"])
    if train:
        paths |= {"models": f"{out_dir.rstrip('/')}/models", "runs": f"{out_dir.rstrip('/')}/runs"}
        train_and_log(*time_ordered_split(featured, 0.70), log_path=paths["runs"], model_dir=paths["models"], **training)
    return paths


def run_eda(ctx: DataFrame, corr_cols: list[str] | None = None, label: str = "label") -> dict[str, DataFrame]:
    """Every exploratory table (I1-I10) of a featured table that carries
    ``vix`` and ``pe_ratio``; each value is a lazy DataFrame (write or show)."""
    from barlab.operators import eda

    zoned = ctx.withColumn("RSI_zone", eda.rsi_zone())
    out = {
        "correlation_matrix": eda.correlation_long(ctx, corr_cols),
        "label_correlations": eda.label_correlations(ctx, label, [c for c in (corr_cols or eda.numeric_feature_columns(ctx)) if c != label]),
        "rsi_zone_counts": eda.value_counts(zoned.filter(F.col("RSI_zone").isNotNull()), "RSI_zone"),
        "return_histogram": eda.histogram(ctx, "daily_return", 50, by="ticker"),
        "rsi_histogram": eda.histogram(ctx, "RSI_14", 40),
        "macd_box_stats": eda.box_stats(ctx, "MACD_hist", label),
        "pe_return_points": eda.scatter_points(ctx),
    }
    if "pe_ratio" in ctx.columns:
        out["pe_zones"] = eda.pe_terciles(ctx.select("ticker", "bar_date", "pe_ratio"))
    if "vix" in ctx.columns:
        out["sell_rate_by_vix"] = eda.sell_rate_by_quantile(ctx, "vix", 5, label)
    return out
