"""Batch scoring and recommendations.

The reference scores one ticker per call; here every ticker is scored in one
job: the latest row per ticker is a ``max_by`` aggregate (partial
aggregation, no per-ticker task), checks become a ``reason`` column instead
of exceptions, and each model's predictions are a union of small tables.
"""

from __future__ import annotations

import logging

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barlab.operators import clean
from barlab.operators.asof import attach_quarterly
from barlab.operators.indicators import compute_features, run_feature_engineering
from barlab.operators.models import FEATURE_COLS, assemble
from barlab.operators.series import NTOT, RN, SKEY, number_rows
from barlab.session import cut_lineage
from barlab.params import MIN_HISTORY_BARS, SCORING_LOOKBACK_BARS, FeatureParams, LabelParams, SeriesLayout

log = logging.getLogger("barlab.score")
WARMUP_CHECK = ("MA21", "RSI_14", "MACD_signal", "BB_width")


def latest_rows(df: DataFrame, key: str = "ticker", order: str = "bar_date") -> DataFrame:
    """The row with the latest ``order`` value per key."""
    cols = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*cols), F.col(order)).alias("_r"))
    return last.select(key, *[F.col("_r")[c].alias(c) for c in cols])


def recommend(model, latest: DataFrame, model_name: str, cols=FEATURE_COLS) -> DataFrame:
    """BUY if the predicted class is 1, confidence = max class probability."""
    pred = model.transform(assemble(latest, cols))
    prob = vector_to_array("probability")
    return pred.select(
        "ticker", F.lit(model_name).alias("model"),
        F.when(F.col("prediction") == 1, "BUY").otherwise("SELL").alias("signal"),
        F.array_max(prob).alias("confidence"),
    )


def recommend_all(models: dict, latest: DataFrame, cols=FEATURE_COLS) -> DataFrame:
    """J2 + J7: one row per (ticker, model); a model that fails on any row yields
    ERROR rows with confidence 0.0 and its error text, and the others stand.

    Each model's result is stored before the union, so a failure shows where it
    can be told from the others."""
    spark = latest.sparkSession
    parts = []
    for name, model in models.items():
        try:
            part = cut_lineage(recommend(model, latest, name, cols).withColumn("error", F.lit(None).cast("string")))
        except Exception as e:
            log.warning("no signals from %s: %s", name, e)
            part = latest.select("ticker", F.lit(name).alias("model"), F.lit("ERROR").alias("signal"),
                                 F.lit(0.0).alias("confidence"), F.lit((str(e).splitlines() or [""])[0]).alias("error"))
        parts.append(part)
    if not parts:
        return spark.createDataFrame([], "ticker string, model string, signal string, confidence double, error string")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def recommend_latest(models: dict, bars: DataFrame, labels: LabelParams = LabelParams(), parity: bool = False,
                     fp: FeatureParams = FeatureParams(), layout: SeriesLayout = SeriesLayout(), cols=FEATURE_COLS) -> DataFrame:
    """J2 from bars: each ticker's newest bar. With ``parity`` the newest bar of the labelled table instead, which
    lacks the last ``labels.horizon`` bars of a ticker and those in the neutral zone."""
    table = run_feature_engineering(bars, fp, labels, layout) if parity else compute_features(bars, fp, layout)
    latest = cut_lineage(latest_rows(table))
    recs = recommend_all(models, latest, cols)
    return recs.join(latest.select("ticker", "bar_date"), "ticker")


def recommendations_wide(recs: DataFrame, model_names: list[str]) -> DataFrame:
    """One row per ticker, ``<model> Signal`` and ``<model> Confidence`` (3 decimals)."""
    piv = recs.groupBy("ticker").pivot("model", model_names).agg(
        F.first("signal").alias("Signal"), F.round(F.first("confidence"), 3).alias("Confidence"))
    renamed = piv
    for m in model_names:
        renamed = renamed.withColumnRenamed(f"{m}_Signal", f"{m} Signal").withColumnRenamed(
            f"{m}_Confidence", f"{m} Confidence")
    return renamed.orderBy("ticker")


def history_check(bars: DataFrame, min_bars: int = MIN_HISTORY_BARS, key: str = "ticker") -> DataFrame:
    """(ticker, history_days, reason); reason is set when there are too few bars."""
    counts = bars.groupBy(key).agg(F.count(F.lit(1)).alias("history_days"))
    reason = F.when(F.col("history_days") < min_bars, F.format_string(
        "history of %d bars is below the minimum of %d", F.col("history_days"), F.lit(min_bars)))
    return counts.withColumn("reason", reason)


def warmup_check(latest: DataFrame, cols=WARMUP_CHECK) -> DataFrame:
    """Reason when the latest row still has a NULL warm-up indicator."""
    bad = None
    for c in cols:
        bad = F.col(c).isNull() if bad is None else bad | F.col(c).isNull()
    return latest.withColumn("reason", F.when(bad, F.lit("an indicator has no value yet on the latest bar")))


def last_n_bars(bars: DataFrame, n: int = SCORING_LOOKBACK_BARS, key: str = "ticker", order: str = "bar_date") -> DataFrame:
    """The newest ``n`` bars of each ticker (row numbers from per-segment counts)."""
    nb = number_rows(bars, [key], order)
    return nb.filter(F.col(RN) >= F.col(NTOT) - n).drop(RN, NTOT, SKEY)


def score_tickers(bars: DataFrame, fund: DataFrame, history: DataFrame | None, ratio_params: DataFrame,
                  models: dict, fp: FeatureParams = FeatureParams(), layout: SeriesLayout = SeriesLayout(),
                  lookback: int = SCORING_LOOKBACK_BARS, min_bars: int = MIN_HISTORY_BARS) -> DataFrame:
    """Score a set of tickers end to end.

    Newest ``lookback`` bars -> snapshot join -> quarterly as of each bar ->
    saved ratio scaling (transform only) -> indicators -> latest row ->
    checks -> predict with every model. Rejected tickers get a reason and no
    prediction; a failed model gets its error; tree models get a narrative.
    Output: ticker, history_days, as_of_date, model, signal, confidence, reason,
    error, narrative.
    """
    # bars are numbered by their counts, and the newest are checked and scored: either is made once
    recent = cut_lineage(last_n_bars(cut_lineage(bars), lookback))
    hist = history_check(recent, min_bars)
    df = clean.join_snapshot(recent, fund)
    df = attach_quarterly(df, history)
    df = clean.apply_saved_scaler(df, ratio_params)
    feats = compute_features(df, fp, layout)
    latest = warmup_check(latest_rows(feats))
    latest = latest.join(hist.select("ticker", "history_days", F.col("reason").alias("_hreason")), "ticker", "left")
    latest = cut_lineage(latest.withColumn("reason", F.coalesce("_hreason", "reason")).drop("_hreason"))
    ok = latest.filter(F.col("reason").isNull())
    rejected = latest.filter(F.col("reason").isNotNull()).select(
        "ticker", "history_days", F.col("bar_date").alias("as_of_date"), F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("string").alias("signal"), F.lit(None).cast("double").alias("confidence"), "reason",
        F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("narrative"))
    recs = recommend_all(models, ok)
    scored = recs.join(ok.select("ticker", "history_days", F.col("bar_date").alias("as_of_date")), "ticker")
    scored = scored.join(narratives(models, ok, recs), ["ticker", "model"], "left").select(
        "ticker", "history_days", "as_of_date", "model", "signal", "confidence", F.lit(None).cast("string").alias("reason"),
        "error", "narrative")
    return scored.unionByName(rejected)


def narratives(models: dict, latest: DataFrame, recs: DataFrame, cols=FEATURE_COLS, top_n: int = 5) -> DataFrame:
    """ticker, model, narrative of the models that trees explain."""
    from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel

    from barlab.operators import explain
    from barlab.operators.trees import TreeModel

    out = latest.sparkSession.createDataFrame([], "ticker string, model string, narrative string")
    cols = [c for c in cols if c in latest.columns]
    for name, model in models.items():
        if isinstance(model, (TreeModel, GBTClassificationModel, RandomForestClassificationModel)):
            table = explain.explanation_table(explain.explain_rows(latest, model, cols), cols, top_n)
            signals = recs.filter(F.col("model") == name).join(latest.select("ticker", "bar_date"), "ticker")
            told = explain.narrative(table, signals.filter(F.col("signal") != "ERROR"))
            out = out.unionByName(told.select("ticker", F.lit(name).alias("model"), "narrative"))
    return out
