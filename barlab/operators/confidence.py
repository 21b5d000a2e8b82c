"""Does accuracy rise with confidence? (H1-H4)

Input: rows with the class-1 probability ``p`` and the true ``label``.
Everything is one pass of conditional aggregates over the scored rows; the
bucket edges and thresholds are a handful of literals, so no join is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.params import CONFIDENCE_EDGES, THRESHOLDS


def round_half_away(x: Column, digits: int) -> Column:
    """``round(x * 10^d) / 10^d`` on the double (ties away from zero)."""
    m = float(10 ** digits)
    return F.round(x * F.lit(m)) / F.lit(m)


def with_confidence(scored: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    """H1: prediction = p >= 0.5; confidence = 2 |p - 0.5|; correct flag."""
    pred = (F.col(p) >= 0.5).cast("int")
    return scored.withColumns({
        "prediction": pred,
        "confidence": F.abs(F.col(p) - 0.5) * 2,
        "correct": (pred == F.col(label)).cast("int"),
    })


def confidence_buckets(scored: DataFrame, edges=CONFIDENCE_EDGES, p: str = "p", label: str = "label") -> DataFrame:
    """H2: accuracy and coverage per half-open bucket [lo, hi); confidence 1.0
    falls in no bucket; empty buckets are omitted."""
    s = with_confidence(scored, p, label)
    conf = F.col("confidence")
    bucket = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        bucket = F.when((conf >= edges[i]) & (conf < edges[i + 1]), F.lit(i)).otherwise(bucket)
    names = F.array(*[F.lit(f"{lo:.2f}-{hi:.2f}") for lo, hi in zip(edges[:-1], edges[1:])])
    grouped = s.withColumn("_b", bucket).groupBy("_b").agg(
        F.count(F.lit(1)).alias("n_predictions"), F.avg("correct").alias("_acc"))
    total = F.sum("n_predictions").over(Window.partitionBy())
    out = grouped.withColumn("_total", total).filter(F.col("_b").isNotNull())
    return out.select(
        F.element_at(names, F.col("_b") + 1).alias("confidence_range"),
        "n_predictions",
        round_half_away(100 * F.col("n_predictions") / F.col("_total"), 1).alias("coverage_pct"),
        round_half_away(F.col("_acc"), 4).alias("accuracy"),
    )


def threshold_sweep(scored: DataFrame, thresholds=THRESHOLDS, p: str = "p", label: str = "label") -> DataFrame:
    """H3: act only if p >= t or p <= 1 - t; coverage and accuracy on the acted rows."""
    s = with_confidence(scored, p, label)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, t in enumerate(thresholds):
        acted = (F.col(p) >= t) | (F.col(p) <= (1 - t))
        aggs += [F.count_if(acted).alias(f"_a{i}"), F.count_if(acted & (F.col("correct") == 1)).alias(f"_c{i}")]
    wide = s.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_a{i}").alias("n_acted"),
                              F.col(f"_c{i}").alias("_c")) for i, t in enumerate(thresholds)])
    long = wide.select("_n", F.explode(rows).alias("s")).select("_n", "s.*")
    return long.select(
        "threshold", "n_acted",
        F.when(F.col("n_acted") == 0, F.lit(0.0)).otherwise(round_half_away(100 * F.col("n_acted") / F.col("_n"), 1)).alias("coverage_pct"),
        F.when(F.col("n_acted") > 0, round_half_away(F.col("_c") / F.col("n_acted"), 4)).alias("accuracy_on_acted"),
    )


def overall_accuracy(scored: DataFrame, p: str = "p", label: str = "label") -> DataFrame:
    return with_confidence(scored, p, label).agg(F.avg("correct").alias("accuracy"))


def model_report(scored: DataFrame, model: str, p: str = "p", label: str = "label") -> dict[str, DataFrame]:
    """H4: overall accuracy, buckets and threshold sweep for one model's scores."""
    tag = F.lit(model).alias("model")
    return {
        "overall": overall_accuracy(scored, p, label).select(tag, "*"),
        "buckets": confidence_buckets(scored, p=p, label=label).select(tag, "*"),
        "thresholds": threshold_sweep(scored, p=p, label=label).select(tag, "*"),
    }
