"""Classification metrics from (label, prediction) columns.

One aggregation pass computes the four confusion cells; everything else is
arithmetic on that one row. Class 1 is the positive class; a metric with a
zero denominator is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.functions.columns import tdiv


def confusion_cells(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def _z(c):
    return F.coalesce(c, F.lit(0.0))


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 (one row)."""
    c = confusion_cells(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(
        tdiv(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _z(tdiv(tp, tp + fp)).alias("precision"),
        _z(tdiv(tp, tp + fn)).alias("recall"),
        _z(tdiv(2 * tp, 2 * tp + fp + fn)).alias("f1_score"),
    )


def confusion_matrix(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Counts by (label, prediction); all four cells present, missing ones 0."""
    c = confusion_cells(df, label, pred)
    cells = F.array(*[F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("n"))
                      for y, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))])
    return c.select(F.explode(cells).alias("s")).select("s.*")


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / F1 / support, then macro and weighted averages."""
    c = confusion_cells(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _z(tdiv(tp, tp + fp)), _z(tdiv(tp, tp + fn))
    p0, r0 = _z(tdiv(tn, tn + fn)), _z(tdiv(tn, tn + fp))
    f1_1 = _z(tdiv(2 * tp, 2 * tp + fp + fn))
    f1_0 = _z(tdiv(2 * tn, 2 * tn + fn + fp))
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    rows = F.array(
        F.struct(F.lit("0").alias("class"), p0.alias("precision"), r0.alias("recall"), f1_0.alias("f1"), s0.alias("support")),
        F.struct(F.lit("1").alias("class"), p1.alias("precision"), r1.alias("recall"), f1_1.alias("f1"), s1.alias("support")),
        F.struct(F.lit("macro avg").alias("class"), ((p0 + p1) / 2).alias("precision"), ((r0 + r1) / 2).alias("recall"),
                 ((f1_0 + f1_1) / 2).alias("f1"), n.alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), _z(tdiv(p0 * s0 + p1 * s1, n)).alias("precision"),
                 _z(tdiv(r0 * s0 + r1 * s1, n)).alias("recall"), _z(tdiv(f1_0 * s0 + f1_1 * s1, n)).alias("f1"),
                 n.alias("support")),
    )
    return c.select(F.explode(rows).alias("s")).select("s.*")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (2 n_c) per class, as (label, weight)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    return counts.select(label, (F.sum("n_c").over(Window.partitionBy())
                                 / (2 * F.col("n_c"))).alias("weight"))


def positive_weight(df: DataFrame, label: str = "label") -> DataFrame:
    """n0 / max(n1, 1), the weight of class 1 (class 0 weighs 1)."""
    return df.agg((F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).alias("pos_weight"))
