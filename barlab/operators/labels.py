"""Label statistics and time-ordered splits.

F1-F3 (forward close, 3-way label, tail / neutral drop) live in
``indicators.compute_features`` because they share its window pass.

Splits never sort all rows: they go through the per-date count table, which
is bounded by the calendar (one row per distinct date), and hand the cutoff
back as a one-row table that is broadcast (size bound: one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """normalised value counts."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def _date_counts(df: DataFrame, date: str) -> DataFrame:
    counts = df.groupBy(date).agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.orderBy(date)
    return counts.select(
        date, "_cnt",
        F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("_cum"),
        F.sum("_cnt").over(Window.partitionBy()).alias("_total"),
    )


def split_cutoff(df: DataFrame, ratio: float = 0.70, date: str = "bar_date") -> DataFrame:
    """One-row table: the date of row ``int(n * ratio)`` in date order."""
    dc = _date_counts(df, date)
    idx = F.floor(F.col("_total") * F.lit(ratio))
    # the row at 0-based position idx lies in the first date whose running count exceeds idx
    return dc.filter(F.col("_cum") > idx).agg(F.min(date).alias("cutoff"))


def time_ordered_split(df: DataFrame, ratio: float = 0.70, date: str = "bar_date",
                       purge_days: int = 0) -> tuple[DataFrame, DataFrame]:
    """F6 (+ F8 option): train = date < cutoff, test = date >= cutoff.

    ``purge_days`` > 0 also drops training rows dated within that many days
    before the cutoff (their forward labels look into the test period).
    """
    cut = F.broadcast(split_cutoff(df, ratio, date))
    tagged = df.crossJoin(cut)
    train_cond = F.col(date) < F.col("cutoff")
    if purge_days > 0:
        train_cond = train_cond & (F.col(date) < F.date_sub(F.col("cutoff"), purge_days))
    train = tagged.filter(train_cond).drop("cutoff")
    test = tagged.filter(F.col(date) >= F.col("cutoff")).drop("cutoff")
    return train, test


def split_summary(df: DataFrame, ratio: float = 0.70, date: str = "bar_date") -> DataFrame:
    """Cutoff date and the train / test row counts (one row)."""
    cut = F.broadcast(split_cutoff(df, ratio, date))
    return df.crossJoin(cut).agg(
        F.first("cutoff").alias("cutoff"),
        F.count(F.when(F.col(date) < F.col("cutoff"), 1)).alias("train_rows"),
        F.count(F.when(F.col(date) >= F.col("cutoff"), 1)).alias("test_rows"),
    )


def walk_forward_folds(train: DataFrame, n_folds: int = 5, date: str = "bar_date",
                       tiebreak: str = "ticker", align: str = "date") -> DataFrame:
    """expanding folds over date-ordered training rows.

    Test size is ``n // (n_folds + 1)``; fold i tests positions
    ``[start_i, start_i + size)`` with ``start_i = n - (n_folds - i) * size``
    and trains on positions before ``start_i``. Positions are
    ``rows before the date + rank by tiebreak within the date``.

    Returns the rows with ``_pos`` and ``fold`` (test fold id, NULL if in no
    test block). With ``align='date'`` a fold boundary moves to the start of
    the date it falls in, so one date is never split between train and test.
    """
    dc = _date_counts(train, date).select(date, (F.col("_cum") - F.col("_cnt")).alias("_before"), "_total")
    rows = train.join(dc, date)
    pos = F.col("_before") + F.row_number().over(Window.partitionBy(date).orderBy(tiebreak)) - 1
    rows = rows.withColumn("_pos", pos)
    size = F.floor(F.col("_total") / F.lit(n_folds + 1))
    first_start = F.col("_total") - F.lit(n_folds) * size
    anchor = F.col("_before") if align == "date" else F.col("_pos")
    fold = F.when(anchor >= first_start, F.least(F.floor((anchor - first_start) / size), F.lit(n_folds - 1)))
    return rows.withColumn("fold", fold.cast("int")).drop("_before", "_total")


def fold_summary(folded: DataFrame, n_folds: int = 5, date: str = "bar_date") -> DataFrame:
    """Per fold: train rows (positions before the fold), test rows, test date range."""
    per_fold = folded.filter(F.col("fold").isNotNull()).groupBy("fold").agg(
        F.count(F.lit(1)).alias("test_rows"), F.min("_pos").alias("test_start"),
        F.min(date).alias("test_first_date"), F.max(date).alias("test_last_date"))
    return per_fold.select("fold", F.col("test_start").alias("train_rows"), "test_rows",
                           "test_first_date", "test_last_date")
