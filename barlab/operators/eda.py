"""Exploratory statistics as tables.

Figures in the reference are drawn from these tables; here the tables are
the output. Statistics are aggregates (partial aggregation before any
shuffle); the only row ordering needed (I4 ranks) is a range-partitioned
sort with per-partition offsets, never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.functions.columns import tdiv
from barlab.session import cut_lineage



def numeric_feature_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns, booleans excluded (pandas ``select_dtypes('number')``)."""
    num = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, num) and f.name not in exclude]


def _pair_aggs(a: str, b: str):
    x, y = F.col(a).cast("double"), F.col(b).cast("double")
    both = x.isNotNull() & y.isNotNull()
    cov = F.covar_samp(x, y)
    sx = F.stddev_samp(F.when(both, x))
    sy = F.stddev_samp(F.when(both, y))
    return tdiv(cov, sx * sy)


def correlation_long(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r for every column pair (a before b in column order) over the
    rows where both are present; a constant column gives NULL.

    The table is read once. Each task keeps a mergeable state per pair: rows, both
    means, and the centred moments around them, joined batch by batch by the
    parallel update; a task hands on k^2 rows. Their moments are moved to the
    means over all tasks and added up. State and output are bounded by k^2.
    """
    cols = cols if cols is not None else numeric_feature_columns(df)
    k = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"_c{i}") for i, c in enumerate(cols)])
    schema = "i int, j int, n double, mx double, my double, cxx double, cyy double, cxy double, xlo double, xhi double, ylo double, yhi double"

    def moments(batches):
        import numpy as np
        import pandas as pd

        def state(v):
            """Of one batch, for every ordered pair: rows, mean of the first, its moment, and the co-moment."""
            m = ~np.isnan(v)
            mf = m.astype(float)
            shift = np.where(m.any(axis=0), np.where(m, v, 0.0).sum(axis=0) / np.maximum(mf.sum(axis=0), 1), 0.0)
            z = np.where(m, v - shift, 0.0)
            n = mf.T @ mf
            d = (z.T @ mf) / np.maximum(n, 1)
            lo, hi = (f(np.where(m, v, e), axis=0, initial=e) for f, e in ((np.min, np.inf), (np.max, -np.inf)))
            return n, d + shift[:, None], (z * z).T @ mf - n * d * d, z.T @ z - n * d * d.T, lo, hi

        def merged(a, b):
            n = a[0] + b[0]
            step = b[1] - a[1]
            both = a[0] * b[0] / np.maximum(n, 1)
            return (n, a[1] + step * b[0] / np.maximum(n, 1), a[2] + b[2] + step * step * both, a[3] + b[3] + step * step.T * both,
                    np.minimum(a[4], b[4]), np.maximum(a[5], b[5]))

        acc = None
        for pdf in batches:
            part = state(pdf.to_numpy(dtype=float))
            acc = part if acc is None else merged(acc, part)
        if acc is None:
            return
        n, mean, var, co, lo, hi = acc
        i, j = np.triu_indices(k, 1)
        yield pd.DataFrame({"i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "mx": mean[i, j], "my": mean[j, i], "cxx": var[i, j],
                            "cyy": var[j, i], "cxy": co[i, j], "xlo": lo[i], "xhi": hi[i], "ylo": lo[j], "yhi": hi[j]})

    parts = cut_lineage(x.mapInPandas(moments, schema))
    n = F.sum("n")
    means = parts.groupBy("i", "j").agg(tdiv(F.sum(F.col("n") * F.col("mx")), n).alias("ax"), tdiv(F.sum(F.col("n") * F.col("my")), n).alias("ay"))
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    tot = parts.join(means, ["i", "j"]).groupBy("i", "j").agg(
        n.alias("n"), F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("vx"), F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("vy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("cov"), F.min("xlo").alias("xlo"), F.max("xhi").alias("xhi"),
        F.min("ylo").alias("ylo"), F.max("yhi").alias("yhi"))
    # a column with one distinct value has no correlation (centring may leave a residue)
    flat = (F.col("xlo") >= F.col("xhi")) | (F.col("ylo") >= F.col("yhi"))
    r = F.when((F.col("n") > 1) & (F.col("vx") > 0) & (F.col("vy") > 0) & ~flat, F.col("cov") / F.sqrt(F.col("vx") * F.col("vy")))
    names = F.array(*[F.lit(c) for c in cols])
    return tot.select(F.element_at(names, F.col("i") + 1).alias("a"), F.element_at(names, F.col("j") + 1).alias("b"),
                      r.alias("r"))


def label_correlations(df: DataFrame, label: str = "label", cols: list[str] | None = None) -> DataFrame:
    """Correlation of each numeric column with the label, largest |r| first."""
    cols = cols if cols is not None else [c for c in numeric_feature_columns(df) if c != label]
    wide = df.agg(*[_pair_aggs(c, label).alias(f"_r{j}") for j, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"_r{j}").alias("r")) for j, c in enumerate(cols)])
    long = wide.select(F.explode(rows).alias("s")).select("s.*")
    return long.orderBy(F.abs("r").desc_nulls_last(), "feature")


def rsi_zone(col: str = "RSI_14"):
    """(-1, 30] Oversold, (30, 70] Neutral, (70, 101] Overbought, else NULL."""
    x = F.col(col)
    return (F.when((x > -1) & (x <= 30), "Oversold").when((x > 30) & (x <= 70), "Neutral")
            .when((x > 70) & (x <= 101), "Overbought"))


def global_rank(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """1-based position of each row in ``order`` (ties must be broken by ``order``).

    Rows are range-partitioned and sorted inside each partition; a row's rank is
    the rows in earlier partitions (a table of one count per partition) plus its
    position in its own partition. No single-task sort.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # materialised once (reliable checkpoint): partition ids must be the same for
    # the count table and the rows, whatever adaptive execution does to a re-run
    ranged = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    ranged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_mid", F.monotonically_increasing_id())
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
    offs = counts.select("_pid", F.coalesce(F.sum("_cnt").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return ranged.join(F.broadcast(offs), "_pid").withColumn("_rank", F.col("_off") + local + 1).drop("_pid", "_mid", "_off")


PE_LABELS = ("Value", "Growth", "Overvalued")


def pe_terciles(df: DataFrame, col: str = "pe_ratio", tiebreak=("ticker", "bar_date")) -> DataFrame:
    """I4: rank by value (ties by row order), three equal-frequency bins of the ranks."""
    valued = df.filter(F.col(col).isNotNull())
    ranked = global_rank(valued, [col, *tiebreak])
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    r = ranked.crossJoin(F.broadcast(n))
    k = F.col("_rank") - 1
    bin_ = F.when((k == 0) | (3 * k < F.col("_n") - 1), 0).when(3 * k < 2 * (F.col("_n") - 1), 1).otherwise(2)
    labels = F.array(*[F.lit(x) for x in PE_LABELS])
    zone = F.element_at(labels, bin_ + 1)
    nulls = df.filter(F.col(col).isNull()).withColumn("PE_zone", F.lit(None).cast("string"))
    return r.withColumn("PE_zone", zone).drop("_rank", "_n").unionByName(nulls)


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """I5 / F4 style counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def histogram(df: DataFrame, col: str, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width bins over the column's [min, max] (shared by all
    groups); the last bin is closed. Returns (by?, bin, lo, hi, n)."""
    x = F.col(col)
    rng = df.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    d = df.filter(x.isNotNull()).crossJoin(F.broadcast(rng))
    width = F.col("_hi") - F.col("_lo")
    idx = F.when(width == 0, 0).otherwise(F.floor((x - F.col("_lo")) * (F.lit(float(bins)) / width)))
    d = d.withColumn("bin", F.least(idx, F.lit(bins - 1)).cast("int"))
    keys = ([by] if by else []) + ["bin"]
    out = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
    step = (F.col("_hi") - F.col("_lo")) / bins
    return out.select(*keys, (F.col("_lo") + F.col("bin") * step).alias("lo"),
                      (F.col("_lo") + (F.col("bin") + 1) * step).alias("hi"), "n")


def box_stats(df: DataFrame, value: str = "MACD_hist", by: str = "label") -> DataFrame:
    """I8: quartiles, 1.5 IQR whiskers at data points, outlier count per group."""
    v = F.col(value)
    q = exact_quantiles(df.select(by, value), [value], [0.25, 0.5, 0.75], by=by)  # one row per group
    q = q.select(by, F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"))
    j = df.select(by, value).filter(v.isNotNull()).join(q, by)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    inside = (v >= lo_f) & (v <= hi_f)
    return j.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count_if(~inside).alias("n_outliers"), F.count(F.lit(1)).alias("n"))


def scatter_points(df: DataFrame, x: str = "pe_ratio", y: str = "daily_return", hue: str = "label",
                   ) -> DataFrame:
    """Scatter source, every row with both values."""
    return df.select("ticker", "bar_date", x, y, hue).filter(F.col(x).isNotNull() & F.col(y).isNotNull())


def sell_rate_by_quantile(df: DataFrame, col: str = "vix", q: int = 5, label: str = "label") -> DataFrame:
    """Interpolated quantile edges, right-closed bins (first includes its low
    edge), share of label 0 per bin. Duplicate edges raise, as the reference does."""
    probs = [i / q for i in range(q + 1)]
    found = exact_quantiles(df, [col], probs).collect()  # q + 1 numbers
    e = found[0]["q"] if found else None
    if e is None:
        raise ValueError(f"no values in {col}")
    if len(set(e)) < len(e):
        raise ValueError(f"Bin edges must be unique: {e}")
    x = F.col(col)
    b = F.lit(None).cast("int")
    for i in range(q - 1, -1, -1):
        lo_ok = (x >= e[i]) if i == 0 else (x > e[i])
        b = F.when(lo_ok & (x <= e[i + 1]), F.lit(i)).otherwise(b)
    d = df.withColumn("bin", b).filter(F.col("bin").isNotNull())
    lo = F.element_at(F.array(*[F.lit(float(v)) for v in e[:-1]]), F.col("bin") + 1)
    hi = F.element_at(F.array(*[F.lit(float(v)) for v in e[1:]]), F.col("bin") + 1)
    return d.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg((F.col(label) == 0).cast("double")).alias("sell_rate")) \
        .select("bin", lo.alias("lo"), hi.alias("hi"), "n", "sell_rate")


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: str | None = None) -> DataFrame:
    """Exact linearly interpolated quantiles (numpy / Spark ``percentile``
    semantics) without any unbounded aggregation buffer.

    The columns are unpivoted and counted by distinct value first (a partial
    aggregate), so a value shared by a third of the rows is one row from there on.
    The (column, value, count) rows are range partitioned; running counts inside
    a partition plus the totals of the partitions before it (a small table) give
    each value its ranks, and the values at the two ranks around ``p * (n - 1)``
    are read off. Output: one row per (group, column) with ``q`` = array of
    quantiles in ``probs`` order (NULL for a column with no values).
    """
    spark = df.sparkSession
    key = F.struct(F.col(by).alias("by")) if by else F.struct(F.lit(1).alias("by"))
    items = F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_v")) for c in cols])
    long = df.select(key.alias("_g"), F.explode(items).alias("_s")).select("_g", "_s._col", "_s._v").filter(F.col("_v").isNotNull())
    counts = long.groupBy("_g", "_col", "_v").agg(F.count(F.lit(1)).alias("_c"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # stored, so that partition ids are the same for the totals and the rows
    ranged = cut_lineage(counts.repartitionByRange(n, "_g", "_col", "_v").withColumn("_pid", F.spark_partition_id()))
    parts = ranged.groupBy("_g", "_col", "_pid").agg(F.sum("_c").alias("_part"))
    w = Window.partitionBy("_g", "_col")
    parts = parts.select("_g", "_col", "_pid", F.sum("_part").over(w).alias("_n"), F.coalesce(F.sum("_part").over(
        w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_g", "_col", "_pid").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = ranged.withColumn("_upto", F.sum("_c").over(inside)).join(parts, ["_g", "_col", "_pid"])
    last = F.col("_before") + F.col("_upto")
    place = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in place for f in (F.floor, F.ceil)]))
    hit = F.filter(ranks, lambda r: (r >= last - F.col("_c")) & (r < last))
    found = ranked.select("_g", "_col", "_n", "_v", F.explode(hit).alias("_r"))
    values = found.groupBy("_g", "_col", "_n").agg(F.map_from_entries(F.collect_list(F.struct("_r", "_v"))).alias("_m"))

    def at(x):
        lo, hi = F.element_at("_m", F.floor(x).cast("long")), F.element_at("_m", F.ceil(x).cast("long"))
        return lo + (x - F.floor(x)) * (hi - lo)

    q = values.select("_g", F.col("_col").alias("column"), F.array(*[at(x) for x in place]).alias("q"))
    if by:
        return q.select(F.col("_g.by").alias(by), "column", "q")
    every = spark.createDataFrame([(c,) for c in cols], "column string")
    return every.join(q.drop("_g"), "column", "left")
