"""Cleaning, joins and scaling.

Scalers are fitted with one aggregation over the whole table and applied
through a one-row parameter table (size bound: one row per scaled column,
broadcast). Persisted parameters are a parquet table (column, kind, a, b).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.functions.columns import inf_to_null
from barlab.operators.scan import prefix_last

log = logging.getLogger("barlab.clean")

PRICE_COLS = ("open", "high", "low", "close", "volume")
RATIO_COLS = ("pe_ratio", "debt_to_equity", "current_ratio",
              "revenue_yoy_growth", "net_income_yoy_growth",
              "revenue_qoq_growth", "net_income_qoq_growth", "earnings_growth_streak")
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def join_snapshot(prices: DataFrame, fund: DataFrame) -> DataFrame:
    """B1: left equi-join of the per-ticker snapshot onto every bar.

    The snapshot has one row per ticker; Spark's size estimate decides a
    broadcast (it does at any realistic ticker count)."""
    return prices.join(fund, "ticker", "left")


def fix_dtypes(df: DataFrame, date_col: str = "bar_date") -> DataFrame:
    """B2: date column as DATE, ticker as string."""
    out = df
    if date_col in df.columns:
        out = out.withColumn(date_col, F.to_date(F.col(date_col)))
    if "ticker" in df.columns:
        out = out.withColumn("ticker", F.col("ticker").cast("string"))
    return out


def ffill(df: DataFrame, cols: list[str], key="ticker", order="bar_date", block_rows: int = 16384) -> DataFrame:
    """Forward fill per key in order (blocked prefix scan, skew-safe)."""
    return prefix_last(df, key, order, cols, block_rows=block_rows)


def column_medians(df: DataFrame, cols: list[str], method: str = "distributed", accuracy: int = 100000) -> DataFrame:
    """One row with the median of each column (NULLs ignored; all-NULL -> NULL).

    ``distributed`` (default): exact interpolated median from a distributed
    rank (``eda.exact_quantiles``), no unbounded aggregation buffer.
    ``exact``: Spark ``percentile`` (its single final buffer holds one count
    per distinct value: only for tables of bounded distinct values).
    ``approx``: ``percentile_approx`` with rank error 1/``accuracy``; never
    chosen silently.
    """
    if method == "distributed":
        from barlab.operators.eda import exact_quantiles

        q = exact_quantiles(df, cols, [0.5])
        wide = q.groupBy().agg(*[F.max(F.when(F.col("column") == c, F.col("q")[0])).alias(c) for c in cols])
        return wide
    if method == "exact":
        aggs = [F.percentile(F.col(c).cast("double"), 0.5).alias(c) for c in cols]
    elif method == "approx":
        aggs = [F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols]
    else:
        raise ValueError(method)
    return df.agg(*aggs)


def fill_median(df: DataFrame, cols: list[str], method: str = "distributed") -> DataFrame:
    """Remaining NULLs -> global median of the column."""
    med = F.broadcast(column_medians(df, cols, method).select(*[F.col(c).alias(f"_med_{c}") for c in cols]))
    out = df.crossJoin(med)
    # like pandas, a filled column is floating point
    out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")) for c in cols})
    return out.drop(*[f"_med_{c}" for c in cols])


def impute(df: DataFrame, cols: list[str] | None = None, key="ticker", order="bar_date",
           method: str = "distributed", block_rows: int = 16384) -> DataFrame:
    """Forward fill per key, then the global median of what is left."""
    cols = cols if cols is not None else numeric_columns(df)
    return fill_median(ffill(df, cols, key, order, block_rows), cols, method)


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, std (ddof 1), min, quartiles, max per numeric column, long form.

    Moments are one aggregation; quartiles come from the distributed exact
    quantiles (no per-column buffer of all distinct values)."""
    from barlab.operators.eda import exact_quantiles

    cols = cols if cols is not None else numeric_columns(df)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"),
                     F.col(f"{c}__count").alias("count"), F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__std").alias("std"), F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    moments = wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75])
    out = moments.join(F.broadcast(q), "column", "left")  # one row per column
    return out.select("column", "count", "mean", "std", "min", F.col("q")[0].alias("q25"),
                      F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"), "max")


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]


def describe_dates(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, min, quartiles and max per date or timestamp column, as timestamps; dates have no std.

    They go through ``describe`` as days since 1970."""
    cols = cols if cols is not None else date_columns(df)
    names = {f"_d{i}": c for i, c in enumerate(cols)}
    days = df.select(*[(F.unix_micros(F.col(c).cast("timestamp")) / 86_400_000_000).alias(d) for d, c in names.items()])
    found = describe(days, list(names))
    back = F.element_at(F.create_map(*[F.lit(x) for d, c in names.items() for x in (d, c)]), F.col("column"))
    when = [F.timestamp_micros(F.rint(F.col(c) * 86_400_000_000).cast("long")).alias(c) for c in ("mean", "min", "q25", "q50", "q75", "max")]
    return found.select(back.alias("column"), "count", *when)


def missing_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NULL count per column, only columns with NULLs, most first."""
    cols = cols if cols is not None else df.columns
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = wide.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"))
                                           for c in cols])).alias("s")).select("s.*")
    return long.filter(F.col("missing") > 0).orderBy(F.col("missing").desc(), "column")


# ------------------------------------------------------------------ scalers
def minmax_fit(df: DataFrame, cols=PRICE_COLS) -> DataFrame:
    """B11 fit: params table (column, kind, a=min, b=range with 0 -> 1)."""
    cols = [c for c in cols if c in df.columns]
    wide = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in cols],
                  *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in cols])
    rows = [F.struct(F.lit(c).alias("column"), F.lit("minmax").alias("kind"), F.col(f"{c}__lo").alias("a"),
                     F.when((F.col(f"{c}__hi") - F.col(f"{c}__lo")) == 0, F.lit(1.0))
                     .otherwise(F.col(f"{c}__hi") - F.col(f"{c}__lo")).alias("b")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def standard_fit(df: DataFrame, cols=RATIO_COLS) -> DataFrame:
    """B12 fit: NULL -> 0 first; a = mean, b = population std with 0 -> 1."""
    cols = [c for c in cols if c in df.columns]
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols]
    wide = df.agg(*[F.avg(x).alias(f"{c}__m") for c, x in zip(cols, filled)],
                  *[F.stddev_pop(x).alias(f"{c}__s") for c, x in zip(cols, filled)])
    rows = [F.struct(F.lit(c).alias("column"), F.lit("standard").alias("kind"), F.col(f"{c}__m").alias("a"),
                     F.when(F.col(f"{c}__s") == 0, F.lit(1.0)).otherwise(F.col(f"{c}__s")).alias("b")) for c in cols]
    return wide.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def minmax_transform(df: DataFrame, params: DataFrame, cols=PRICE_COLS) -> DataFrame:
    """B11 transform: ``<c>_norm = (x - min) / range``; raw column kept."""
    cols = [c for c in cols if c in df.columns]
    one = F.broadcast(params.groupBy().agg(
        *[F.max(F.when(F.col("column") == c, F.struct("a", "b"))).alias(f"_p_{c}") for c in cols]))
    out = df.crossJoin(one)
    out = out.withColumns({f"{c}_norm": (F.col(c).cast("double") - F.col(f"_p_{c}")["a"]) / F.col(f"_p_{c}")["b"]
                           for c in cols})
    return out.drop(*[f"_p_{c}" for c in cols])


def standard_transform(df: DataFrame, params: DataFrame, cols=RATIO_COLS) -> DataFrame:
    """B12 transform: ``x = (coalesce(x, 0) - mean) / std`` in place."""
    cols = [c for c in cols if c in df.columns]
    one = F.broadcast(params.groupBy().agg(
        *[F.max(F.when(F.col("column") == c, F.struct("a", "b"))).alias(f"_p_{c}") for c in cols]))
    out = df.crossJoin(one)
    out = out.withColumns({c: (F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - F.col(f"_p_{c}")["a"])
                           / F.col(f"_p_{c}")["b"] for c in cols})
    return out.drop(*[f"_p_{c}" for c in cols])


def save_scaler(params: DataFrame, path: str) -> None:
    """Persist params (column, kind, a, b) as parquet."""
    params.coalesce(1).write.mode("overwrite").parquet(path)


class ScalersNotFoundError(RuntimeError):
    pass


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    """Load params; a clear error when none were saved."""
    try:
        return spark.read.parquet(path)
    except Exception as e:  # AnalysisException: path does not exist
        raise ScalersNotFoundError(
            f"No saved scaler parameters at {path}; run preprocessing once first.") from e


def apply_saved_scaler(df: DataFrame, params: DataFrame) -> DataFrame:
    """Transform-only with saved ratio params, for the columns they were
    fitted on; left alone (with a warning) when the frame lacks one of them."""
    fitted = [r["column"] for r in params.filter(F.col("kind") == "standard").select("column").orderBy("column").collect()]
    absent = [c for c in fitted if c not in df.columns]
    if absent:
        log.warning("ratios stay unscaled: the saved scaler also covers %s", absent)
        return df
    return standard_transform(df, params, fitted)


def one_hot_index(df: DataFrame, col: str = "ticker") -> DataFrame:
    """Position of the value among the sorted distinct values (the one-hot
    slot), NULL for NULL. ``one_hot`` turns it into a sparse vector with Spark ML.

    The values are numbered in one task, a row per distinct value."""
    found = df.select(col).distinct().filter(F.col(col).isNotNull())
    index = found.withColumn(f"{col}_index", (F.row_number().over(Window.orderBy(col)) - 1).cast("int"))
    return df.join(index, col, "left").select(*df.columns, f"{col}_index")


def one_hot(df: DataFrame, col: str = "ticker") -> DataFrame:
    """One slot per distinct value, none dropped, as a sparse vector column."""
    from pyspark.ml.feature import OneHotEncoder

    indexed = one_hot_index(df, col)
    known = indexed.filter(F.col(f"{col}_index").isNotNull())
    enc = OneHotEncoder(inputCols=[f"{col}_index"], outputCols=[f"{col}_onehot"], dropLast=False).fit(known)
    return enc.transform(known).unionByName(indexed.filter(F.col(f"{col}_index").isNull()), allowMissingColumns=True)


def sanitise(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """+/-inf and NaN -> NULL for foreign input."""
    cols = cols if cols is not None else [f.name for f in df.schema.fields
                                          if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: inf_to_null(c) for c in cols})


def fill_zero(df: DataFrame, cols: list[str]) -> DataFrame:
    """Feature NULL -> 0 before a model."""
    return df.na.fill(0, subset=list(cols))
