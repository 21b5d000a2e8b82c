"""Training run log as a table.

A run is one row: run_id, run_name, start and end time, status, params map,
metrics map, tags map, model name and its registry stage. The log is append-only parquet; the queries are
aggregates (``max_by`` per group, partial aggregation) or top-k reads.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlab.operators.series import number_rows

INTERNAL_TAG_PREFIX = "mlflow."
METRICS = ("accuracy", "precision", "recall", "f1_score")

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("run_name", T.StringType(), True),
    T.StructField("start_time", T.TimestampType(), True),
    T.StructField("model_name", T.StringType(), True),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("end_time", T.TimestampType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("stage", T.StringType(), True),
])
NAME_CHARS = 8


def now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def shown_name():
    """A run's name, else the beginning of its id."""
    return F.coalesce("run_name", F.substring(F.col("run_id").cast("string"), 1, NAME_CHARS))


def _if_there(runs: DataFrame, *cols: str) -> list[str]:
    return [c for c in cols if c in runs.columns]


def append_run(spark: SparkSession, path: str, run_id: str, run_name: str, params: dict, metrics: dict,
               model_name: str | None = None, tags: dict | None = None, start_time=None, end_time=None,
               status: str = "FINISHED", stage: str = "None") -> None:
    """Append one run row to the log."""
    row = (run_id, run_name, start_time or now(), model_name,
           {k: str(v) for k, v in params.items()}, {k: float(v) for k, v in metrics.items()},
           {k: str(v) for k, v in (tags or {}).items()}, end_time or now(), status, stage)
    spark.createDataFrame([row], RUN_SCHEMA).write.mode("append").parquet(path)


def recent_runs(runs: DataFrame, n: int = 20, metrics=METRICS) -> DataFrame:
    """Newest ``n`` runs with metric columns flattened out of the map."""
    cols = [F.col("metrics")[m].alias(m) for m in metrics] if "metrics" in runs.columns else \
        [F.col(m) for m in metrics if m in runs.columns]
    return runs.orderBy(F.col("start_time").desc(), F.col("run_id").desc()).limit(n).select(
        shown_name().alias("run_name"), "run_id", *_if_there(runs, "status"), "start_time", *cols)


def run_detail(runs: DataFrame, run_id) -> DataFrame:
    """Name, status, times, params, metrics and tags of one run; internal tags removed."""
    one = runs.filter(F.col("run_id") == run_id)
    return one.select("run_id", shown_name().alias("run_name"), *_if_there(runs, "status"), "start_time",
                      *_if_there(runs, "end_time"), "params", "metrics",
                      F.map_filter("tags", lambda k, v: ~k.startswith(INTERNAL_TAG_PREFIX)).alias("tags"))


def latest_per_name(runs: DataFrame, name: str = "run_name") -> DataFrame:
    """Newest run of each name (one struct per group; partial aggregation)."""
    cols = [c for c in runs.columns if c != name]
    latest = runs.groupBy(name).agg(F.max_by(F.struct(*cols), F.struct("start_time", "run_id")).alias("_r"))
    return latest.select(name, *[F.col("_r")[c].alias(c) for c in cols])


def metrics_long(runs: DataFrame, metrics=METRICS, name: str = "run_name") -> DataFrame:
    """Wide metric columns to (name, metric, value)."""
    present = [m for m in metrics if m in runs.columns]
    return runs.unpivot([name], present, "metric", "value")


def model_versions(runs: DataFrame, model: str = "model_name") -> DataFrame:
    """version = order of registration per model (integer), sorted model asc,
    version desc. Numbered with per-(model, day) counts, no per-model sort task."""
    more = _if_there(runs, "stage", "status")
    reg = runs.filter(F.col(model).isNotNull()).select(model, "run_id", "start_time", *more)
    numbered = number_rows(reg, [model], ["start_time", "run_id"], segment="day")
    return numbered.select(model, (F.col("_rn") + 1).cast("int").alias("version"), *more, "run_id",
                           F.col("start_time").alias("created")).orderBy(model, F.col("version").desc())


def latest_versions(runs: DataFrame, model: str = "model_name") -> DataFrame:
    """Latest version per model."""
    reg = runs.filter(F.col(model).isNotNull())
    return reg.groupBy(model).agg(F.count(F.lit(1)).cast("int").alias("latest_version"),
                                  F.max_by("run_id", F.struct("start_time", "run_id")).alias("run_id"))


def newest_run_id(runs: DataFrame) -> DataFrame:
    """Run id with the latest start time."""
    return runs.agg(F.max_by("run_id", F.struct("start_time", "run_id")).alias("latest_run_id"))
