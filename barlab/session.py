"""Spark session and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession


def get_spark(app: str = "barlab", master: str | None = None, shuffle_partitions: int = 8,
              warehouse_dir: str | None = None) -> SparkSession:
    """Session for tests and local runs. What the launcher sets (spark-submit,
    spark-defaults) stays; only settings that are absent get the defaults here."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.driver.memory": os.environ.get("BARLAB_DRIVER_MEMORY", "16g"),
    }
    if warehouse_dir:
        defaults["spark.sql.warehouse.dir"] = warehouse_dir
    given = SparkConf()  # reads the launcher's properties
    for name, value in defaults.items():
        if not given.contains(name):
            builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    When the setting is absent, a local session gets a fresh scratch folder; on a
    cluster a folder of one machine would lose rows, so that is an error.
    """
    conf = spark.sparkContext.getConf()
    path = conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith(("local[", "local-")) and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="barlab-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
