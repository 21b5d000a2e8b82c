"""Stage sinks and relational source/sink.

Stage tables are parquet, replaced whole (overwrite). The relational side
uses JDBC when a URL is given (``spark.read/write.jdbc``); without one the
tables live in the session catalog, so the same SQL runs against them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.sources.bars import BAR_SCHEMA


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet") -> None:
    """A10: replace a whole stage table."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_stage_csv(spark: SparkSession, path: str, schema=BAR_SCHEMA) -> DataFrame:
    """CSV stage output with a header, read with a fixed schema (no inference)."""
    return spark.read.schema(schema).option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_table(df: DataFrame, name: str, url: str | None = None, properties: dict | None = None) -> None:
    """Replace one relational table (JDBC, else a session catalog table)."""
    if url:
        df.write.mode("overwrite").jdbc(url, name, properties=properties or {})
    else:
        df.write.mode("overwrite").saveAsTable(name)


def write_raw_tables(prices: DataFrame, fund: DataFrame, quarterly: DataFrame | None, url: str | None = None,
                     properties: dict | None = None, prefix: str = "") -> list[str]:
    """Prices and snapshot are always replaced; quarterly history only when it has rows."""
    written = []
    write_table(prices, f"{prefix}raw_prices", url, properties)
    written.append(f"{prefix}raw_prices")
    write_table(fund, f"{prefix}raw_fundamentals", url, properties)
    written.append(f"{prefix}raw_fundamentals")
    if quarterly is not None and not quarterly.isEmpty():
        write_table(quarterly, f"{prefix}raw_quarterly_fundamentals", url, properties)
        written.append(f"{prefix}raw_quarterly_fundamentals")
    return written


VERSIONS = "version string, path string, written_at timestamp"


def replace_table(df: DataFrame, root: str, name: str) -> str:
    """Replace a table whole. The rows go to a folder of their own; the table becomes them by one
    more row in its list of versions, which Spark's committer adds at once or not at all. A write
    that fails leaves the table as it was. Returns the version."""
    spark, version = df.sparkSession, uuid.uuid4().hex
    base = f"{root.rstrip('/')}/{name}"
    df.write.parquet(f"{base}/data/{version}")
    row = spark.createDataFrame([(version, f"data/{version}")], "version string, path string").withColumn("written_at", F.current_timestamp())
    row.coalesce(1).write.mode("append").parquet(f"{base}/versions")
    return version


def table_versions(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Every version written, the one that counts last."""
    return spark.read.schema(VERSIONS).parquet(f"{root.rstrip('/')}/{name}/versions").orderBy("written_at", "version")


def read_replaced(spark: SparkSession, root: str, name: str, version: str | None = None) -> DataFrame:
    """The newest version of a table, or the one named."""
    found = table_versions(spark, root, name)
    found = found.filter(F.col("version") == version) if version else found
    last = found.orderBy(F.desc("written_at"), F.desc("version")).first()
    if last is None:
        raise ValueError(f"no version {version} of {name}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{last['path']}")


def read_table(spark: SparkSession, name: str, url: str | None = None, properties: dict | None = None) -> DataFrame:
    """One relational table."""
    if url:
        return spark.read.jdbc(url, name, properties=properties or {})
    return spark.table(name)


def sql_source(spark: SparkSession, query: str, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL over the relational tables (registered as views when given as frames)."""
    for name, df in (tables or {}).items():
        df.createOrReplaceTempView(name)
    return spark.sql(query)
