"""Stage tables of one query in the cluster's shared folder."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.session import ensure_checkpoint_dir


class Workspace:
    """A fresh folder below ``spark.checkpoint.dir`` for one query's stage tables.

    A stage table cuts lineage (lost executors never recompute what is behind
    it) and, being Parquet, gives the planner a true size: whether a join is
    broadcast is decided by ``spark.sql.autoBroadcastJoinThreshold`` on that
    size. Results are lazy and read these tables, so ``clear()`` belongs after
    the result is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/barlab-{name}-{uuid.uuid4().hex}"
        self._n = 0
        self._at: dict[int, str] = {}

    def stage(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write ``df`` and return it as read back."""
        self._n += 1
        path = f"{self.path}/{self._n:02d}-{name}"
        schema = df.schema
        df.write.parquet(path)
        out = self.spark.read.schema(schema).parquet(path)
        self._at[id(out)] = path
        return out

    def release(self, *tables: DataFrame) -> None:
        """Delete stage tables that nothing will read again, and let the context
        cleaner remove the shuffle files of the jobs behind them."""
        for t in tables:
            self._delete(self._at.pop(id(t)))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def clear(self) -> None:
        self._delete(self.path)

    def _delete(self, path: str) -> None:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a one-element transform binds it."""
    return F.transform(F.array(value), body)[0]


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes of a text with different seeds, to tell rows of null or equal id apart.

    The last bit of the second one says whether the id is null, so the number that
    stands for a null id where ids are compared may also be a real one.
    """
    t = F.coalesce(text, F.lit(""))
    return F.xxhash64(t), F.shiftleft(F.shiftright(F.xxhash64(F.lit(1), t), 1), 1).bitwiseOR(doc_id.isNull().cast("long"))


#: Keys that hold one row in this many of all; there can be no more such keys than that.
SHARE = 1 << 14


def join_by_share(rows: DataFrame, table: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``table``, which has every key once and its number of rows as ``weight``.

    Frequent keys, at most SHARE, are broadcast, so what is shuffled has no large key.
    """
    frequent = F.col("weight") * SHARE >= total
    near = rows.join(F.broadcast(table.filter(frequent)), key, "left")
    rare = near.filter(F.col("weight").isNull()).select(*rows.columns).join(table.filter(~frequent), key)
    return near.filter(F.col("weight").isNotNull()).unionByName(rare).drop("weight")
