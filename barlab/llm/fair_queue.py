"""Mixing sources to target weights by weighted fair queueing.

Documents of a source are shuffled by a hash; a document's virtual finish time
is the running word count of its source divided by the source's target. All
passes over a source (at most ``max_repeat``) stand in one queue, which is range
sorted by finish time and cut at the total budget.

A source may hold any share of the rows: running sums are taken in hash blocks
of a source, block totals are added up, and the cut is found from the totals of
the range partitions; only the partition that holds the cut is sorted in full.
Single-task windows see one row per source, per block or per partition.

Native. Edge cases: null source is a source of its own, the last one; null and
empty texts have size 0 and take 0; a source of size 0 has target 0; rows with
equal ``doc_id``, source and size are alike and taken alike; an empty table
gives no rows; no column other than doc_id, text and source is read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm.workspace import Workspace, shuffle_partitions, text_key

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
#: Documents aimed at in one block of a source.
BLOCK_DOCS = 2_000


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size and the shuffle key ``k`` of every row."""
    th, tk = text_key(F.col("doc_id"), F.col("text"))
    k = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    return docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(k.cast("binary")).alias("k"), th.alias("text_hash"), tk.alias("text_hash2"))


def targets(ws: Workspace, rows: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Per source: size, document count, weight and target.

    With the sources in order of cap over weight, those below the water level
    stop at their cap and the level is what is left over the weight that is
    left. That quotient rises until the first source that isn't capped and falls
    behind it, so the level is its maximum.
    """
    src = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (nth % len(weights) + 1).cast("int"))
    src = src.withColumn("weight", w.cast("long")).withColumn("cap", F.col("source_size") * max_repeat)
    by_cap = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    src = (src.withColumn("below", F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .withColumn("weight_left", F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
           .withColumn("total", F.sum("source_size").over(every)))
    level = (F.col("total") - F.col("below")) / F.col("weight_left")
    src = src.withColumn("level", level)
    src = src.withColumn("final", F.max("level").over(every))
    target = F.least(F.col("cap").cast("double"), F.col("final") * F.col("weight"))
    return ws.stage(src.select("source", "source_size", "n_docs", "total",
                               F.coalesce(target, F.col("cap").cast("double")).alias("target")), "targets")


def queue(ws: Workspace, rows: DataFrame, tgt: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Rows with ``cum``, the running size within their shuffled source."""
    blocks = F.ceil(F.col("n_docs") / block_docs)
    spread = F.conv(F.substring("k", 1, 8), 16, 10).cast("long")
    q = rows.join(tgt, rows["source"].eqNullSafe(tgt["source"])).select(
        rows["doc_id"], rows["source"], "size", "k", "text_hash", "text_hash2", "source_size", "target", "total",
        F.floor(spread * blocks / F.lit(1 << 32)).cast("long").alias("block"))
    q = ws.stage(q, "queued")
    parts = q.groupBy("source", "block").agg(F.sum("size").alias("block_size"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    parts = ws.stage(parts.select(F.col("source").alias("s"), F.col("block").alias("b"),
                                  F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("before")), "blocks")
    inside = Window.partitionBy("source", "block").orderBy("k", "size", "doc_id").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (q.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
            .withColumn("cum", F.col("before") + F.sum("size").over(inside)).drop("s", "b", "before", "block"))


def cut(ws: Workspace, events: DataFrame, budget: int):
    """The queue's row at which the running size reaches ``budget``, with what it may still take."""
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("k"), F.col("pass")]
    spark = events.sparkSession
    parts = events.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id())
    parts = ws.stage(parts, "finish-order")
    sums = parts.groupBy("part").agg(F.sum("size").alias("n"))
    run = sums.withColumn("upto", F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)))
    hit = run.filter(F.col("upto") >= budget).orderBy("part").limit(1).first()
    if hit is None:
        return None
    rest = budget - (hit["upto"] - hit["n"])
    inside = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    row = (parts.filter(F.col("part") == hit["part"]).withColumn("upto", F.sum("size").over(inside))
           .filter(F.col("upto") >= rest).orderBy("upto", *order).limit(1).first())
    return row, rest - (row["upto"] - row["size"])


def mix(ws: Workspace, docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """doc_id, source, text hashes, size, source_size, target and ``taken`` of every document row.

    ``taken`` counts words with repeats. The document at the cut gives only the
    words that are left of the budget, so the words taken add up to all sizes.
    """
    rows = ws.stage(sizes(docs), "sizes")
    tgt = targets(ws, rows, weights, max_repeat)
    q = ws.stage(queue(ws, rows, tgt), "cum")
    finish = lambda e: (F.col("cum") + e * F.col("source_size")) / F.col("target")
    events = (q.filter((F.col("size") > 0) & (F.col("target") > 0))
              .withColumn("pass", F.explode(F.array(*[F.lit(e) for e in range(max_repeat)])))
              .withColumn("finish", finish(F.col("pass")))
              .select("finish", "source", "k", "pass", "size"))
    first = tgt.select("total").limit(1).first()
    found = cut(ws, events, first["total"]) if first and first["total"] else None
    if found is None:
        taken = F.lit(0).cast("long")
    else:
        row, part = found
        last_source = F.lit(row["source"]).cast("string")
        source_rank = F.when(F.col("source").eqNullSafe(last_source), 0).when(
            F.col("source").isNull(), 1).when(last_source.isNull(), -1).when(F.col("source") < last_source, -1).otherwise(1)

        def take(e: int):
            here = F.struct(finish(e), source_rank, F.col("k"), F.lit(e))
            at = F.struct(F.lit(row["finish"]), F.lit(0), F.lit(row["k"]), F.lit(row["pass"]))
            return F.when(here < at, F.col("size")).when(here == at, F.lit(part).cast("long")).otherwise(0)

        total = sum((take(e) for e in range(1, max_repeat)), take(0))
        taken = F.when((F.col("size") > 0) & (F.col("target") > 0), total).otherwise(0).cast("long")
    return q.select("doc_id", "source", "text_hash", "text_hash2", "size", "source_size", "target", taken.alias("taken"))


def mixed_documents(ws: Workspace, docs: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``docs`` as the mix takes them: a row per whole repeat, and the first words of the document at the cut.

    Rows equal in doc_id, source and text stand for each other: the copies taken
    of them carry the columns of one of them. ``n_chars`` follows a cut text.
    """
    cols = docs.columns
    taken = mix(ws, docs, weights, max_repeat).groupBy("doc_id", "source", "text_hash", "text_hash2").agg(
        F.sum("taken").alias("__taken"), F.max("size").alias("__size")).filter("__taken > 0")
    taken = ws.stage(taken.withColumnsRenamed({"doc_id": "__d", "source": "__s", "text_hash": "__t", "text_hash2": "__u"}), "taken")
    th, tk = text_key(F.col("doc_id"), F.col("text"))
    rows = docs.join(taken, F.col("doc_id").eqNullSafe(F.col("__d")) & F.col("source").eqNullSafe(F.col("__s")) & (th == F.col("__t"))
                     & (tk == F.col("__u")))
    rows = rows.dropDuplicates(["__d", "__s", "__t", "__u"])
    rows = rows.withColumn("__nth", F.explode(F.sequence(F.lit(1), F.ceil(F.col("__taken") / F.col("__size")).cast("int"))))
    rest = (F.col("__taken") - (F.col("__nth") - 1) * F.col("__size")).cast("int")
    cut_text = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, rest), " ")
    rows = rows.withColumn("text", F.when(rest < F.col("__size"), cut_text).otherwise(F.col("text")))
    if "n_chars" in cols:
        rows = rows.withColumn("n_chars", F.when(rest < F.col("__size"), F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return rows.select(*cols)
