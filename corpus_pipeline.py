"""From raw documents to packed training sequences.

Each stage reads what its predecessor kept and returns the columns of documents,
but the last, which returns the packed pieces. Stages leave clean documents as
they are: the quality rules only drop rows, near-duplicate removal keeps the
document of smallest id of each group, substring dedup rewrites only texts that
hold a repeat, and the mix repeats whole documents.

Edge cases: null and empty texts fail the quality rules (fewer than 50 words); given to
another stage they stay, but in the mix, where they have no words to take. Null ids are
documents of their own, told apart by their texts, and larger than any other id; of rows
that share an id and a text one stays. Ties go to the smaller id, then to the text's hash.
Empty tables give empty tables; columns beside doc_id, text, source and n_chars pass
through whatever their names, and a stage's helper columns don't clash with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import fair_queue, jaccard_join, rule_cascade, substring_dedup, vector_packing
from barlab.llm.workspace import Workspace


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return rule_cascade.keep(Workspace(spark, "quality"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(Workspace(spark, "near"), docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(Workspace(spark, "substrings"), docs, keep_layout=True)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                             .cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return fair_queue.mixed_documents(Workspace(spark, "mix"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return vector_packing.pack(Workspace(spark, "packing"), docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("substrings", substrings),
          ("source_mix", source_mix), ("packing", packing)]

#: Similarity components, word windows and tokenization have no SQL here; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's result written and read again."""
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
