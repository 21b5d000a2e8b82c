"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barlab.llm import (fair_queue, jaccard_join, merkle_manifest, oracle, projection_forest, rule_cascade, secret_scan, site_templates,
                        snapshots, substring_dedup, suffix_levels, token_alignment, url_lm, vector_packing)
from barlab.llm.workspace import Workspace


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_url_language_ratio(spark, sf_dir):
    return url_lm.judge_urls(Workspace(spark, "op1"), _table(spark, sf_dir, "pages"))


def op2_projection_forest(spark, sf_dir):
    return projection_forest.neighbours(Workspace(spark, "op2"), _table(spark, sf_dir, "embeddings"))


def op3_substring_doubling(spark, sf_dir):
    out = substring_dedup.remove_repeats(Workspace(spark, "op3"), _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_site_templates(spark, sf_dir):
    return site_templates.extract(Workspace(spark, "op4"), _table(spark, sf_dir, "pages"))


def op5_suffix_levels(spark, sf_dir):
    out = suffix_levels.remove_repeats(Workspace(spark, "op5"), _table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_vector_best_fit(spark, sf_dir):
    return vector_packing.pack(Workspace(spark, "op6"), _table(spark, sf_dir, "documents"))


def op7_fair_queue(spark, sf_dir):
    return fair_queue.mix(Workspace(spark, "op7"), _table(spark, sf_dir, "documents")).drop("source", "text_hash", "text_hash2")


def op8_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(Workspace(spark, "op8"), _table(spark, sf_dir, "documents")).drop("text_hash", "text_hash2")


def op9_snapshot_collapse(spark, sf_dir):
    return snapshots.collapse_and_format(Workspace(spark, "op9"), _table(spark, sf_dir, "conversations"))


def op10_rule_cascade(spark, sf_dir):
    return rule_cascade.judge(Workspace(spark, "op10"), _table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return merkle_manifest.verify(Workspace(spark, "op11"), merkle_manifest.leaves(docs, merkle_manifest.every_seventh(F.col("doc_id"))))


def op12_secret_models(spark, sf_dir):
    return secret_scan.report(Workspace(spark, "op12"), _table(spark, sf_dir, "documents"))


def op13_token_alignment(spark, sf_dir):
    return token_alignment.align(Workspace(spark, "op13"), _table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_url_language_ratio, op2_projection_forest, op3_substring_doubling, op4_site_templates, op5_suffix_levels, op6_vector_best_fit, op7_fair_queue,
        op8_jaccard_join, op9_snapshot_collapse, op10_rule_cascade, op11_merkle_manifest,
        op12_secret_models, op13_token_alignment)
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
