"""Rows of null or repeated ids are told apart, also where a 32-bit hash of their texts is equal."""

import hashlib

import brute
import pytest
from llm_fixtures import docs, ws  # noqa: F401
from pyspark.sql import functions as F
from test_texts import prose

from barlab.llm import fair_queue, jaccard_join, projection_forest, substring_dedup, suffix_levels
from barlab.llm.workspace import text_key


@pytest.fixture(scope="module")
def twins(spark):
    """A text that repeats ``seen`` and an unrelated one with the same 32-bit hash."""
    seen, other = prose(60, 5001), prose(60, 5002)
    side = lambda t, n: spark.range(120_000).select(F.concat(F.lit(t + " "), F.col("id").cast("string"), F.lit("x")).alias(n))
    a, b = side(seen, "a"), side(other, "b")
    hit = a.join(b, F.hash("a") == F.hash("b")).orderBy("a", "b").first()
    assert hit is not None
    return seen, hit["a"], hit["b"]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_equal_hashes(ws, docs, twins, doc_id):  # noqa: F811
    seen, a, b = twins
    rows = [(1, seen), (doc_id, a), (doc_id, b)]
    df = docs([(*r, "en", "s", 1) for r in rows])
    sub = {r.text: r.n_removed for r in substring_dedup.remove_repeats(ws, df, keep_layout=True).collect()}
    assert sub[b] == 0 and sum(sub.values()) == 60
    got = {hashlib.sha256(bytes(r.kept)).hexdigest(): r.n_removed for r in suffix_levels.remove_repeats(ws, df).collect()}
    assert got[hashlib.sha256(b.encode()).hexdigest()] == 0
    assert sorted(got.values()) == sorted(x[2] for x in brute.byte_repeats([(i, t) for i, (_, t) in enumerate(rows)]))
    kept = sorted(r.text for r in jaccard_join.keep_one(ws, df).collect())
    assert kept == sorted([seen, b])
    mixed = {r.text for r in fair_queue.mixed_documents(ws, df).collect()}
    assert {a, b, seen} <= mixed | {a} and len(mixed) == 3


def test_null_id_is_not_the_largest_number(ws, docs):  # noqa: F811
    last, a, b = (1 << 63) - 1, prose(60, 1), prose(70, 2)
    df = docs([(last, a, "en", "s", 1), (None, b, "en", "s", 1), (None, a, "en", "s", 1)])
    got = sorted(map(tuple, jaccard_join.near_duplicates(ws, df).select("doc_id", "n_shingles", "component_id").collect()), key=str)
    assert got == sorted([(last, 56, last), (None, 66, None), (None, 56, last)], key=str)


def test_text_key_tells_null_ids_by_one_bit(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (1, None)], "i long, t string")
    (a, b), (c, d), (e, _) = [tuple(r) for r in df.select(*text_key(F.col("i"), F.col("t"))).collect()]
    assert a == c != e and b != d and (b % 2, d % 2) == (0, 1) and b >> 1 == d >> 1


def test_null_ids_fill_many_blocks(ws, docs):  # noqa: F811
    df = docs([(None, prose(5 + i % 7, i), "en", "s", 1) for i in range(300)])
    rows = fair_queue.sizes(df)
    assert rows.select("k").distinct().count() == 300
    first = sorted(map(tuple, fair_queue.mix(ws, df).collect()), key=str)
    assert first == sorted(map(tuple, fair_queue.mix(ws, df.repartition(5)).collect()), key=str)


def test_one_id_with_several_vectors(spark, ws):  # noqa: F811
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [1.0, 1.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0])]
    got = projection_forest.neighbours(ws, spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    # id 0 stands for the smaller of its vectors, (0, 1)
    assert found == {0: [(1, 50, 1.0), (2, 7, 0.707107)], 50: [(1, 0, 1.0), (2, 7, 0.707107)]}
