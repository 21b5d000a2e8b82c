"""The pipeline's stages against plain Python, and its registration."""

import hashlib

import brute
import corpus_pipeline
import pytest
from llm_fixtures import docs, ws  # noqa: F401
from pyspark.sql import functions as F
from test_texts import prose

SF_SMALL = "/root/testdata/sf0.001"


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages(spark, ws):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    cols, prev, stages = docs.columns, texts(docs), dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_rules", "near_duplicates", "substrings", "source_mix", "packing"]

    docs = ws.stage(stages["quality_rules"](spark, docs, SF_SMALL), "a")
    kept = dict(texts(docs))
    for d, t in prev:
        n, _, symbols, _, rep = brute.quality_base(t)
        if n < 50 or 2 * rep > n or 10 * symbols > n:
            assert d not in kept
    assert docs.columns == cols and len(kept) > 0.5 * len(prev)

    prev = texts(docs)
    docs = ws.stage(stages["near_duplicates"](spark, docs, SF_SMALL), "b")
    assert sorted(d for d, _ in texts(docs)) == sorted(d for d, n, c in brute.jaccard_components(prev) if n == 0 or d == c)

    prev = dict(texts(docs))
    docs = ws.stage(stages["substrings"](spark, docs, SF_SMALL), "c")
    now = dict(texts(docs))
    for d, _, gone, sha in brute.substring(list(prev.items())):
        assert now[d] == prev[d] if not gone else hashlib.sha256(now[d].encode()).hexdigest() == sha
    assert docs.columns == cols

    docs = ws.stage(stages["source_mix"](spark, docs, SF_SMALL), "d")
    mixed = texts(docs)
    assert docs.columns == cols
    assert sum(len(brute.words(t)) for _, t in mixed) == sum(len(brute.words(t)) for t in now.values())

    packed = stages["packing"](spark, docs, SF_SMALL).collect()
    assert {r.doc_id for r in packed} == {d for d, _ in mixed}
    room = {}
    for r in packed:
        room[r.sequence_id] = room.get(r.sequence_id, 0) + r.length
    assert max(room.values()) <= 2048


def odd_documents():
    long = prose(4000, 77)
    return [(1, prose(120, 1), "en", "a", 5), (2, prose(120, 1), "en", "b", 5), (None, prose(120, 2), None, None, None), (None, prose(120, 3), "en", "a", 7),
            (None, prose(120, 3), "en", "a", 7), (3, None, "en", "a", None), (4, "", "en", None, 0), (5, "two words", "en", "a", 9), (6, long, "fr", "c", 1),
            (6, prose(130, 5), "fr", "c", 1), (7, " \n\t ", "en", "a", 4), (8, "é " * 200, "en", "a", 400), (9, prose(120, 2) + " more words", "en", "a", 3)]


CLASHING = ("size", "k", "row", "id", "root", "n_words", "n_removed", "n_shingles", "text_hash", "taken", "group", "length", "th", "part", "block")


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_rows_and_empty_tables(spark, ws, docs, name):  # noqa: F811
    stage, rows = dict(corpus_pipeline.STAGES)[name], odd_documents()
    df = docs(rows).withColumns({c: F.lit("x") for c in CLASHING})
    out = stage(spark, df, SF_SMALL)
    got = out.collect()
    assert stage(spark, df.limit(0), SF_SMALL).collect() == []
    if name == "packing":
        assert len({(r.sequence_id, r.offset) for r in got}) == len(got) >= len(rows)
        return
    assert out.columns == df.columns and all(r.size == "x" for r in got)
    found = sorted(((r.doc_id, r.text) for r in got), key=str)
    if name == "quality_rules":
        base = [(d, t, brute.quality_base(t)) for d, t, *_ in rows]
        assert found == sorted(((d, t) for d, t, (n, chars, _, _, rep) in base if n >= 50 and 2 * rep <= n and chars >= 2 * n), key=str)
    elif name == "near_duplicates":
        kept = [r for r in found if len(brute.words(r[1])) >= 50]
        assert sorted(str(d) for d, _ in kept) == sorted(["1", "None", "6", "6", "8", "9"])
        assert sum(1 for d, t in found if not brute.words(t)) == 3
    elif name == "substrings":
        want = brute.substring([(d if d is not None else (1 << 63) - 1, t) for d, t, *_ in rows])
        assert sorted(len(brute.words(t)) for _, t in found) == sorted(n - gone for _, n, gone, _ in want)
    else:
        assert sum(len(brute.words(t)) for _, t in found) == sum(len(brute.words(r[1])) for r in rows)


def test_registered():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert "pipeline" in names
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
