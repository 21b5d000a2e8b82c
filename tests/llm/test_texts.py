"""Operators on documents against plain Python, with odd rows."""

import hashlib
import random

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import docs, ws  # noqa: F401
from pyspark.sql import functions as F

from barlab.llm import components as CC
from barlab.llm import fair_queue, jaccard_join, rule_cascade, substring_dedup, suffix_levels, vector_packing
from barlab.llm import vectors as V

rng = random.Random(5)
VOCAB = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(1, 9))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(VOCAB) for _ in range(n))


def edited(text, share, seed):
    r, w = random.Random(seed), text.split(" ")
    for i in r.sample(range(len(w)), max(1, int(share * len(w)))):
        w[i] = r.choice(VOCAB) + "x"
    return " ".join(w)


def odd_rows():
    base, passage = prose(300, 1), prose(70, 2)
    rows = [(0, base), (1, base), (2, edited(base, 0.01, 3)), (3, edited(base, 0.3, 4)), (4, None), (5, ""), (6, " \n\t "),
            (7, "one two"), (8, "one two"), (9, "ONE Two"), (10, passage), (11, prose(100, 6) + "\n" + passage + "\r\n" + prose(90, 7)),
            (12, prose(40, 8) + "  " + passage), (13, base + " " + base), (14, prose(20_000, 9)), (15, "x" * 5000), (16, "x" * 4999),
            (17, prose(49, 10)), (18, prose(50, 11)), (19, prose(50, 11)), (20, "<|endoftext|> a  b " + passage), (21, "\u00a0é " * 120)]
    rows += [(100 + i, edited(base, 0.005 * i, 50 + i)) for i in range(1, 12)]
    return rows + [(0, base), (7, "one two"), (14, "other text of the same id")]


def sorted_rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_substrings(ws, docs):
    rows = odd_rows()
    out = substring_dedup.remove_repeats(ws, docs(rows).withColumn("n_words", F.lit("clash")).withColumn("anchor", F.lit(1)))
    got = sorted_rows(out, "doc_id", "n_words", "n_removed", F.sha2("text", 256))
    assert got == sorted(brute.substring(rows))
    assert set(out.columns) == {"doc_id", "text", "lang", "source", "n_chars", "anchor", "n_words", "n_removed"}


def test_substrings_keep_layout(ws, docs):
    rows = odd_rows()
    out = {(r.doc_id, r.n_words): r for r in substring_dedup.remove_repeats(ws, docs(rows), keep_layout=True).collect()}
    for (d, t), (_, n, gone, sha) in zip(rows, brute.substring(rows)):
        r = out[d, n]
        assert r.n_removed == gone
        assert r.text == (t or "") if not gone else hashlib.sha256(r.text.encode()).hexdigest() == sha


def test_substrings_null_id(ws, docs):
    p = prose(60, 1)
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(ws, docs([(None, p), (3, p)])).collect()}
    assert got == {None: 60, 3: 0}  # a null id is larger than any other


@pytest.mark.parametrize("batches", [1, 4])
def test_bytes(ws, docs, batches):
    rows = odd_rows()
    out = suffix_levels.remove_repeats(ws, docs(rows).withColumn("kept", F.lit(1)).withColumn("bucket", F.lit(0)), n_batches=batches)
    got = sorted_rows(out, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256))
    assert got == sorted(brute.byte_repeats(rows))


def test_bytes_hot_anchor(ws, docs, monkeypatch):
    monkeypatch.setattr(suffix_levels, "HOT", 2)
    rows = odd_rows()
    out = suffix_levels.remove_repeats(ws, docs(rows))
    assert sorted_rows(out, "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)) == sorted(brute.byte_repeats(rows))


def test_suffix_levels_merge_geometrically(ws, spark):
    import pandas as pd

    index = suffix_levels.SuffixIndex(ws, 4)
    seen = []
    for i, text in enumerate([b"abcdefgh", b"xxabcdyy", b"12345678", b"zz2345zz", b"abcd"]):
        n = len(text) - 3
        rows = pd.DataFrame({"bucket": [0], "doc": [i], "th": [0], "tk": [0], "lo": [0], "n": [n], "multi": [False], "bytes": [text]})
        batch = spark.createDataFrame(rows, V.struct("bucket long, doc long, th long, tk long, lo int, n int, multi boolean, bytes binary"))
        found = index.add(batch).collect()
        seen.append(({(r.doc, r.s, r.e) for r in found}, sorted(index.levels)))
    assert seen == [(set(), [0]), ({(0, 0, 4), (1, 2, 6)}, [1]), (set(), [0, 1]), ({(2, 1, 5), (3, 2, 6)}, [2]),
                    ({(0, 0, 4), (1, 2, 6), (4, 0, 4)}, [0, 2])]


def test_jaccard(ws, docs):
    rows = odd_rows()
    out = jaccard_join.near_duplicates(ws, docs(rows).withColumn("id", F.lit(1)).withColumn("root", F.lit(1)))
    want = []
    for d, n, c in brute.jaccard_components(rows):
        want.append((d, n, c if n else d))
    assert sorted_rows(out, "doc_id", "n_shingles", "component_id") == sorted(want)


def test_jaccard_many_near_copies(ws, docs):
    """A chain of edits: ends don't link directly, yet all are one component."""
    text, rows = prose(200, 77), []
    for i in range(40):
        rows.append((i, text))
        text = edited(text, 0.012, i)
    rows += [(100 + i, prose(200, 300 + i)) for i in range(40)]
    got = sorted_rows(jaccard_join.near_duplicates(ws, docs(rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_components(rows))


def test_jaccard_boundary(ws, docs):
    """Exactly 80 of 100 links; fewer doesn't."""
    a = [f"w{i}" for i in range(94)]
    rows = [(1, " ".join(a)), (2, " ".join(a[:84])), (3, " ".join(a[:-11]) + " q")]
    got = sorted_rows(jaccard_join.near_duplicates(ws, docs(rows)), "doc_id", "n_shingles", "component_id")
    assert got == sorted(brute.jaccard_components(rows))


def test_keep_one(ws, docs):
    rows = odd_rows()
    comp = brute.jaccard_components(rows)
    want = {d for d, n, c in comp if n == 0 or d == c}
    kept = jaccard_join.keep_one(ws, docs(rows)).collect()
    assert {r.doc_id for r in kept} == want
    assert sum(r.doc_id == 0 for r in kept) == 1  # repeated rows of the kept document


def test_keep_one_of_each_group_without_or_with_repeated_ids(ws, docs):
    words = [prose(60, seed).split() for seed in (901, 902, 903)]
    a, b, c = (" ".join(w) for w in words)
    rows = [(None, a), (None, a + " end"), (None, a.replace("a", "A")), (None, a), (5, b), (5, b + " end"), (6, b), (None, c), (9, c + " end"), (None, "")]
    kept = [(r.doc_id, r.text) for r in jaccard_join.keep_one(ws, docs(rows)).collect()]
    assert sorted(str(d) for d, _ in kept) == ["5", "9", "None", "None"]
    assert sum(d is None and t.lower().startswith(a.lower()) for d, t in kept) == 1


def test_components(ws, spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7)] + [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for u, v in edges:
        a, b = top(u), top(v)
        up[max(a, b)] = min(a, b)
    want = {x: top(x) for x in list(up) if top(x) != x}
    got = {r.node: r.root for r in CC.components(ws, spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == want
    assert CC.components(ws, spark.createDataFrame([], "u long, v long")).count() == 0


def test_quality(ws, docs):
    rows = odd_rows()
    out = rule_cascade.judge(ws, docs(rows).withColumn("kept", F.lit(1)).withColumn("n_lines", F.lit("clash")))
    want = []
    for d, t in rows:
        n, *rest, rep = brute.quality_base(t)
        want.append((d, n, *rest, rep, n < 50 or 100 * rep > 50 * n))
    assert sorted_rows(out, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed") == sorted(want)
    assert all(not r.kept for r in out.collect() if r.base_failed)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["a", "b", "c", "\n", "\x0b", " ", "#", "é", "\u00a0", "d\r"]), max_size=40).map("".join), min_size=1, max_size=8))
def test_quality_signals_any_text(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    sig = rule_cascade.signals(F.col("text"))
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[c] for c in cols) for r in df.select("doc_id", *[sig[c].alias(c) for c in cols]).collect()}
    assert got == {i: brute.quality_base(t) for i, t in enumerate(texts)}


def test_quality_verdicts(ws, docs):
    clean, junk = prose(120, 1), "### " + " ".join(f"{w}%%%" for w in prose(120, 2).split())
    shout = " ".join(f"{w}!!" for w in prose(120, 3).split())
    lines = "\n".join([prose(8, 4)] * 12 + [prose(60, 5)])
    got = {r.doc_id: r.kept for r in rule_cascade.judge(ws, docs([(1, clean), (2, junk), (3, shout), (4, lines)])).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False}
    kept = rule_cascade.keep(ws, docs([(1, clean), (2, junk)]).withColumn("rejected_by", F.lit("mine"))).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, clean)]


def test_rules_go_by_rejection_per_cost(ws, docs):
    sample = docs([(i, prose(60 if i % 2 else 10, i)) for i in range(40)]).select("text")
    rules = [rule_cascade.Rule("never", lambda s: s["n_words"] < 0), rule_cascade.Rule("half", lambda s: s["n_words"] < 50)]
    assert [r.name for r in rule_cascade.order_rules(ws, sample, rules)] == ["half", "never"]


def mix_of(rows):
    """Targets by water-filling, one level at a time."""
    size = {}
    for _, t, _, s, _ in rows:
        size[s] = size.get(s, 0) + len(brute.words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, open_, target = sum(size.values()), set(order), {}
    while open_:
        level = (total - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 3 * size[s]}
        if not full:
            return size, target | {s: level * weight[s] for s in open_}
        target |= {s: 3.0 * size[s] for s in full}
        open_ -= full
    return size, target


def test_mix(ws, docs):
    r = random.Random(8)
    rows = [(i, prose(r.randint(1, 120), i), "en", r.choice(["a", "B", "é", "z", "z", "z", "z", None]), 0) for i in range(600)]
    rows += [(1000, None, "en", "a", 0), (1001, "", "en", "empty", 0), (1002, "few words", "en", "small", 0), rows[0]]
    out = fair_queue.mix(ws, docs(rows)).collect()
    size, target = mix_of(rows)
    taken = dict.fromkeys(size, 0)
    assert len(out) == len(rows)
    for x in out:
        assert x.source_size == size[x.source] and abs(x.target - target[x.source]) < 1e-6
        assert 0 <= x.taken <= 3 * x.size
        taken[x.source] += x.taken
    assert sum(taken.values()) == sum(size.values())
    for s in size:
        assert abs(taken[s] - target[s]) <= 240, (s, taken[s], target[s])
    again = fair_queue.mix(ws, docs(rows).repartition(7)).collect()
    assert sorted((x.doc_id, x.taken) for x in again) == sorted((x.doc_id, x.taken) for x in out)


def test_mixed_documents(ws, docs):
    rows = [(i, prose(30 + i % 50, i), "en", "abc"[i % 3], 0) for i in range(90)]
    taken = {x.doc_id: x for x in fair_queue.mix(ws, docs(rows)).collect()}
    got = {}
    for x in fair_queue.mixed_documents(ws, docs(rows).withColumn("size", F.lit(0))).collect():
        got[x.doc_id] = got.get(x.doc_id, 0) + len(brute.words(x.text))
    assert got == {d: x.taken for d, x in taken.items() if x.taken}


def test_packing(ws, docs):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    rows = odd_rows()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out = vector_packing.pack(ws, docs(rows)).collect()
    want = []
    for d, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        for i, (s, n) in enumerate(vector_packing.cut_pieces(len(ids), 2048)):
            want.append((d, i, s, n, zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == sorted(want)
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        end = 0
        for o, n in sorted(parts):
            assert o == end
            end += n
        assert end <= 2048
    bins = []
    for n in sorted((w[3] for w in want), reverse=True):  # first fit decreasing
        k = next((k for k, x in enumerate(bins) if x + n <= 2048), None)
        if k is None:
            bins.append(n)
        else:
            bins[k] += n
    assert len(by) <= len(bins)


@pytest.mark.parametrize("by", ["norm", "dot"])
def test_packing_holds_every_capacity(by):
    cap = vector_packing.Capacity(tokens=100, documents=3, cost=3000, by=by, weights=(1, 0.5, 0.5))
    n = np.sort(np.random.default_rng(1).integers(1, 50, 500))[::-1]
    seq, offset = vector_packing.best_fit(n, cap)
    for s in np.unique(seq):
        own = n[seq == s]
        assert own.sum() <= 100 and len(own) <= 3 and (len(own) == 1 or (own ** 2).sum() <= 3000)
    with pytest.raises(ValueError):
        vector_packing.Capacity(tokens=0)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab é\n\t\u00a0\u3000.,1'ſ\x1c") + [" ", " ", "<|endoftext|>"][:2]), max_size=60))
def test_cached_parts_are_the_tokenizers_ids(text):
    import public_tokenizers

    enc = vector_packing.encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))
    assert np.frombuffer(enc.ids(text), "<u4").tolist() == enc.whole.encode(text, add_special_tokens=False).ids


def test_empty_tables(ws, docs):
    e = docs([])
    assert substring_dedup.remove_repeats(ws, e).count() == 0
    assert suffix_levels.remove_repeats(ws, e).count() == 0
    assert jaccard_join.near_duplicates(ws, e).count() == 0
    assert jaccard_join.keep_one(ws, e).count() == 0
    assert rule_cascade.judge(ws, e).count() == 0
    assert fair_queue.mix(ws, e).count() == 0
    assert fair_queue.mixed_documents(ws, e).count() == 0
    assert vector_packing.pack(ws, e).count() == 0


def test_sliding_argmin():
    x = np.random.default_rng(0).integers(0, 6, 500).astype(np.uint64) << np.uint64(40)
    for w in (1, 2, 7, 500):
        assert V.sliding_argmin(x, w).tolist() == [int(np.argmin(x[i:i + w])) + i for i in range(len(x) - w + 1)]
