"""Merkle manifest against plain Python with hashlib."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from llm_fixtures import docs, ws  # noqa: F401
from pyspark.sql import functions as F

from barlab.llm import merkle_manifest as M
from barlab.llm import sha_state as S


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_of(leaves, fan):
    out = [leaves]
    while len(out[-1]) > 1:
        row = out[-1]
        out.append([h(*row[i:i + fan]) for i in range(0, len(row), fan)])
    return out


def climb(levels, at, new, fan):
    """Root with ``new`` in place of leaf ``at``, and the siblings on the way."""
    met = []
    for row in levels[:-1]:
        base = at - at % fan
        kids = row[base:base + fan]
        met += kids[:at - base] + kids[at - base + 1:]
        kids[at - base] = new
        new, at = h(*kids), at // fan
    return new, met


def brute(rows, fan):
    def leaf(r, more=0):
        d, text, lang, source, n = r
        vals = [d, source, lang, n if n is None else n + more, text]
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in vals))

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, placed = {}, {}
    for lang in langs:
        mine = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        placed[lang], trees[lang] = mine, levels_of([leaf(r) for r in mine], fan)
    top = levels_of([trees[x][-1][0] for x in langs], fan)
    out = []
    for k, lang in enumerate(langs):
        for i, r in enumerate(placed[lang]):
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            sub, met = climb(trees[lang], i, leaf(r, int(hit)), fan)
            root, above = climb(top, k, sub, fan)
            out.append((r[0], leaf(r), trees[lang][-1][0], top[-1][0], h(*met, *above), root, root == top[-1][0]))
    return out


def run(ws, df, fan=2, page=M.PAGE):  # noqa: F811
    got = M.verify(ws, M.leaves(df, M.every_seventh(F.col("doc_id"))), fan, page)
    return sorted(map(tuple, got.collect()), key=str)


def test_states_go_on_from_any_block():
    rng = np.random.default_rng(3)
    digests = [rng.bytes(32) for _ in range(9)]
    blocks = S.hex_block(S.unpack(b"".join(digests)))
    state = S.absorb(S.start(9), blocks)
    stored = S.unpack(S.pack(state))  # what a table keeps
    done = S.pack(S.absorb(S.absorb(stored, blocks[:, :1]), S.closing_block(np.full(9, 2))))
    for i, d in enumerate(digests):
        assert done[32 * i: 32 * i + 32] == hashlib.sha256((d.hex() + digests[0].hex()).encode()).digest()


@pytest.mark.parametrize("fan,page", [(2, 4), (3, 9), (2, M.PAGE), (5, 5)])
def test_against_plain_python(ws, docs, fan, page):  # noqa: F811
    rng = random.Random(7)
    rows = [(i, f"text {rng.random()} é", rng.choice(["en", "en", "en", "de", None, "ü", "z"]), rng.choice(["a", None]),
             rng.choice([None, 3, 9])) for i in range(75)]
    rows += [(None, "x", "en", "s", 1), (None, "y", "en", "s", 1), (None, "x", "en", "s", 1), (5, None, "en", None, None),
             (5, "", "en", "s", (1 << 63) - 1), (5, "", "en", "s", 0), (-7, "w" * 30_000, "one", "s", 2), (1 << 62, "same", "fr", "s", 2)] * 2
    assert run(ws, docs(rows), fan, page) == sorted(brute(rows, fan), key=str)


def test_single_rows_and_none(ws, docs):  # noqa: F811
    one = [(7, "alone", "en", "s", 5)]
    got = run(ws, docs(one))
    assert got == brute(one, 2) and got[0][1] == got[0][2] == got[0][3]
    assert got[0][4] == hashlib.sha256(b"").hexdigest()
    assert run(ws, docs(one).limit(0)) == []
    two = [(1, "a", None, "s", 5), (2, "a", "", "s", 5)]
    assert run(ws, docs(two)) == sorted(brute(two, 2), key=str)


def test_clashing_columns(ws, docs):  # noqa: F811
    rows = [(i, f"t{i}", "en", "s", i) for i in range(20)]
    df = docs(rows)
    more = df.withColumns({c: F.lit("x") for c in ("key", "pos", "m", "row", "part", "digest", "replacement", "block", "path")})
    assert run(ws, more, 2, 4) == run(ws, df, 2, 4)


def test_only_tampered_rows_fail(ws, docs):  # noqa: F811
    rows = [(i, f"t{i}", "en", "s", i if i % 2 else None) for i in range(60)]
    for doc, *_, ok in run(ws, docs(rows)):
        assert ok == (not (zlib.crc32(str(doc).encode()) % 7 == 0 and doc % 2))


def test_bad_shapes():
    for fan, page in ((1, 8), (4, 3)):
        with pytest.raises(ValueError):
            M.depth_of(fan, page)
