"""Plain-Python versions of the operators' contracts."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def substring(rows, size=50):
    """rows: (doc_id, text). doc_id -> (n_words, n_removed, sha256)."""
    first = {}
    toks = [(d, words(t)) for d, t in rows]
    for d, w in toks:
        for i in range(len(w) - size + 1):
            k = tuple(w[i:i + size])
            first[k] = min(first.get(k, d), d)
    out = []
    for d, w in toks:
        cut = [False] * len(w)
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < d:
                cut[i:i + size] = [True] * size
        kept = " ".join(x for x, c in zip(w, cut) if not c)
        out.append((d, len(w), sum(cut), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def byte_repeats(rows, size=200):
    """doc_id, n_bytes, n_removed, n_spans, sha256 of what no repeated byte string covers."""
    count = defaultdict(int)
    data = [(d, (t or "").encode()) for d, t in rows]
    for _, b in data:
        for i in range(len(b) - size + 1):
            count[hashlib.blake2b(b[i:i + size], digest_size=16).digest()] += 1
    out = []
    for d, b in data:
        cut, end = bytearray(len(b)), 0
        for i in range(len(b) - size + 1):
            if count[hashlib.blake2b(b[i:i + size], digest_size=16).digest()] > 1:
                s = max(i, end)
                cut[s:i + size] = b"\1" * (i + size - s)
                end = i + size
        kept = bytes(x for x, c in zip(b, cut) if not c)
        spans = len(re.findall(rb"\x01+", bytes(cut)))
        out.append((d, len(b), sum(cut), spans, hashlib.sha256(kept).hexdigest()))
    return out


def shingles(text, size=5):
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not w:
        return frozenset()
    if len(w) < size:
        return frozenset([tuple(w)])
    return frozenset(tuple(w[i:i + size]) for i in range(len(w) - size + 1))


def jaccard_components(rows, pct=80):
    sets = [(d, shingles(t)) for d, t in rows]
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    at = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        seen = defaultdict(int)
        for g in s:
            for j in at[g]:
                seen[j] += 1
            at[g].append(i)
        for j, n in seen.items():
            if 100 * n >= pct * (len(s) + len(sets[j][1]) - n):
                up[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (d, _) in enumerate(sets):
        r = top(i)
        least[r] = min(least.get(r, d), d)
    return [(d, len(s), least[top(i)]) for i, (d, s) in enumerate(sets)]


def quality_base(text):
    w = words(text)
    tri = defaultdict(int)
    for i in range(len(w) - 2):
        tri[tuple(w[i:i + 3])] += 1
    hit = set()
    for i in range(len(w) - 2):
        if tri[tuple(w[i:i + 3])] > 1:
            hit |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(hit)
