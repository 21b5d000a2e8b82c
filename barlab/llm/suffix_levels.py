"""Exact byte dedup with a logarithmic family of suffix arrays.

Every byte covered by a ``size``-byte string that also starts elsewhere (same
document included) is removed. Work goes from cheap to exact:

* Anchors. In each window of ``size`` bytes the gram of smallest hash is its anchor,
  so equal windows have equal anchors. The windows of one anchor form a segment;
  about two anchors in ``size`` bytes are counted, and only anchors found twice go on.
* Classes. Segments of equal content are one class. With two members all its
  windows repeat. An anchor of one class is settled; of the others, one segment
  per class is wanted.
* Suffix arrays. The wanted segments arrive in batches. A batch's segments are
  dealt to buckets by anchor, and each bucket sorts the suffixes at its window
  starts. A new suffix array is merge-scanned against the bucket's existing levels:
  a common prefix of ``size`` bytes is a match on both sides. Equal-sized levels
  then merge, so level k holds 2^k batches and a segment is rewritten a logarithmic
  number of times (``SuffixIndex``).

An anchor in more than ``HOT`` classes (near copies by the thousand) would make one
bucket grow with the data; its windows are counted by hash in Spark instead,
which is as exact and splits freely. All equality by hash uses two 64-bit hashes
(the anchor and the segment or window).

Edge cases: null text is empty; texts shorter than ``size`` stay whole; rows of one
``doc_id`` are separate places, so repeated rows remove each other's text; an
empty table gives no rows; other columns pass through, columns named n_bytes,
n_removed, n_spans or kept are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlab.llm import vectors as V
from barlab.llm.workspace import Workspace, text_key

SIZE = 200
GRAM = 24
BATCHES = 4
BUCKET_BYTES = 1 << 18
HOT = 2048
CHUNK = 1 << 18
#: A row: its id as a number, null as the largest, and two hashes of its text.
ROW = ["__doc", "__text", "__text2"]

SEGMENTS = V.struct("anchor long, seg long, doc long, th long, tk long, lo int, n int")
ENTRIES = V.struct("anchor long, win long, doc long, th long, tk long, lo int, n int, multi boolean, bytes binary")
LEVEL = V.struct("bucket long, level int, text binary, sa binary, start binary, lo binary, n binary, doc binary, th binary, tk binary, multi binary")
RANGES = V.struct("doc long, th long, tk long, s int, e int")
SPANS = V.struct("span_doc binary, span_th binary, span_tk binary, span_s binary, span_e binary")


def byte_segments(size: int, gram: int):
    """Task: the runs of windows that share an anchor."""
    schema, width = to_arrow_schema(SEGMENTS), size - gram + 1

    def run(batches):
        for b in batches:
            docs, hashes, more = (b.column(c).to_numpy() for c in ROW)
            for i, _, buf, offs in V.text_chunks(b.column("text"), CHUNK):
                n = len(buf)
                if n < size:
                    continue
                roll = V.Rolling.of_bytes(buf)
                grams = roll.windows(gram)
                anchor = V.sliding_argmin(grams, width)
                cross = V.spans_mask(n, np.maximum(offs[:-1], offs[1:] - size + 1), offs[1:])
                lo, hi, a = V.anchored_runs(np.flatnonzero(~cross[: n - size + 1]), anchor)
                if not len(lo):
                    continue
                seg = V.mix(roll.runs(lo, hi + size) + (a - lo).astype(V.U) * V.U(0x9E3779B97F4A7C15))
                d = np.searchsorted(offs, lo, side="right") - 1
                yield V.record_batch(schema, anchor=grams[a].view(np.int64), seg=seg.view(np.int64), doc=docs[i + d], th=hashes[i + d], tk=more[i + d],
                                     lo=(lo - offs[d]).astype(np.int32), n=(hi - lo + 1).astype(np.int32))
    return run


def wanted_bytes(size: int):
    """Task: bytes of the wanted segments; of hot anchors, a hash per window instead."""
    schema = to_arrow_schema(ENTRIES)

    def run(batches):
        for b in batches:
            (docs, hashes, more), wanted = (b.column(c).to_numpy() for c in ROW), b.column("wanted")
            for i, j, buf, offs in V.text_chunks(b.column("text"), CHUNK):
                row, f = V.list_column(wanted, i, j)
                if not len(row):
                    continue
                hot = f["hot"].astype(bool)
                r, lo, n = row[~hot], f["lo"][~hot].astype(np.int64), f["n"][~hot].astype(np.int64)
                if len(r):
                    at, _ = V.word_bytes(offs[r] + lo, n + size - 1)
                    ends = np.concatenate(([0], np.cumsum(n + size - 1))).astype(np.int32)
                    data = pa.Array.from_buffers(pa.binary(), len(r), [None, pa.py_buffer(ends), pa.py_buffer(buf[at])])
                    yield V.record_batch(schema, anchor=f["anchor"][~hot], win=np.zeros(len(r), np.int64), doc=docs[i + r], th=hashes[i + r], tk=more[i + r],
                                         lo=lo.astype(np.int32), n=n.astype(np.int32), multi=f["multi"][~hot].astype(bool), bytes=data)
                r, lo, n = row[hot], f["lo"][hot].astype(np.int64), f["n"][hot].astype(np.int64)
                if len(r):
                    at, _ = V.word_bytes(lo, n)
                    r = np.repeat(r, n)
                    win = V.Rolling.of_bytes(buf).runs(offs[r] + at, offs[r] + at + size)
                    for k in range(0, len(r), 1 << 16):
                        s = slice(k, k + (1 << 16))
                        yield V.record_batch(schema, anchor=np.repeat(f["anchor"][hot], n)[s], win=win[s].view(np.int64),
                                             doc=docs[i + r[s]], th=hashes[i + r[s]], tk=more[i + r[s]], lo=at[s].astype(np.int32), n=np.ones(len(r[s]), np.int32),
                                             multi=np.zeros(len(r[s]), bool), bytes=[None] * len(r[s]))
    return run


@dataclass
class SuffixArray:
    """Segments of a bucket, and their window starts in the order of the bytes there."""

    text: np.ndarray
    sa: np.ndarray
    start: np.ndarray
    lo: np.ndarray
    n: np.ndarray
    doc: np.ndarray
    th: np.ndarray
    tk: np.ndarray
    multi: np.ndarray

    KINDS = {"text": np.uint8, "sa": np.int32, "start": np.int32, "lo": np.int32, "n": np.int32, "doc": np.int64, "th": np.int64, "tk": np.int64,
             "multi": np.bool_}

    @classmethod
    def build(cls, pdf: pd.DataFrame, size: int) -> "SuffixArray":
        n = pdf["n"].to_numpy(np.int64)
        start = np.cumsum(n + size - 1) - (n + size - 1)
        at, _ = V.word_bytes(start, n)
        out = cls(np.frombuffer(b"".join(pdf["bytes"]), np.uint8), at.astype(np.int32), start.astype(np.int32),
                  *(pdf[c].to_numpy(cls.KINDS[c]) for c in ("lo", "n", "doc", "th", "tk", "multi")))
        out.sa = out.sa[np.argsort(out.keys(size), kind="stable")]
        return out

    @classmethod
    def load(cls, row) -> "SuffixArray":
        return cls(**{c: np.frombuffer(getattr(row, c), k) for c, k in cls.KINDS.items()})

    def row(self) -> dict[str, bytes]:
        return {c: getattr(self, c).astype(k).tobytes() for c, k in self.KINDS.items()}

    def keys(self, size: int) -> np.ndarray:
        """The bytes at every window start, in array order."""
        return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(self.text, size)[self.sa]).view(f"S{size}").ravel()

    def merge(self, other: "SuffixArray", size: int) -> "SuffixArray":
        both = {c: np.concatenate([getattr(self, c), getattr(other, c)]) for c in self.KINDS}
        both["start"] = np.concatenate([self.start, other.start + np.int32(len(self.text))])
        both["sa"] = np.concatenate([self.sa, other.sa + np.int32(len(self.text))])
        out = SuffixArray(**both)
        # two sorted runs: the stable sort merges them
        out.sa = out.sa[np.argsort(np.concatenate([self.keys(size), other.keys(size)]), kind="stable")]
        return out

    def spans(self, hit: np.ndarray, size: int) -> list[np.ndarray]:
        """Byte ranges (doc, th, tk, s, e) of the matching windows, runs joined, classes of two or more left out."""
        p = np.sort(self.sa[hit].astype(np.int64))
        seg = np.searchsorted(self.start, p, side="right") - 1
        p, seg = p[~self.multi[seg]], seg[~self.multi[seg]]
        if not len(p):
            return [np.zeros(0, np.int64)] * 5
        new = np.append(True, (np.diff(p) != 1) | (np.diff(seg) != 0))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(p)) - 1
        g = seg[first]
        off = self.lo[g].astype(np.int64) - self.start[g]
        return [self.doc[g], self.th[g], self.tk[g], p[first] + off, p[last] + off + size]


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of sorted ``a`` are in sorted ``b``."""
    if not len(b):
        return np.zeros(len(a), bool)
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return b[at] == a


def merge_scan(new: SuffixArray | None, old: dict[int, SuffixArray], size: int) -> list[np.ndarray]:
    """Matches of a new suffix array within itself and with every level, on both sides."""
    found = []
    if new is not None:
        keys = new.keys(size)
        same = np.zeros(len(keys) + 1, bool)
        same[1:-1] = keys[1:] == keys[:-1]
        hit = same[1:] | same[:-1]
        for level in old.values():
            theirs = level.keys(size)
            hit |= _common(keys, theirs)
            found.append(level.spans(_common(theirs, keys), size))
        found.append(new.spans(hit, size))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64)] * 5


class SuffixIndex:
    """Levels of suffix arrays, one row per bucket; level k holds 2^k batches."""

    def __init__(self, ws: Workspace, size: int = SIZE):
        self.ws, self.size = ws, size
        self.levels: dict[int, DataFrame] = {}

    def add(self, batch: DataFrame) -> DataFrame:
        """Index a batch (bucket, bytes, doc, th, tk, lo, n, multi) and return the byte ranges it makes repeats."""
        size, target = self.size, 0
        while target in self.levels:
            target += 1
        fields = T.StructType([*LEVEL.fields, *SPANS.fields])

        def step(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
            bucket = int((new if len(new) else old)["bucket"].iloc[0])
            run = SuffixArray.build(new, size) if len(new) else None
            levels = {r.level: SuffixArray.load(r) for r in old.itertuples()}
            spans = merge_scan(run, levels, size)
            carry = run
            for k in range(target):
                if k in levels:
                    carry = levels[k] if carry is None else carry.merge(levels[k], size)
            row = dict.fromkeys(fields.names) | {"bucket": bucket, "level": target} | (carry.row() if carry is not None else {})
            return pd.DataFrame([row | dict(zip(SPANS.names, (c.astype(np.int64).tobytes() for c in spans)))])[fields.names]

        batch = batch.groupBy("bucket")
        old = None
        for t in self.levels.values():
            t = t.select(*LEVEL.names).filter("text is not null")
            old = t if old is None else old.union(t)
        if old is None:
            done = batch.applyInPandas(lambda pdf: step(pdf, pd.DataFrame()), fields)
        else:
            done = batch.cogroup(old.groupBy("bucket")).applyInPandas(step, fields)
        done = self.ws.stage(done, f"level{target}")
        spans = self.ws.stage(done.select(*SPANS.names).mapInArrow(unpack_spans, RANGES), "level-matches")
        self.ws.release(*[self.levels.pop(k) for k in range(target)])  # merged into the new level
        self.levels[target] = done
        return spans

    def close(self) -> None:
        """Delete the levels."""
        self.ws.release(*self.levels.values())
        self.levels.clear()


def unpack_spans(batches):
    schema = to_arrow_schema(RANGES)
    for b in batches:
        cols = [np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in b.column(c)] or [np.zeros(0, np.int64)]) for c in SPANS.names]
        yield V.record_batch(schema, doc=cols[0], th=cols[1], tk=cols[2], s=cols[3].astype(np.int32), e=cols[4].astype(np.int32))


def removed(schema: T.StructType):
    """Task: bytes outside the spans."""
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            kept, size, gone, runs = [], [], [], []
            for i, j, buf, offs in V.text_chunks(b.column("text"), CHUNK):
                row, f = V.list_column(b.column("__spans"), i, j)
                doc = np.repeat(np.arange(j - i), np.diff(offs))
                cut = V.spans_mask(len(buf), offs[row] + f["s"], offs[row] + f["e"]) if len(row) else np.zeros(len(buf), bool)
                before = np.zeros(len(buf), bool)
                before[1:] = cut[:-1]
                before[offs[:-1][offs[:-1] < len(buf)]] = False
                size.append(np.diff(offs))
                gone.append(np.bincount(doc[cut], minlength=j - i))
                runs.append(np.bincount(doc[cut & ~before], minlength=j - i))
                ends = np.concatenate(([0], np.cumsum(size[-1] - gone[-1]))).astype(np.int64)
                kept.append(pa.Array.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer(ends), pa.py_buffer(buf[~cut])]))
            if kept:
                cols = {c: b.column(c) for c in b.schema.names}
                cols |= {"kept": pa.concat_arrays(kept).cast(arrow.field("kept").type), "n_bytes": np.concatenate(size),
                         "n_removed": np.concatenate(gone), "n_spans": np.concatenate(runs)}
                yield V.record_batch(arrow, **{f.name: cols[f.name] for f in arrow})
    return run


def repeat_spans(ws: Workspace, keyed: DataFrame, size: int = SIZE, gram: int = GRAM, n_batches: int = BATCHES) -> DataFrame:
    """(doc, th, tk, spans) of every document with repeated bytes; spans are byte ranges [s, e)."""
    segs = ws.stage(keyed.mapInArrow(byte_segments(size, gram), SEGMENTS), "segments")
    twice = segs.groupBy("anchor").agg(F.count(F.lit(1)).alias("c"), F.min("seg").alias("s0"), F.max("seg").alias("s1"))
    twice = ws.stage(twice.filter("c > 1").select("anchor", (F.col("s0") != F.col("s1")).alias("mixed")), "anchors")
    kept = ws.stage(segs.join(twice, "anchor"), "candidates")
    ws.release(segs, twice)
    classes = kept.groupBy("anchor", "seg", "mixed").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc", "th", "tk", "lo")).alias("at"),
                                                         F.min("n").alias("n"))
    classes = ws.stage(classes, "classes")
    whole = ws.stage(kept.join(classes.filter("c > 1").select("anchor", "seg"), ["anchor", "seg"])
                     .select("doc", "th", "tk", F.col("lo").alias("s"), (F.col("lo") + F.col("n") + (size - 1)).alias("e")), "whole")
    mixed = classes.filter("mixed").select("anchor", "at.*", "n", (F.col("c") > 1).alias("multi"))
    crowd = ws.stage(mixed.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > HOT).select("anchor", F.lit(True).alias("h")), "hot")
    mixed = mixed.join(crowd, "anchor", "left").withColumn("hot", F.coalesce("h", F.lit(False)))
    wanted = mixed.groupBy("doc", "th", "tk").agg(F.collect_list(F.struct("anchor", "lo", "n", "multi", "hot")).alias("wanted"))
    wanted = keyed.join(wanted.withColumnsRenamed(dict(zip(("doc", "th", "tk"), ROW))), ROW)
    entries = ws.stage(wanted.mapInArrow(wanted_bytes(size), ENTRIES), "entries")
    ws.release(kept, classes, crowd)

    cold, hot = entries.filter("bytes is not null"), entries.filter("bytes is null")
    total = cold.agg(F.sum(F.col("n") + (size - 1)).alias("b")).first()["b"] or 0
    buckets = max(1, -(-total // BUCKET_BYTES))
    cold = cold.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
    index, found = SuffixIndex(ws, size), whole
    for k in range(n_batches if total else 0):
        batch = cold.filter(F.pmod(F.xxhash64("doc"), F.lit(n_batches)) == k).drop("anchor", "win")
        found = found.union(index.add(batch))
    index.close()
    again = ws.stage(hot.groupBy("anchor", "win").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"), "hot-windows")
    found = found.union(hot.join(again, ["anchor", "win"]).select("doc", "th", "tk", F.col("lo").alias("s"), (F.col("lo") + size).alias("e")))
    out = ws.stage(found.groupBy("doc", "th", "tk").agg(F.collect_set(F.struct("s", "e")).alias("__spans")), "spans")
    ws.release(entries, whole)
    return out


def remove_repeats(ws: Workspace, docs: DataFrame, size: int = SIZE, n_batches: int = BATCHES) -> DataFrame:
    """``docs`` with ``kept`` (the bytes left) in place of ``text``, and n_bytes, n_removed and n_spans."""
    docs = docs.drop("n_bytes", "n_removed", "n_spans", "kept", *ROW)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1))
    base = docs.withColumns(dict(zip(ROW, (key, *text_key(F.col("doc_id"), F.col("text"))))))
    spans = repeat_spans(ws, base.select(*ROW, "text"), size, n_batches=n_batches)
    joined = base.join(spans.withColumnsRenamed(dict(zip(("doc", "th", "tk"), ROW))), ROW, "left").select(*docs.columns, "__spans")
    schema = T.StructType([*[f for f in docs.schema.fields if f.name != "text"], *V.struct(
        "n_bytes long, n_removed long, n_spans long, kept binary").fields])
    return joined.mapInArrow(removed(schema), schema)
