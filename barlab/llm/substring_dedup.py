"""Substring dedup by level-wise doubling of word windows.

A window of ``min_words`` words that also starts in a document of smaller id is
a repeat; every word a repeat covers is removed. Windows are not all counted:

1. Length ``min_words / 2``: of the short windows inside each long one the one
   of smallest hash stands for it, so equal long windows share their short one
   and only about one short window in ``min_words / 4`` is counted.
2. Windows that repeat at that length alone, in two documents, are extended to
   twice the length: all long windows they stand for make one segment. Segments
   with equal content form a class; in every document but the class's first, the
   whole segment is a repeat. Only where a short window stands in segments of
   different content are the long windows counted one by one, and of each class
   only its first document's.

No candidates are left at the next doubling: longer windows cover no further
word. Windows are told apart by two 64-bit hashes (the short window and the long
one). Groups of equal windows are reduced by partial aggregates, and joins back
to their occurrences read stage tables on both sides, so AQE splits hot ones.

Edge cases: null text has no words; null ``doc_id`` counts as larger than any
other; rows of equal ``doc_id`` are one document for "smaller", so none removes
from the other; texts shorter than ``min_words`` stay; an empty table gives no
rows; other columns pass through, columns named ``n_words`` or ``n_removed`` are
replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barlab.llm import vectors as V
from barlab.llm.workspace import Workspace, text_key

MIN_WORDS = 50
LAST = (1 << 63) - 1
#: A row: its id as a number, null as the largest, and two hashes of its text.
ROW = ["__doc", "__text", "__text2"]

SHORT = V.struct("anchor long, seg long, doc long, th long, tk long, lo int, n int")
LONG = V.struct("anchor long, win long, doc long, th long, tk long, pos int")


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def _document_words(buf, offs):
    starts, ends, doc = V.words(buf, offs)
    first = np.searchsorted(doc, np.arange(len(offs) - 1))
    return starts, ends, doc, first


def short_windows(min_words: int):
    """Task: the segments of long windows that share a short one."""
    schema, half = _arrow(SHORT), min_words // 2

    def run(batches):
        for b in batches:
            docs, hashes, more = (b.column(c).to_numpy() for c in ROW)
            for i, j, buf, offs in V.text_chunks(b.column("text")):
                starts, ends, doc, first = _document_words(buf, offs)
                n = len(starts)
                if n < min_words:
                    continue
                roll = V.Rolling(V.word_hashes(buf, starts, ends))
                short = roll.windows(half)
                anchor = V.sliding_argmin(short, min_words - half + 1)
                valid = np.flatnonzero(doc[: n - min_words + 1] == doc[min_words - 1:])
                lo, hi, a = V.anchored_runs(valid, anchor)
                if not len(lo):
                    continue
                seg = V.mix(roll.runs(lo, hi + min_words) + (a - lo).astype(V.U) * V.U(0x9E3779B97F4A7C15))
                d = doc[lo]
                yield V.record_batch(schema, anchor=short[a].view(np.int64), seg=seg.view(np.int64), doc=docs[i + d],
                                     th=hashes[i + d], tk=more[i + d],
                                     lo=(lo - first[d]).astype(np.int32), n=(hi - lo + 1).astype(np.int32))
    return run


def long_windows(min_words: int):
    """Task: every long window of the wanted segments."""
    schema = _arrow(LONG)

    def run(batches):
        for b in batches:
            (docs, hashes, more), wanted = (b.column(c).to_numpy() for c in ROW), b.column("wanted")
            for i, j, buf, offs in V.text_chunks(b.column("text")):
                starts, ends, doc, first = _document_words(buf, offs)
                row, f = V.list_column(wanted, i, j)
                if not len(row):
                    continue
                roll = V.Rolling(V.word_hashes(buf, starts, ends))
                row, (at, off) = np.repeat(row, f["n"]), V.word_bytes(f["lo"].astype(np.int64), f["n"].astype(np.int64))
                lo = first[row] + at
                yield V.record_batch(schema, anchor=np.repeat(f["anchor"], f["n"]), doc=docs[i + row], th=hashes[i + row], tk=more[i + row],
                                     win=roll.runs(lo, lo + min_words).view(np.int64), pos=at.astype(np.int32))
    return run


def removed(text_col: str, schema: T.StructType, keep_layout: bool):
    """Task: words outside the spans, joined by one space; with ``keep_layout``, texts without spans as they are."""
    arrow = _arrow(schema)

    def run(batches):
        for b in batches:
            texts, sizes, gone = [], [], []
            for i, j, buf, offs in V.text_chunks(b.column(text_col)):
                starts, ends, doc, first = _document_words(buf, offs)
                row, f = V.list_column(b.column("__spans"), i, j)
                if len(row):
                    cut = V.spans_mask(len(starts), first[row] + f["s"], first[row] + f["e"])
                else:
                    cut = np.zeros(len(starts), bool)
                sizes.append(np.bincount(doc, minlength=j - i))
                gone.append(np.bincount(doc[cut], minlength=j - i))
                ks, ke, kd = starts[~cut], ends[~cut], doc[~cut]
                lens = ke - ks
                gap = np.ones(len(ks), np.int64)
                gap[:1] = 0
                gap[1:] = kd[1:] == kd[:-1]
                pos, off = V.word_bytes(ks, lens)
                out = np.full(int(lens.sum() + gap.sum()), 32, np.uint8)
                out[np.repeat(np.cumsum(lens + gap) - lens, lens) + off] = buf[pos]
                size = np.bincount(kd, weights=lens + gap, minlength=j - i).astype(np.int64)
                ends_at = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
                if keep_layout:
                    same = gone[-1] == 0
                    out = np.concatenate([buf[offs[d]: offs[d + 1]] if same[d] else out[ends_at[d]: ends_at[d + 1]]
                                          for d in range(j - i)])
                    size = np.where(same, np.diff(offs), size)
                    ends_at = np.concatenate(([0], np.cumsum(size))).astype(np.int64)
                texts.append(pa.Array.from_buffers(pa.large_string(), j - i, [None, pa.py_buffer(ends_at), pa.py_buffer(out)]))
            if texts:
                cols = {c: b.column(c) for c in b.schema.names}
                cols |= {text_col: pa.concat_arrays(texts).cast(arrow.field(text_col).type),
                         "n_words": np.concatenate(sizes), "n_removed": np.concatenate(gone)}
                yield V.record_batch(arrow, **{f.name: cols[f.name] for f in arrow})
    return run


def repeat_spans(ws: Workspace, keyed: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, th, tk, spans) of every document with repeats; spans are word ranges [s, e)."""
    short = ws.stage(keyed.mapInArrow(short_windows(min_words), SHORT), "short")
    repeated = short.groupBy("anchor").agg(F.min("doc").alias("d0"), F.max("doc").alias("d1"),
                                           F.min("seg").alias("s0"), F.max("seg").alias("s1"))
    repeated = ws.stage(repeated.filter("d0 < d1").select("anchor", (F.col("s0") != F.col("s1")).alias("mixed")), "repeated")
    kept = ws.stage(short.join(repeated, "anchor"), "candidates")
    ws.release(short, repeated)
    classes = ws.stage(kept.groupBy("anchor", "seg").agg(F.min("doc").alias("first")), "classes")
    judged = ws.stage(kept.join(classes, ["anchor", "seg"]).filter("mixed or doc > first")
                      .select("doc", "th", "tk", "lo", "n", "anchor", (F.col("doc") > F.col("first")).alias("whole")), "judged")
    ws.release(kept, classes)
    wanted = judged.filter("not whole").groupBy("doc", "th", "tk").agg(F.collect_set(F.struct("lo", "n", "anchor")).alias("wanted"))
    wanted = keyed.join(wanted.withColumnsRenamed(dict(zip(("doc", "th", "tk"), ROW))), ROW)
    windows = ws.stage(wanted.mapInArrow(long_windows(min_words), LONG), "long")
    first = windows.groupBy("anchor", "win").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    first = ws.stage(first.filter("first < last").drop("last"), "repeated-long")
    single = windows.join(first, ["anchor", "win"]).filter("doc > first").select(
        "doc", "th", "tk", F.col("pos").alias("s"), (F.col("pos") + min_words).alias("e"))
    whole = judged.filter("whole").select("doc", "th", "tk", F.col("lo").alias("s"), (F.col("lo") + F.col("n") + (min_words - 1)).alias("e"))
    spans = whole.union(single).groupBy("doc", "th", "tk").agg(F.collect_set(F.struct("s", "e")).alias("__spans"))
    out = ws.stage(spans, "spans")
    ws.release(windows, first, judged)
    return out


def remove_repeats(ws: Workspace, docs: DataFrame, min_words: int = MIN_WORDS, keep_layout: bool = False) -> DataFrame:
    """``docs`` with ``text`` less its repeats, and ``n_words`` and ``n_removed``.

    Kept words are joined by one space; ``keep_layout`` leaves texts without
    repeats as they are (null becomes empty).
    """
    docs = docs.drop("n_words", "n_removed", *ROW)
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    base = docs.withColumns(dict(zip(ROW, (key, *text_key(F.col("doc_id"), F.col("text"))))))
    spans = repeat_spans(ws, base.select(*ROW, "text"), min_words)
    joined = base.join(spans.withColumnsRenamed(dict(zip(("doc", "th", "tk"), ROW))), ROW, "left").select(*docs.columns, "__spans")
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    return joined.mapInArrow(removed("text", schema, keep_layout), schema)
