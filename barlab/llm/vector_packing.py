"""Best-fit packing with vector capacities.

Documents are tokenized and closed by an end id; only those longer than a
sequence are cut, so that all pieces but the first are full. A piece asks for
(tokens, one document, tokens squared as attention cost); a sequence offers
``Capacity``. Pieces go longest first to the sequence that has room in every
dimension and, of those, the smallest weighted residual norm (or the largest
weighted dot product of request and residual); without one, a sequence is opened.

Packing runs in hash groups of about ``GROUP_PIECES`` pieces (some hundred KB of
integers), as many as the input asks for; a group wastes at most its last
sequences, some in ten thousand. Tokens don't shuffle: what is staged is one
short row per piece.

Ids are those of the tokenizer file. Space-separated parts of a text are
encoded once per worker and remembered (a part starts with its space; the split
pattern of the vocabulary never joins ink with the space behind it), which holds
where every space is followed by ink; other texts are encoded whole.

Edge cases: null and empty texts are one end id; repeated rows are packed each;
an empty table gives no rows; with zero-length or negative capacities there is
no packing (ValueError); only doc_id and text are read.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from barlab.llm import vectors as V
from barlab.llm.workspace import Workspace

TOKENIZER = "byte_bpe_50k"
SPECIAL = "<|endoftext|>"
END_ID = 0
GROUP_PIECES = 16_384
#: Remembered parts per worker (about 200 bytes each).
CACHE_PARTS = 400_000

PIECES = V.struct("doc_id long, piece int, start long, length long, ids_crc32 long")
PACKED = V.struct("doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


@dataclass(frozen=True)
class Capacity:
    """What a sequence offers and how its dimensions weigh in the choice.

    The defaults of documents and cost never bind: a piece has a token or more,
    and squares of lengths add up to less than the square of their sum.
    """

    tokens: int = 2048
    documents: int = 2048
    cost: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    by: str = "norm"

    def __post_init__(self):
        if min(self.tokens, self.documents, self.cost) < 1 or self.by not in ("norm", "dot"):
            raise ValueError("capacities must be positive and by one of norm, dot")


class _Encoder:
    def __init__(self, ranks_path: str, json_path: str):
        import tiktoken
        from tokenizers import Tokenizer

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("parts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                        special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_file(json_path)
        self.odd = re.compile(r" \s| \Z")
        self.seen: dict[str, bytes] = {}
        outer = self

        class Parts(dict):
            def __missing__(self, part: str) -> bytes:
                if len(self) >= CACHE_PARTS:
                    self.clear()
                self[part] = ids = np.array(outer.encode(" " + part), "<u4").tobytes()
                return ids

        self.parts = Parts()

    def ids(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if self.odd.search(text):
            return np.array(self.encode(text), "<u4").tobytes()
        first, *rest = text.split(" ")
        return np.array(self.encode(first), "<u4").tobytes() + b"".join(map(self.parts.__getitem__, rest))


@functools.lru_cache(maxsize=2)
def encoder(ranks_path: str, json_path: str) -> _Encoder:
    return _Encoder(ranks_path, json_path)


def cut_pieces(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; the first may be shorter."""
    first = n - (-(-n // size) - 1) * size
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def tokenized(size: int, ranks_path: str, json_path: str):
    schema = to_arrow_schema(PIECES)
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        enc = encoder(ranks_path, json_path)
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                part = b.slice(k, 1000)
                rows = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = enc.ids(text or "") + end
                    for i, (s, n) in enumerate(cut_pieces(len(ids) // 4, size)):
                        rows.append((doc, i, s, n, zlib.crc32(ids[4 * s: 4 * (s + n)])))
                cols = list(zip(*rows))
                yield V.record_batch(schema, **{f.name: list(c) for f, c in zip(schema, cols)})
    return run


def best_fit(lengths: np.ndarray, cap: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; ``lengths`` in falling order."""
    top = np.array([cap.tokens, cap.documents, cap.cost], np.float64)
    weight = np.array(cap.weights) / top ** 2
    left = np.empty((3, 1024), np.float64)  # residuals of the open sequences
    name = np.empty(1024, np.int64)
    n_open = n_seq = 0
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    smallest = lengths[-1] if len(lengths) else 0
    for i, t in enumerate(lengths.tolist()):
        ask = np.array([t, 1.0, float(t) * t])
        rest = left[:, :n_open] - ask[:, None]
        fits = np.flatnonzero((rest >= 0).all(axis=0))
        if len(fits):
            r = rest[:, fits]
            if cap.by == "norm":
                best = fits[np.argmin(weight @ (r * r))]
            else:
                best = fits[np.argmax((weight * ask) @ (r + ask[:, None]))]
        else:
            if n_open == left.shape[1]:
                left, name = np.concatenate([left, np.empty_like(left)], axis=1), np.concatenate([name, np.empty_like(name)])
            best = n_open
            left[:, best], name[best] = np.maximum(top, ask), n_seq
            n_open, n_seq = n_open + 1, n_seq + 1
        seq[i], offset[i] = name[best], cap.tokens - left[0, best]
        left[:, best] -= ask
        if left[0, best] < smallest or left[1, best] < 1 or left[2, best] < smallest * smallest:
            n_open -= 1  # closed: the last open one takes its place
            left[:, best], name[best] = left[:, n_open], name[n_open]
    return seq, offset


def pack(ws: Workspace, docs: DataFrame, cap: Capacity = Capacity(), ranks_path: str | None = None,
         json_path: str | None = None) -> DataFrame:
    """Pieces with their place: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    ranks_path = ranks_path or public_tokenizers.path(f"{TOKENIZER}.tiktoken")
    json_path = json_path or public_tokenizers.path(f"{TOKENIZER}.json")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = ws.stage(texts.mapInArrow(tokenized(cap.tokens, ranks_path, json_path), PIECES), "pieces")
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id(), "doc_id", "piece", "ids_crc32"), F.lit(groups))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True])
        seq, offset = best_fit(pdf["length"].to_numpy(), cap)
        return pdf.assign(sequence_id=(pdf["group"].to_numpy() << 32) + seq, offset=offset)[PACKED.names]

    return pieces.withColumn("group", spread).groupBy("group").applyInPandas(place, PACKED)
