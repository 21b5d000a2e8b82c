"""Array helpers for tasks: texts of an Arrow batch as bytes, words and window hashes.

Everything works on chunks of whole documents of about ``CHUNK`` bytes, so a
task's memory follows the chunk (or its longest document), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

CHUNK = 1 << 19
U = np.uint64
_MULT = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=U) * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_pows: dict[str, np.ndarray] = {}


def _grown(name: str, base: int, n: int) -> np.ndarray:
    have = _pows.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 12), base, U)
        steps[0] = 1
        _pows[name] = have = np.cumprod(steps)
    return have[:n]


def powers(n: int) -> np.ndarray:
    return _grown("up", _MULT, n)


def inverse_powers(n: int) -> np.ndarray:
    return _grown("down", pow(_MULT, -1, 1 << 64), n)


def mix(x: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def text_chunks(col: pa.Array, chunk: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of runs of whole texts; null as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    n = len(col)
    if not n:
        return
    kind = np.int64 if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type) else np.int32
    _, offs, data = col.buffers()
    offs = np.frombuffer(offs, kind)[col.offset: col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + chunk, side="right")) - 1)
        yield i, j, data[offs[i]: offs[j]], offs[i: j + 1] - offs[i]
        i = j


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    return buf + ((buf >= 65) & (buf <= 90)) * np.uint8(32)


def words(buf: np.ndarray, offs: np.ndarray):
    """Starts, ends and document numbers of the maximal non-space runs; none crosses documents."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~SPACE[buf]
    before = np.empty(n, bool)
    before[0], before[1:] = False, ink[:-1]
    before[offs[:-1][offs[:-1] < n]] = False
    after = np.empty(n, bool)
    after[-1], after[:-1] = False, ink[1:]
    after[offs[1:][offs[1:] > 0] - 1] = False
    starts, ends = np.flatnonzero(ink & ~before), np.flatnonzero(ink & ~after) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def word_bytes(starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all bytes of the words, and each byte's offset in its word."""
    at = np.cumsum(lens) - lens
    off = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(at, lens)
    return np.repeat(starts, lens) + off, off


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, U)
    lens = ends - starts
    pos, off = word_bytes(starts, lens)
    vals = _TABLE[buf[pos]] * powers(int(lens.max()))[off]
    return mix(np.add.reduceat(vals, np.cumsum(lens) - lens) + lens.astype(U))


class Rolling:
    """Hashes of any run of a sequence of 64-bit values, from one prefix sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, U)
        np.cumsum(values * powers(n), out=self.sums[1:])
        self.down = inverse_powers(n + 1)

    @classmethod
    def of_bytes(cls, buf: np.ndarray) -> "Rolling":
        return cls(_TABLE[buf])

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U))

    def windows(self, length: int) -> np.ndarray:
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, U)
        return mix((self.sums[length:] - self.sums[:-length]) * self.down[:n] + U(length))


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (leftmost of equals) in each window of ``width``."""
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = max(1, int(n - 1).bit_length())
    low = U((1 << bits) - 1)
    packed = (values & ~low) | np.arange(n, dtype=U)
    full = np.full(-(-n // width) * width, np.iinfo(U).max, U)
    full[:n] = packed
    full = full.reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - width + 1
    return (np.minimum(behind[:m], ahead[width - 1: width - 1 + m]) & low).astype(np.int64)


def anchored_runs(valid: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, last window and anchor of the runs of valid windows that share an anchor."""
    if not len(valid):
        z = np.zeros(0, np.int64)
        return z, z, z
    a = anchor[valid]
    new = np.empty(len(valid), bool)
    new[0] = True
    new[1:] = (np.diff(valid) != 1) | (np.diff(a) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(valid)) - 1
    return valid[first], valid[last], a[first]


def spans_mask(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of ``size`` places the half-open spans cover."""
    d = np.zeros(size + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def list_column(col: pa.Array, i: int, j: int):
    """Rows i..j of a list<struct> column: the row of each item and the items' fields (no row: null list)."""
    part = col.slice(i, j - i)
    if isinstance(part, pa.ChunkedArray):
        part = part.combine_chunks()
    lens = pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False)
    items = part.flatten()
    fields = {f.name: items.field(k).to_numpy(zero_copy_only=False) for k, f in enumerate(items.type)}
    return np.repeat(np.arange(j - i), lens), fields


def record_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c := cols[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema)


def struct(fields: str) -> T.StructType:
    """'a long, b int' as a schema; needs no session, so tasks can import it."""
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
             "binary": T.BinaryType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split() for f in fields.split(","))])
