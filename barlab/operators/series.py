"""Blocked layout for ordered per-key series (the shape every indicator runs on).

A naive ``Window.partitionBy(key).orderBy(t)`` puts a whole series in one task;
if one key holds a third of all rows, that task holds a third of the data.
Here a series is cut into blocks of ``block_rows`` rows and each block also
receives copies of the ``back`` rows before it and ``ahead`` rows after it
(the halo). Windows are partitioned by ``(key, block)``: every bounded-frame
function (lag, lead, rolling n) is exact for the block's own rows as long as
the halo covers its reach, and a hot key spreads over ``n / block_rows`` tasks.

Row numbers come from per-(key, time segment) counts and a prefix sum over
that small table, so numbering needs no key-wide sort either.

Columns added: ``_rn`` row number in the series (0-based), ``_n`` series
length, ``_blk`` block id, ``_native`` (row belongs to this block, not halo),
``_u`` position inside the block's visible range, ``_sub`` sub-block of ``_u``
(used by the exponential smoother), ``_hand`` (the last row that the next block
doesn't see), ``_skey`` the key as one struct column.

All partitioning and joins use ``_skey``: a struct is never NULL and compares
NULL fields as equal, so plain equi-joins keep rows with a NULL key and the
hash partitioning of one step is reused by the next (no null-safe join
rewrite that would force an extra shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RN, NTOT, BLK, NATIVE, POS, SUB, SKEY, HAND = "_rn", "_n", "_blk", "_native", "_u", "_sub", "_skey", "_hand"
HELPERS = (RN, NTOT, BLK, NATIVE, POS, SUB, SKEY, HAND)
DEFAULT_SUB_ROWS = 256


def _as_list(x) -> list:
    return [x] if isinstance(x, str) else list(x)


def number_rows(df: DataFrame, key, order, segment: str = "year") -> DataFrame:
    """Add ``_rn`` (0-based position in ``order`` within ``key``), ``_n`` and ``_skey``.

    ``order`` may be several columns; the first one must be a date or
    timestamp and is truncated to ``segment`` to form numbering segments; rows
    where it is NULL come first. No row is lost.
    Rows per (key, segment) are bounded by the calendar, not by data volume.
    The join with the small offsets table and the row_number window share
    one hash partitioning on (``_skey``, segment).
    """
    key, order = _as_list(key), _as_list(order)
    # a struct, so rows without a date form a segment of their own, before all others
    base = df.withColumns({SKEY: F.struct(*key), "_seg": F.struct(F.date_trunc(segment, F.col(order[0])))})
    counts = base.groupBy(SKEY, "_seg").agg(F.count(F.lit(1)).alias("_cnt"))
    wk = Window.partitionBy(SKEY).orderBy("_seg")
    offsets = counts.select(
        SKEY, "_seg",
        F.coalesce(F.sum("_cnt").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(SKEY)).alias(NTOT),
    )
    joined = base.join(offsets, [SKEY, "_seg"], "inner")
    ws = Window.partitionBy(SKEY, "_seg").orderBy(*order)
    return joined.withColumn(RN, F.col("_off") + F.row_number().over(ws) - 1).drop("_seg", "_off")


def to_blocks(numbered: DataFrame, block_rows: int, back: int, ahead: int, sub_rows: int = DEFAULT_SUB_ROWS) -> DataFrame:
    """Explode each numbered row into its own block and the blocks whose halo it is in."""
    if block_rows < 1 or back < 0 or ahead < 0:
        raise ValueError("block_rows >= 1, back >= 0, ahead >= 0")
    rn = F.col(RN)
    kmin = F.greatest(F.lit(0).cast("long"), F.floor((rn - F.lit(ahead)) / F.lit(block_rows)))
    # no copies into a block past the series' last row (it would hold only halo)
    kmax = F.least(F.floor((rn + F.lit(back)) / F.lit(block_rows)), F.floor((F.col(NTOT) - 1) / F.lit(block_rows)))
    blk = F.col(BLK)
    pos = rn - F.greatest(F.lit(0).cast("long"), blk * F.lit(block_rows) - F.lit(back))
    exploded = numbered.select("*", F.explode(F.sequence(kmin, kmax)).alias(BLK))
    return exploded.select("*", (F.floor(rn / F.lit(block_rows)) == blk).alias(NATIVE), pos.alias(POS),
                           F.floor(pos / F.lit(sub_rows)).alias(SUB),
                           (rn == (blk + 1) * F.lit(block_rows) - F.lit(back) - 1).alias(HAND))


def block_window(key=None) -> Window:
    """Ordered window over one block (own rows + halo) of one key."""
    return Window.partitionBy(SKEY, BLK).orderBy(SUB, RN)


def sub_window(key=None) -> Window:
    """Ordered window over one sub-block; shares the sort of ``block_window``."""
    return Window.partitionBy(SKEY, BLK, SUB).orderBy(RN)


def whole_block() -> Window:
    return Window.partitionBy(SKEY, BLK)


def whole_sub() -> Window:
    return Window.partitionBy(SKEY, BLK, SUB)


def rows(w: Window, n: int) -> Window:
    """Frame of the current row and the ``n - 1`` before it."""
    return w.rowsBetween(-(n - 1), 0)


def full(agg, x: Column, w: Window, n: int) -> Column:
    """Rolling aggregate that is NULL until ``n`` non-null values are in the frame
    (pandas ``rolling(n)`` semantics)."""
    fw = rows(w, n)
    return F.when(F.count(x).over(fw) == n, agg(x).over(fw))


def finish(blocked: DataFrame, keep_helpers: bool = False) -> DataFrame:
    """Keep each row once (its own block) and drop layout columns."""
    out = blocked.filter(F.col(NATIVE))
    if keep_helpers:
        return out.drop(BLK, NATIVE, POS, SUB, SKEY, HAND)
    return out.drop(*HELPERS)


def blocked(df: DataFrame, key, order, block_rows: int, back: int, ahead: int,
            segment: str = "year", sub_rows: int = DEFAULT_SUB_ROWS) -> DataFrame:
    return to_blocks(number_rows(df, key, order, segment), block_rows, back, ahead, sub_rows)


def carried(b: DataFrame, cols: list[str]) -> DataFrame:
    """Columns that are running last values inside a block (halo included), with what precedes the block filled in.

    Each block hands on its value at the last row that the next block doesn't see; these
    rows tile the series, so the last of them that isn't missing is the value before a block.
    """
    hand = b.filter(F.col(HAND)).select(SKEY, BLK, *cols)
    earlier = Window.partitionBy(SKEY).orderBy(BLK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = hand.select(SKEY, (F.col(BLK) + 1).alias(BLK), *[F.last(c, ignorenulls=True).over(earlier).alias(f"_before_{c}") for c in cols])
    out = b.join(carry, [SKEY, BLK], "left").withColumns({c: F.coalesce(c, f"_before_{c}") for c in cols})
    return out.drop(*[f"_before_{c}" for c in cols])
