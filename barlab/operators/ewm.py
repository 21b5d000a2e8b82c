"""Exponential smoothing in plain columns, missing values included.

At an observation ``g`` rows after the one before it, the old value weighs
``q^g`` (q = 1 - a) against ``a`` for the new one, so

    y_t = A_t y_(t-1) + (1 - A_t) x_t,   A_t = q^g / (q^g + a)

which is ``q`` without a gap; a missing row keeps the value (A = 1), and the first
observation seeds it. Nothing is cut off by a run of missing rows, however long.

The visible rows of a block (see ``series``) are split into sub-blocks of ``S`` rows,
with ``s_t`` the running sum of ``ln A`` in the sub-block:

* ``L_t = e^s_t sum((1 - A_j) x_j e^-s_j)``, the part from the sub-block itself,
* ``E`` and ``P = e^s`` at a sub-block's last row: value and weight it hands on,
* ``Y``, the value at the end of the previous sub-block: a prefix of (E, P) over
  all sub-blocks of the block, in ``LEVELS`` rounds of ``lag``,
* ``y_t = L_t + e^s_t Y``, as if the block's first observation ``x_f`` began the series.

What precedes the block adds ``e^c_t A_f (Y0 - x_f)``, with ``c`` the running sum of
``ln A`` in the block, ``Y0`` the smoother before its first visible row and ``A_f`` the
weight by the gap from the last observation before it; rows before ``f`` hold ``Y0``.
``Y0`` comes from a table of one row per (key, block), taken at the last row that the
next block doesn't see: value, ``c``, first and last observation. There, blocks
without an observation hand on what they got, and of the others as many are
chained as ``reach(a)`` rows can span.

``s`` stays above ``S ln q`` and the ln of ``LEAST``, so nothing overflows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.operators.series import BLK, HAND, SKEY

DIGITS = 17.0          # truncated history weighs < 10^-DIGITS
LEAST = 1e-60          # weights below it count as it
LEVELS = 3
MAX_EXP_DIGITS = 150.0  # largest power of ten an in-block factor may reach


@dataclass(frozen=True)
class EwmSpec:
    out: str
    x: object              # column name or Column
    alpha: float

    @staticmethod
    def span(out: str, x, span: float) -> "EwmSpec":
        return EwmSpec(out, x, 2.0 / (span + 1.0))


def sub_rows_for(alphas, cap: int = 256) -> int:
    """Largest power-of-two sub-block keeping every in-block factor finite."""
    s = cap
    for a in alphas:
        if a >= 1.0:
            continue
        lq = -math.log10(1.0 - a)
        while s > 1 and (s - 1) * lq > MAX_EXP_DIGITS:
            s //= 2
    return s


def carries(alpha: float, sub_rows: int) -> int:
    """Number of earlier sub-blocks read so the dropped tail is below 10^-DIGITS."""
    if alpha >= 1.0:
        return 0
    lq = -math.log10(1.0 - alpha)
    return max(1, math.ceil((DIGITS + math.log10(1.0 / alpha)) / (sub_rows * lq)))


def depth(alpha: float, sub_rows: int) -> int:
    """Rows of history the smoother reads (halo it needs)."""
    return carries(alpha, sub_rows) * sub_rows


def reach(alpha: float) -> int:
    """Rows after which an old value weighs below 10^-DIGITS, wherever observations lie
    among them (at a gap of ``g`` rows ``A`` shrinks less per row than ``q``)."""
    if alpha >= 1.0:
        return 0
    lq = math.log(1.0 - alpha)
    slowest = min(math.log1p(alpha * math.exp(-g * lq)) / g for g in range(1, int(min(1e5, 100 / -lq)) + 2))
    return math.ceil(DIGITS * math.log(10.0) / slowest)


def add_ewm(df: DataFrame, key, specs: list[EwmSpec], sub_rows: int, block_rows: int = 16384,
            visible: int = 32768) -> DataFrame:
    """Add one smoothed column per spec to a blocked frame (see ``series.to_blocks``);
    NULL before the first observation. ``block_rows`` may be less than the frame's
    (more blocks are chained), ``visible`` more than a block and its halo have."""
    S = sub_rows
    wb = "(PARTITION BY _skey, _blk ORDER BY _sub, _rn)"
    upto = "(PARTITION BY _skey, _blk ORDER BY _sub, _rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    per_key = "(PARTITION BY _skey ORDER BY _blk)"
    before = "(PARTITION BY _skey, _blk ORDER BY _sub, _rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    run = "(PARTITION BY _skey, _blk, _sub ORDER BY _rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    whole = "(PARTITION BY _skey, _blk, _sub)"

    def D(v: float) -> str:  # exact double literal
        return f"{float(v)!r}D"

    def weight(sp: EwmSpec, g: str) -> str:
        a, q = sp.alpha, 1.0 - sp.alpha
        return f"CASE WHEN {g} = 1 THEN {D(q)} ELSE greatest(pow({D(q)}, {g}) / (pow({D(q)}, {g}) + {D(a)}), {D(LEAST)}) END"

    def add(frame: DataFrame, exprs: dict[str, str]) -> DataFrame:
        return frame.withColumns({k: F.expr(v) for k, v in exprs.items()}) if exprs else frame

    stage = df
    names = {}
    for i, sp in enumerate(specs):
        if isinstance(sp.x, str):
            names[i] = sp.x
        else:  # a Column: give it a name first
            names[i] = f"_e{i}_in"
            stage = stage.withColumn(names[i], sp.x)
    smooth = {i: sp for i, sp in enumerate(specs) if sp.alpha < 1.0}
    stage = add(stage, {f"_e{i}_x": f"CAST({x} AS DOUBLE)" for i, x in names.items()})
    stage = add(stage, {f"_e{i}_g": f"_u - last(CASE WHEN _e{i}_x IS NOT NULL THEN _u END, true) OVER {before}" for i in smooth})
    weights = {}
    for i, sp in smooth.items():
        old = weight(sp, f"_e{i}_g")
        weights[f"_e{i}_a"] = f"CASE WHEN _e{i}_x IS NOT NULL AND _e{i}_g IS NOT NULL THEN {old} END"
    stage = add(stage, weights)
    stage = add(stage, {f"_e{i}_s": f"coalesce(sum(ln(_e{i}_a)) OVER {run}, 0.0D)" for i in smooth})
    stage = add(stage, {f"_e{i}_b": f"coalesce((1 - coalesce(_e{i}_a, 0.0D)) * _e{i}_x, 0.0D) * exp(-_e{i}_s)" for i in smooth})
    sums = {}
    for i in smooth:
        sums[f"_e{i}_L"] = f"exp(_e{i}_s) * sum(_e{i}_b) OVER {run}"
        sums[f"_e{i}_P"] = f"exp(min(_e{i}_s) OVER {whole})"  # ln A is never positive: the last is the least
        sums[f"_e{i}_T"] = f"sum(_e{i}_b) OVER {whole}"
    stage = add(stage, sums)
    stage = add(stage, {f"_e{i}_E": f"_e{i}_P * _e{i}_T" for i in smooth})
    subs = -(-visible // S) + 1
    radix = next(r for r in range(2, subs + 2) if r ** LEVELS >= subs)
    for level in range(LEVELS):
        joined = {}
        for i in smooth:
            e, p = "0.0D", "1.0D"
            for j in range(radix - 1, 0, -1):
                le, lp = (f"coalesce(lag(_e{i}_{c}, {j * radix ** level * S}) OVER {wb}, 0.0D)" for c in "EP")
                e, p = f"({le} + {lp} * {e})", f"{lp} * {p}"
            joined[f"_e{i}_E"] = f"_e{i}_E + _e{i}_P * {e}"
            joined[f"_e{i}_P"] = f"_e{i}_P * {p}"
        stage = add(stage, joined)
    local = {}
    for i, sp in enumerate(specs):
        local[f"_e{i}_y"] = (f"CASE WHEN count(_e{i}_x) OVER {upto} > 0 THEN _e{i}_L + exp(_e{i}_s) * coalesce(lag(_e{i}_E, {S}) OVER {wb}, 0.0D) END"
                             if i in smooth else f"last(_e{i}_x, true) OVER {upto}")
        local[f"_e{i}_c"] = f"coalesce(sum(ln(_e{i}_a)) OVER {upto}, 0.0D)" if i in smooth else "0.0D"
        local[f"_e{i}_xf"] = f"first(_e{i}_x, true) OVER {upto}"
        local[f"_e{i}_f"] = f"first(CASE WHEN _e{i}_x IS NOT NULL THEN _rn END, true) OVER {upto}"
        local[f"_e{i}_l"] = f"last(CASE WHEN _e{i}_x IS NOT NULL THEN _rn END, true) OVER {upto}"
    stage = add(stage, local)

    # what each block hands on, then what each block gets
    hand = stage.filter(HAND).select(SKEY, BLK, *[
        F.expr(f"CASE WHEN _e{i}_l IS NOT NULL THEN struct(_e{i}_y AS y, _e{i}_c AS c, _e{i}_xf AS xf, _e{i}_f AS f, _e{i}_l AS l) END").alias(f"_h{i}")
        for i in range(len(specs))])
    hand = add(hand, {f"_h{i}_b": f"lag(_h{i}.l, 1) IGNORE NULLS OVER {per_key}" for i in range(len(specs))})
    hand = add(hand, {f"_h{i}_w": f"CASE WHEN _h{i}_b IS NULL THEN 0.0D ELSE exp(_h{i}.c) * {weight(sp, f'(_h{i}.f - _h{i}_b)')} END" if i in smooth else "0.0D"
                      for i, sp in enumerate(specs)})
    hand = add(hand, {f"_h{i}_m": f"CASE WHEN _h{i} IS NOT NULL THEN struct(_h{i}_w AS w, _h{i}.y - _h{i}_w * _h{i}.xf AS d) END" for i in range(len(specs))})
    ends = {}
    for i, sp in enumerate(specs):
        prev = "0.0D"
        for j in range(-(-reach(sp.alpha) // block_rows) + 2, 0, -1):
            m = f"lag(_h{i}_m, {j}) IGNORE NULLS OVER {per_key}"
            prev = f"(coalesce(({m}).d, 0.0D) + coalesce(({m}).w, 0.0D) * {prev})"
        ends[f"_h{i}_y"] = f"CASE WHEN _h{i} IS NOT NULL THEN _h{i}_m.d + _h{i}_m.w * {prev} END"
    hand = add(hand, ends)
    carry = hand.select(SKEY, (F.col(BLK) + 1).alias(BLK), *[F.expr(f"last({v}, true) OVER {per_key}").alias(f"_e{i}_{k}")
                                                             for i in range(len(specs)) for v, k in ((f"_h{i}_y", "y0"), (f"_h{i}.l", "l0"))])
    stage = stage.join(carry, [SKEY, BLK], "left")
    outs = {}
    for i, sp in enumerate(specs):
        more = f"coalesce(exp(_e{i}_c) * {weight(sp, f'(_e{i}_f - _e{i}_l0)')} * (_e{i}_y0 - _e{i}_xf), 0.0D)" if i in smooth else "0.0D"
        outs[sp.out] = f"CASE WHEN _e{i}_y IS NOT NULL THEN _e{i}_y + {more} ELSE _e{i}_y0 END"
    stage = add(stage, outs)
    tmp = [c for c in stage.columns if c.startswith("_e") and c.split("_")[1][1:].isdigit()]
    return stage.drop(*tmp)


def ewm_series_pandas(values, alpha: float):
    """Reference recursion (pandas ``ewm(alpha, adjust=False).mean()``) for tests."""
    import pandas as pd

    return pd.Series(values, dtype="float64").ewm(alpha=alpha, adjust=False).mean().to_numpy()


def ewm_column(df: DataFrame, x: str, out: str, alpha: float | None = None, span: float | None = None,
               key=("ticker",), order: str = "bar_date", block_rows: int = 16384, segment: str = "year") -> DataFrame:
    """D6 as a stand-alone operator: smooth one column per key in row order."""
    from barlab.operators.series import blocked, finish

    if alpha is None:
        if span is None:
            raise ValueError("give alpha or span")
        alpha = 2.0 / (span + 1.0)
    s = sub_rows_for([alpha])
    b = blocked(df, list(key), order, block_rows, back=depth(alpha, s), ahead=0, segment=segment, sub_rows=s)
    return finish(add_ewm(b, list(key), [EwmSpec(out, x, alpha)], s, block_rows, block_rows + depth(alpha, s)))
