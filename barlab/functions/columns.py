"""Column helpers implementing the missing-value contract.

* Missing is SQL NULL everywhere; NaN and +/-inf never circulate.
* Every division is ``try_divide``: a zero divisor gives NULL (Spark 4 runs in
  ANSI mode, where ``/`` raises on zero even for doubles).
* A boolean flag is ``coalesce(cond, false)`` as int: a comparison with a
  missing value counts as false, as pandas does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tdiv(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL."""
    return F.try_divide(col(a), col(b))


def flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("int")


def inf_to_null(c) -> Column:
    """Sanitise foreign input: NaN and +/-inf become NULL."""
    x = col(c)
    return F.when(F.isnan(x) | (F.abs(x) == F.lit(float("inf"))), F.lit(None).cast("double")).otherwise(x)


def round_compare(c, decimals: int = 6, digits: int = 8) -> Column:
    """Round to the coarser of ``decimals`` places and ``digits`` significant
    digits, as ``round(x * 10^k) / 10^k`` with exact power-of-ten literals.

    Two engines that compute the same double up to a few ulps then agree bit
    for bit unless the value sits on a rounding tie; the coarse step for large
    values keeps that chance small, the absolute step for small values keeps
    cancellation noise (e.g. MACD minus its signal) below it.
    """
    x = col(c)
    e = F.floor(F.log10(F.abs(x)))
    k = F.least(F.lit(decimals), F.lit(digits - 1) - e)
    p = F.pow(F.lit(10.0), F.least(F.abs(k), F.lit(22)).cast("double"))  # exact up to 10^22
    return (F.when(x.isNull() | (x == 0), x)
            .when(k >= 0, F.round(x * p) / p)
            .otherwise(F.round(x / p) * p))


def round_doubles(df: DataFrame, decimals: int = 6, digits: int = 8) -> DataFrame:
    """Apply ``round_compare`` to every double column (results compared across engines)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(round_compare(f.name, decimals, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
