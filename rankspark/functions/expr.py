"""Null-aware column expressions reproducing pandas missing-value semantics.

Rules: NaN never enters (nulls mark missing); division by zero or by null gives
the fill value; ``clip`` keeps nulls; comparisons with null are False, except
``!=`` which is True.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "safe_divide", "finite_or_zero", "clip_lower", "ne_true",
    "flag", "nan_to_null", "r6", "md5_key", "count_true", "null_count",
    "row_mean", "row_std", "dbl",
]


def dbl(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("double")


def safe_divide(num: Column, den: Column, fill: float | None = 0.0) -> Column:
    """num/den with x/0, 0/0, null -> fill (pandas div + inf->NaN + fillna)."""
    q = F.try_divide(dbl(num), dbl(den))
    return q if fill is None else F.coalesce(q, F.lit(float(fill)))


def finite_or_zero(c: Column) -> Column:
    c = dbl(c)
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), F.lit(0.0)).otherwise(c)


def clip_lower(c: Column, lower) -> Column:
    """pandas ``clip(lower=)``: null stays null (``greatest`` would not)."""
    return F.when(c < F.lit(lower), F.lit(lower)).otherwise(c)


def ne_true(a: Column, b: Column) -> Column:
    """pandas ``a.ne(b)``: True when either side is missing."""
    return F.coalesce(a != b, F.lit(True))


def flag(cond: Column) -> Column:
    """Boolean with null -> False, as int 0/1."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def nan_to_null(c: Column) -> Column:
    return F.nanvl(dbl(c), F.lit(None).cast("double"))


def r6(c: Column, digits: int = 6) -> Column:
    """Round by way of ten decimal digits: noise of a sum's order can't turn a tie.

    Values of up to 12 digits in all that aren't near a tie are rounded as doubles, which gives the same double some
    times faster: a whole number of up to 53 bits over a power of ten is the double nearest to that decimal.
    """
    x = dbl(c)
    scaled = x * F.lit(10.0 ** digits)
    plain = (F.abs(scaled) < 1e12) & (F.abs(scaled - F.floor(scaled) - 0.5) > 0.01) if 0 <= digits <= 6 else F.lit(False)
    exact = F.round(x.try_cast("decimal(38,10)"), digits).cast("double")
    return F.when(plain, F.rint(scaled) / F.lit(10.0 ** digits) + 0.0).otherwise(exact)


def md5_key(c: Column | str, seed: int) -> Column:
    """Deterministic shuffle key, identical in Spark SQL and DuckDB."""
    c = F.col(c) if isinstance(c, str) else c
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def count_true(conds: Iterable[Column]) -> Column:
    total = None
    for cond in conds:
        term = flag(cond)
        total = term if total is None else total + term
    return total if total is not None else F.lit(0)


def null_count(cols: Iterable[str]) -> Column:
    return count_true(F.col(c).isNull() for c in cols)


def row_mean(cols: list[str]) -> Column:
    """Mean of the non-null values of a row; null when all are null."""
    s = None
    for c in cols:
        term = F.coalesce(dbl(c), F.lit(0.0))
        s = term if s is None else s + term
    n = count_true(F.col(c).isNotNull() for c in cols)
    return F.when(n > 0, s / n)


def row_std(cols: list[str], fill: float | None = 0.0) -> Column:
    """Sample std (ddof=1) across columns of a row, two-pass; <2 values -> fill."""
    mean = row_mean(cols)
    ss = None
    for c in cols:
        term = F.coalesce(F.pow(dbl(c) - mean, 2), F.lit(0.0))
        ss = term if ss is None else ss + term
    n = count_true(F.col(c).isNotNull() for c in cols)
    std = F.when(n > 1, F.sqrt(ss / (n - 1)))
    return std if fill is None else F.coalesce(std, F.lit(float(fill)))
