"""Money and ratio helpers with exact decimal semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_12 = "decimal(12,2)"
MONEY_14 = "decimal(14,2)"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def clamp_non_negative(c: Column | str) -> Column:
    """NULL -> 0, negatives -> 0."""
    return F.greatest(F.coalesce(_c(c), F.lit(0)), F.lit(0))


def money(c: Column | str, dtype: str = MONEY_12) -> Column:
    """Cast to the money decimal (never double)."""
    return _c(c).cast(dtype)


def planned_value(days: Column | str, rate: Column | str, dtype: str = MONEY_12) -> Column:
    """C8 (F4): days x class rate (NULL rate -> 0), stored as DECIMAL(12,2)."""
    return (_c(days).cast("decimal(10,0)") * F.coalesce(_c(rate), F.lit(0)).cast(dtype)).cast(dtype)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def round_ratio(num: Column | str, den: Column | str, digits: int, scale: int = 1) -> Column:
    """round(scale * num / den, digits), half away from zero, computed exactly.

    ``num`` and ``den`` are integral (counts, day sums, cents); the rounding is
    done in integer arithmetic so the result does not depend on floating-point
    division, then returned as DOUBLE. NULL when ``den`` is 0 or NULL (G6).
    """
    n = _c(num).cast("decimal(26,0)")      # cents of a whole warehouse times the factor exceed 64 bits
    d = _c(den).cast("decimal(26,0)")
    p = 10 ** digits
    q = _div(F.abs(n) * F.lit(2 * p * scale) + d, d * 2)
    signed = F.when(n < 0, -q).otherwise(q)          # integer sign: never -0.0
    return F.when(d != 0, signed / F.lit(float(p)))


def cents(c: Column | str) -> Column:
    """Exact integer cents of a DECIMAL(.,2) value."""
    return (_c(c) * 100).cast("long")


def pct(num: Column | str, den: Column | str, digits: int = 2) -> Column:
    """round(100 * num / NULLIF(den, 0), digits)."""
    return round_ratio(num, den, digits, scale=100)
