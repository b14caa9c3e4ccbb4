"""Money and share arithmetic in exact decimals.

Amounts are kept as ``decimal(.., 2)`` so sums are exact; an average or a
percentage is one integer division, rounded half up once, then cast to double
for the report. Rounding the double mean instead depends on summation order and
on binary representation at ties; rounding a decimal quotient, which already
has a limited scale, would round twice.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(20, 2)
#: Unit prices keep more places than amounts: the product is rounded, not the price.
PRICE = DecimalType(20, 6)
UNITS = DecimalType(38, 0)


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def as_money(c) -> Column:
    """A double or string amount as an exact two-decimal value (half up)."""
    return _c(c).cast(MONEY)


def as_price(c) -> Column:
    """A unit price at six decimals."""
    return _c(c).cast(PRICE)


def half_up(num: Column, den: Column, scale: int) -> Column:
    """``num / den`` (integers, den > 0) rounded once, half away from zero, to
    ``scale`` places, as double; null for a null or zero ``den``."""
    num, den = num.cast(UNITS), F.nullif(den.cast(UNITS), F.lit(0).cast(UNITS))
    twice = F.abs(num) * F.lit(2 * 10 ** scale).cast(UNITS)
    units = F.call_function("div", (twice + den).cast(UNITS), (den * F.lit(2)).cast(UNITS))
    return (F.signum(num).cast("int") * units.cast(UNITS)).cast(UNITS).cast("double") / F.lit(float(10 ** scale))


def total(c) -> Column:
    """Exact sum of a decimal amount column, reported as double."""
    return F.sum(_c(c)).cast("double")


def mean(c, scale: int = 2, places: int = 2) -> Column:
    """``round(sum / count, scale)`` over non-null decimals of ``places`` places."""
    c = _c(c)
    units = F.sum(c) * F.lit(10 ** places).cast(DecimalType(8, 0))
    return half_up(units, F.count(c) * F.lit(10 ** places), scale)


def share_pct(part, whole, scale: int = 1) -> Column:
    """``100 * part / whole`` of counts, rounded half up to ``scale`` places."""
    return half_up(_c(part).cast(UNITS) * F.lit(100), _c(whole), scale)
