"""Exact money arithmetic and percentage rounding.

Sums stay DECIMAL (exact). A ratio or mean is one DECIMAL division, which
Spark carries to 10-18 fractional digits here, rounded half away from zero
to two decimals: the same digits as PostgreSQL's NUMERIC arithmetic (a
difference would need the exact value within 1e-10 of a half-cent, i.e.
denominators beyond any data size). Results leave as DOUBLE only at the
output boundary.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def item_value(price="price", freight="freight_value") -> Column:
    """Value of one order item: price plus freight (exact decimal)."""
    return _c(price) + _c(freight)


def round2(x) -> Column:
    """ROUND(x, 2) on an exact decimal (half away from zero)."""
    return F.round(_c(x), 2)


def exact_ratio(num, den, factor: int = 1) -> Column:
    """``ROUND(factor * num / NULLIF(den, 0), 2)`` in DECIMAL arithmetic (half away from zero).

    ``num`` and ``den`` are exact (integers or 2-decimal money); NULL when
    ``den`` is 0 or NULL.
    """
    n = _c(num).cast("decimal(24,2)")
    d = F.nullif(_c(den).cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    if factor != 1:
        n = F.lit(factor).cast("decimal(3,0)") * n
    return F.round(n / d, 2)


def pct(num, den, scale: int = 100) -> Column:
    """``ROUND(scale * num / NULLIF(den, 0), 2)``; NULL when den is 0 or NULL."""
    return exact_ratio(num, den, scale)


def avg_exact(x) -> Column:
    """``ROUND(AVG(x), 2)`` as an aggregate: exact sum over exact count."""
    col = _c(x)
    return exact_ratio(F.sum(col), F.count(col))


def ratio_round(num, den) -> Column:
    """``ROUND(num / NULLIF(den, 0), 2)`` for already aggregated columns."""
    return exact_ratio(num, den)

