"""Numeric helpers (F5, F12) and null-safe statistics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_rounded(num, den, digits: int = 3) -> Column:
    """``ROUND(num::decimal / den, digits)`` as DOUBLE.

    Exact decimal division, half-up rounding, then one cast to double, so
    0.0625 becomes 0.063.  An empty or zero denominator gives null.
    """
    n = _col(num).cast("decimal(20,0)")
    d = _col(den).cast("decimal(20,0)")
    return F.round(F.try_divide(n, d), digits).cast("double")


def percent(num, den, digits: int = 2) -> Column:
    """``round(num / den * 100, digits)``; null when ``den`` is 0."""
    return F.round(F.try_divide(_col(num).cast("double"), _col(den).cast("double")) * 100, digits)


def safe_corr(a, b) -> Column:
    """Pearson correlation over rows where both values are present.

    Same value as ``corr`` but null instead of a divide-by-zero error when
    one side is constant (ANSI mode raises for ``corr`` there).
    """
    a, b = _col(a).cast("double"), _col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    sa = F.stddev_samp(F.when(both, a))
    sb = F.stddev_samp(F.when(both, b))
    return F.try_divide(F.covar_samp(a, b), sa * sb)
