"""Date and month functions.

All month logic works on DATE values of the first day of a month, so no
time zone enters the arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_day(c) -> Column:
    """cast a timestamp (or string) to DATE."""
    return _col(c).cast("date")


def month_start(c) -> Column:
    """first day of the month, as DATE (``date_trunc('month')``)."""
    return F.trunc(to_day(c), "MM")


def month_number(c) -> Column:
    """``12 * year + month``, a linear month count."""
    c = _col(c)
    return F.year(c) * 12 + F.month(c)


def cohort_index(event_month, cohort_month, mode: str = "linear") -> Column:
    """Months since the cohort month, counting the cohort month as 1.

    ``linear``: 1, 2, ... without bound.
    ``age``: only the months part of the year-month interval between the
    two dates (F4), so month 13 maps back to 1.
    """
    linear = month_number(event_month) - month_number(cohort_month) + 1
    if mode == "linear":
        return linear.cast("int")
    if mode == "age":
        return (F.pmod(linear - 1, F.lit(12)) + 1).cast("int")
    raise ValueError(f"unknown cohort index mode {mode!r}")


def parse_date(c, fmt: str | None = None) -> Column:
    """Parse a string to DATE; unparsable or empty values become null."""
    c = _col(c)
    parsed = F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)
    return parsed.cast("date")
