"""Calendar differences between two dates, counted in whole months and years.

Both work on date fields only, so the session time zone plays no part.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS_PER_YEAR = 12


def _month_number(day: Column) -> Column:
    return F.year(day) * MONTHS_PER_YEAR + F.month(day)


def _completed_months(earlier: Column, later: Column) -> Column:
    unfinished = (F.dayofmonth(later) < F.dayofmonth(earlier)).cast("int")
    return _month_number(later) - _month_number(earlier) - unfinished


def whole_months(start: Column, end: Column) -> Column:
    """Completed months from ``start`` to ``end``; negative when ``end`` comes first."""
    return F.when(end >= start, _completed_months(start, end)).otherwise(
        -_completed_months(end, start)
    )


def whole_years(start: Column, end: Column) -> Column:
    """Completed years from ``start`` to ``end``, cut towards zero."""
    months = whole_months(start, end)
    return F.call_function("div", months, F.lit(MONTHS_PER_YEAR)).cast("int")


def as_date(day) -> Column:
    """A fixed day (``date`` or ISO text) as a column; ``None`` means the current date."""
    return F.current_date() if day is None else F.lit(day).cast("date")
