"""Column expressions on dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_years(later: Column, earlier: Column) -> Column:
    """Full years of 365.25 days between two dates; negative spans go down to the next integer."""
    return F.floor(F.datediff(later, earlier) / 365.25)


def pay_day(date: Column) -> Column:
    """True on the 15th and on the last day of the month."""
    day = date.cast("date")
    return (F.dayofmonth(day) == 15) | (day == F.last_day(day))


def in_period(date: Column, start: str, days: int = 90) -> Column:
    """True on ``start`` and the ``days - 1`` days after it."""
    day = date.cast("date")
    first = F.lit(start).cast("date")
    return day.between(first, F.date_add(first, days - 1))


def day_list(start: Column, days: int) -> Column:
    """Array of ``days`` dates from ``start`` on."""
    return F.sequence(start.cast("date"), F.date_add(start.cast("date"), days - 1))
