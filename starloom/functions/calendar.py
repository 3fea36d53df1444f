"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def date_key(c: Column) -> Column:
    """Date or timestamp as the integer YYYYMMDD."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def month_period(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def elapsed_days(end: Column, start: Column) -> Column:
    """Whole 24-hour days from ``start`` to ``end``, rounded down (12 hours early is -1).

    Calendar day difference is ``datediff``; the two must not be mixed.
    """
    micros = F.unix_micros(end) - F.unix_micros(start)
    return ((micros - F.pmod(micros, F.lit(MICROS_PER_DAY))) / MICROS_PER_DAY).cast("int")


def is_late(delay_days: Column) -> Column:
    """An unknown delay is not late."""
    return F.coalesce(delay_days > 0, F.lit(False))


def iso_weekday(c: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(c) + 1
