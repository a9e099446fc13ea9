"""Calendar keys. All keys stay time-zone free (DATE or TIMESTAMP_NTZ)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Day names indexed by day of week with Sunday = 0.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ts_trunc_day(col: Column | str) -> Column:
    """``DATE_TRUNC('day', ts)`` as a TIMESTAMP_NTZ."""
    return _c(col).cast("date").cast("timestamp_ntz")


def month_key(col: Column | str) -> Column:
    """``DATE_TRUNC('month', x)`` as a TIMESTAMP_NTZ month start."""
    return F.trunc(_c(col).cast("date"), "MM").cast("timestamp_ntz")


def week_start_sunday(col: Column | str) -> Column:
    """Sunday that starts the week of ``col``, as a TIMESTAMP_NTZ.

    Equal to ``DATE_TRUNC('week', d + 1 day) - 1 day`` (ISO weeks start on
    Monday): step back ``dayofweek - 1`` days, where Sunday is 1.
    """
    d = _c(col).cast("date")
    return F.date_sub(d, F.dayofweek(d) - 1).cast("timestamp_ntz")


def day_of_week_sunday0(col: Column | str) -> Column:
    """Day of week with Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(_c(col)) - 1


def day_of_week_name(dow: Column | str) -> Column:
    """Name for a Sunday = 0 day number; NULL when out of range."""
    return F.get(F.array(*[F.lit(n) for n in DAY_NAMES]), _c(dow))
