"""Calendar helpers as native Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_day(df: DataFrame, column: str, zone: str = "Europe/Stockholm", naive_zone: str = "UTC") -> Column:
    """Calendar date of an instant in ``zone``, whatever the session zone is.

    A timestamp without zone is read as wall-clock time in ``naive_zone``.
    """
    stamp = F.col(column)
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.to_date(F.convert_timezone(F.lit(naive_zone), F.lit(zone), stamp))
    wall = stamp.cast("timestamp_ntz")
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone), wall))


def month_key(value: Column) -> Column:
    """``YYYY-MM`` of ISO text, a date or a timestamp."""
    return F.substring(value.cast("string"), 1, 7)


def in_months(month: Column, first: str, last: str) -> Column:
    """Closed range test on ``YYYY-MM`` keys."""
    return month.between(first, last)


def month_range(df: DataFrame, column: str, first: str, last: str) -> Column:
    """Closed range of months as two bounds on a date or timestamp column itself.

    Unlike a test on ``month_key`` both bounds reach the scan: partitions, files and row groups outside are not read.
    """
    kind = df.schema[column].dataType
    start = F.lit(f"{first}-01").cast("date").cast(kind)
    end = F.add_months(F.lit(f"{last}-01").cast("date"), 1).cast(kind)
    return (F.col(column) >= start) & (F.col(column) < end)


def without_zone(text: Column) -> Column:
    """ISO date text before any ``+hh:mm`` or ``Z`` suffix."""
    return F.get(F.split(F.get(F.split(text, r"\+"), F.lit(0)), "Z"), F.lit(0))


def duration_years(start: Column, end: Column) -> Column:
    """Years between two ISO dates to one decimal; NULL when either does not parse."""
    days = F.datediff(F.try_to_date(end, "yyyy-MM-dd"), F.try_to_date(start, "yyyy-MM-dd"))
    return F.bround(days / 365.25, 1)


def is_stale(last: Column, today: Column, days: int) -> Column:
    """True when a value was never refreshed or is older than ``days``."""
    return last.isNull() | (F.datediff(today, last) > days)
