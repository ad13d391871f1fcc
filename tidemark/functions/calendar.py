"""Dates: lenient parsing, integer day keys, calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_day(text: Column) -> Column:
    """Day of an ISO-8601 instant given as text; null when it is not a date."""
    return F.substring(text, 1, 10).try_cast("date")


def iso_instant(text: Column) -> Column:
    """Instant of an ISO-8601 text; null when it does not parse."""
    return F.try_to_timestamp(text).cast("timestamp")


def date_key(day: Column) -> Column:
    """Day as the integer YYYYMMDD."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_key(day_key: Column) -> Column:
    """Month of an integer day key as YYYYMM."""
    return F.floor(day_key / 100).cast("int")


def calendar_columns(day: Column) -> dict[str, Column]:
    """Attributes of one calendar day. The week starts on Sunday, which is 0."""
    weekday = F.dayofweek(day) - 1
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day": F.dayofmonth(day),
        "day_of_week": weekday,
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": weekday.isin(0, 6),
    }
