"""Column expressions on dates and zone-less timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slash dates (month first), with and without seconds, in the spelling a cast understands.
_SLASH_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})"
_CLOCK, _SECONDS = r"\s+(\d{1,2}):(\d{2})", r":(\d{2}(?:\.\d+)?)\s*$"


def parse_timestamp(c: Column) -> Column:
    """ISO or month-first slash text as a zone-less timestamp; null when it reads as neither."""
    full = F.regexp_replace(c, _SLASH_DATE + _CLOCK + _SECONDS, "$3-$1-$2 $4:$5:$6")
    short = F.regexp_replace(full, _SLASH_DATE + _CLOCK + r"\s*$", "$3-$1-$2 $4:$5:00")
    day = F.regexp_replace(short, _SLASH_DATE + r"\s*$", "$3-$1-$2")
    slashed = F.when(c.contains("/"), day.try_cast("timestamp_ntz"))
    return F.coalesce(c.try_cast("timestamp_ntz"), slashed)


def now() -> Column:
    """The current time in UTC, whatever the session's zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


def _second_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def seconds_between(start: Column, end: Column) -> Column:
    """Number of second boundaries crossed from ``start`` to ``end``; independent of time zone."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("long")
    return days * 86_400 + _second_of_day(end) - _second_of_day(start)


def date_key(c: Column) -> Column:
    """Calendar key YYYYMMDD of a date or timestamp."""
    return F.year(c) * 10_000 + F.month(c) * 100 + F.dayofmonth(c)


def iso_weekday(d: Column) -> Column:
    return F.weekday(d) + 1


def season(month: Column) -> Column:
    return (
        F.when(month.between(3, 5), "Spring")
        .when(month.between(6, 8), "Summer")
        .when(month.between(9, 11), "Autumn")
        .otherwise("Winter")
    )
