"""The calendar dimension: one row per day with holidays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalytics.config import CALENDAR_END, CALENDAR_START, Compat
from pedalytics.functions import time

HOLIDAY_YEARS = (2013, 2030)  # of the established list; a calendar takes its own years
JUNETEENTH_SINCE = 2021

# Holidays on the n-th given weekday of a month (n = -1: the last one).
WEEKDAY_HOLIDAYS = (
    ("MLK Day", 1, "MON", 3),
    ("Presidents Day", 2, "MON", 3),
    ("Memorial Day", 5, "MON", -1),
    ("Labor Day", 9, "MON", 1),
    ("Columbus Day", 10, "MON", 2),
    ("Thanksgiving", 11, "THU", 4),
)

# Holidays on a fixed day of a month; Saturdays are observed a day before, Sundays a
# day after, and the name then says "(observed)".
FIXED_HOLIDAYS = (
    ("New Years Day", 1, 1),
    ("Juneteenth", 6, 19),
    ("Independence Day", 7, 4),
    ("Veterans Day", 11, 11),
    ("Christmas Day", 12, 25),
)

# Entries that depart from that rule (actual day, listed day, listed name).
LISTED_OTHERWISE = (
    ("2015-07-04", "2015-07-04", "Independence Day (observed)"),
    ("2021-06-19", "2021-06-19", "Juneteenth"),
    ("2022-01-01", "2022-01-17", "New Years Day (observed)"),
    ("2022-06-19", "2022-06-19", "Juneteenth"),
    ("2028-01-01", "2028-01-01", "New Years Day (observed)"),
)


def _nth_weekday(year: Column, month: int, weekday: str, n: int) -> Column:
    first = F.make_date(year, F.lit(month), F.lit(1))
    if n < 0:
        return F.next_day(F.date_sub(F.last_day(first), 7), weekday)
    return F.date_add(F.next_day(F.date_sub(first, 1), weekday), 7 * (n - 1))


def _fixed_holiday(year: Column, name: str, month: int, day: int) -> Column:
    actual = F.make_date(year, F.lit(month), F.lit(day))
    weekday = time.iso_weekday(actual)
    date = (
        F.when(weekday == 6, F.date_sub(actual, 1))
        .when(weekday == 7, F.date_add(actual, 1))
        .otherwise(actual)
    )
    label = F.when(weekday >= 6, F.lit(f"{name} (observed)")).otherwise(F.lit(name))
    for on, listed, listed_name in LISTED_OTHERWISE:
        date = F.when(actual == F.lit(on).cast("date"), F.lit(listed).cast("date")).otherwise(date)
        label = F.when(actual == F.lit(on).cast("date"), listed_name).otherwise(label)
    entry = F.struct(date.alias("holiday_date"), label.alias("holiday_name"))
    if name == "Juneteenth":
        return F.when(year >= JUNETEENTH_SINCE, entry)
    return entry


def holidays(spark: SparkSession, first: int = HOLIDAY_YEARS[0], last: int = HOLIDAY_YEARS[1]) -> DataFrame:
    """Public holidays as (holiday_date, holiday_name); 2013-2030 are 190 rows, one date twice."""
    year = F.col("id").cast("int")
    entries = [
        F.struct(
            _nth_weekday(year, month, weekday, n).alias("holiday_date"),
            F.lit(name).alias("holiday_name"),
        )
        for name, month, weekday, n in WEEKDAY_HOLIDAYS
    ] + [_fixed_holiday(year, *holiday) for holiday in FIXED_HOLIDAYS]
    return (
        spark.range(first, last + 1, 1, 1)
        .select(F.explode(F.array(*entries)).alias("h"))
        .filter("h is not null")
        .select("h.*")
    )


def one_holiday_per_day(rows: DataFrame) -> DataFrame:
    """Where two holidays share a date, keep the one on its own day over a moved one."""
    moved = F.col("holiday_name").endswith("(observed)").cast("int")
    best = F.min(F.struct(moved.alias("moved"), "holiday_name")).alias("best")
    return rows.groupBy("holiday_date").agg(best).select("holiday_date", "best.holiday_name")


def dim_dates(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    compat: Compat = Compat(),
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included, with no limit on the range.

    Holidays follow their rules in any year.
    """
    listed = holidays(spark, start.year, end.year + 1)  # a New Year may be observed the day before
    if not compat.holiday_fanout:
        listed = one_holiday_per_day(listed)
    days = spark.range(0, (end - start).days + 1, 1, 1).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("full_date")
    )
    d = F.col("full_date")
    day_name, month_name = ("EEE", "MMM") if compat.short_names else ("EEEE", "MMMM")
    dates = days.join(F.broadcast(listed), d == F.col("holiday_date"), "left").select(
        time.date_key(d).alias("date_sk"),
        d,
        time.iso_weekday(d).alias("day_of_week_num"),
        F.date_format(d, day_name).alias("day_of_week_name"),
        F.date_format(d, "EEE").alias("day_of_week_short"),
        time.iso_weekday(d).isin(6, 7).alias("is_weekend"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        F.weekofyear(d).alias("week_of_year"),
        F.month(d).alias("month_num"),
        F.date_format(d, month_name).alias("month_name"),
        F.date_format(d, "MMM").alias("month_short"),
        F.quarter(d).alias("quarter_num"),
        F.year(d).alias("year_num"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        time.season(F.month(d)).alias("season"),
        F.col("holiday_date").isNotNull().alias("is_holiday"),
        F.col("holiday_name"),
        F.trunc(d, "month").alias("first_day_of_month"),
        F.last_day(d).alias("last_day_of_month"),
        F.trunc(d, "year").alias("first_day_of_year"),
        F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_day_of_year"),
    )
    return dates
