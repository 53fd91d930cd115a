"""The ride fact: quality-filtered trips with station and date keys and derived measures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.config import (
    CALENDAR_END,
    CALENDAR_START,
    LAYOUT_OF_KEY,
    MAX_TRIP_SECONDS,
    MIN_TRIP_SECONDS,
    Compat,
)
from pedalytics.functions import ride, text, time
from pedalytics.operators.joins import attach_key, unseen_by_file
from pedalytics.operators.unify import trip_key


def qualifying(
    trips: DataFrame, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """Trips of plausible length that start inside the calendar; unknown values do not qualify.

    The date condition is written on the timestamp itself so that it reaches the file scan.
    """
    began = F.col("started_at")
    until = end + dt.timedelta(days=1)
    return trips.filter(
        F.col("trip_duration").between(MIN_TRIP_SECONDS, MAX_TRIP_SECONDS)
        & (began >= F.lit(start.isoformat()).cast("timestamp_ntz"))
        & (began < F.lit(until.isoformat()).cast("timestamp_ntz"))
    )


def fact_ride(
    trips: DataFrame,
    stations: DataFrame,
    existing: DataFrame | None = None,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    layout_of_key: Mapping[str, str] = LAYOUT_OF_KEY,
    compat: Compat = Compat(),
) -> DataFrame:
    """Rides not yet in ``existing``; trips at unknown stations stay, with a null station key."""
    rows = unseen_by_file(qualifying(trips, start, end), existing)
    for side in ("start", "end"):
        name = text.canonical_name(F.col(f"{side}_station_name"))
        rows = attach_key(
            rows, stations, name, "station_name", "station_sk", f"{side}_station_sk"
        )
    began, ended, born = F.col("started_at"), F.col("ended_at"), F.col("birth_year")
    label = text.layout_label(F.col("_source_file"), layout_of_key, compat.key_by_split)
    return rows.select(
        trip_key().alias("ride_sk"),
        trip_key().alias("trip_sk_staging"),
        "ride_id",
        "start_station_sk",
        "end_station_sk",
        time.date_key(began).alias("start_date_sk"),
        time.date_key(ended).alias("end_date_sk"),
        began,
        ended,
        F.col("trip_duration").alias("trip_duration_sec"),
        ride.minutes(F.col("trip_duration")).alias("trip_duration_min"),
        F.hour(began).alias("start_hour"),
        text.clean_code(F.col("rideable_type")).alias("rideable_type"),
        "bikeid",
        text.rider_type(F.col("member_casual")).alias("member_casual"),
        born,
        "gender",
        ride.age_at(began, born).alias("age_at_ride"),
        ride.age_band(began, born).alias("age_bucket"),
        label.alias("source_schema"),
        "_source_file",
        "_source_row_number",
        time.now().alias("_loaded_at"),
    )


def rides_by_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Check query: rides per calendar year."""
    per_day = fact.groupBy("start_date_sk").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_day.join(dates.select("date_sk", "year_num"), F.col("start_date_sk") == F.col("date_sk"))
        .groupBy("year_num")
        .agg(F.sum("n").alias("rides"))
        .orderBy("year_num")
    )


def rides_without_station(fact: DataFrame) -> DataFrame:
    """Check query: rides whose start (or end) station did not resolve."""
    return fact.agg(
        F.count_if(F.col("start_station_sk").isNull()).alias("missing_start_station"),
        F.count_if(F.col("end_station_sk").isNull()).alias("missing_end_station"),
    )


def rides_ending_off_calendar(fact: DataFrame, end: dt.date = CALENDAR_END) -> DataFrame:
    """Check query: rides whose end date is unknown or past the calendar."""
    last = end.year * 10_000 + end.month * 100 + end.day
    return fact.agg(
        F.count_if(F.col("end_date_sk").isNull()).alias("no_end_date"),
        F.count_if(F.col("end_date_sk") > last).alias("past_calendar"),
    )


def stations_by_availability(stations: DataFrame) -> DataFrame:
    return stations.groupBy("availability").agg(F.count(F.lit(1)).alias("stations"))
