"""Reports on the star schema as frames over its tables.

``top_stations`` and ``top_routes`` stage their counts when the frame is built, so that ranking them
does not scan the fact again: they show the fact of that moment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pedalytics.config import NYC, Region
from pedalytics.functions import ride
from pedalytics.operators import quantile, ranking
from pedalytics.session import stage

_DURATION = "trip_duration_min"


def _duration_stats(fact: DataFrame, keys: list[str], total: str) -> DataFrame:
    """Rides, mean and exact median minutes per group.

    Counted per (group, minutes) first: the fact admits 60 to 86,400 seconds, so a group has at most
    86,341 different durations however many rides it has.
    """
    hist = quantile.histogram(fact, keys, _DURATION)
    n, minutes = F.col(quantile.COUNT), F.col(_DURATION)
    sum_minutes = F.sum(n.cast("decimal(18,0)") * minutes)
    return hist.groupBy(*keys).agg(
        F.sum(n).alias(total),
        ride.mean(sum_minutes, F.sum(n)).alias("avg_duration_min"),
        ride.rounded_median(quantile.weighted_median(_DURATION)).alias("median_duration_min"),
    )


def monthly_ridership(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """Rides and duration per month and rider type."""
    month = ["year_num", "month_num", "month_short", "year_month"]
    days = dates.select("date_sk", *month)
    on_day = fact.select("start_date_sk", "member_casual", _DURATION).join(
        days, F.col("start_date_sk") == F.col("date_sk")
    )
    return _duration_stats(on_day, [*month, "member_casual"], "total_rides")


def with_growth(monthly: DataFrame) -> DataFrame:
    """Month-on-month and year-on-year growth per rider type; a year back means 12 rows back."""
    by_month = W.partitionBy("member_casual").orderBy("year_month")
    rides = F.col("total_rides")
    return monthly.withColumns(
        {
            "prev_month_rides": F.lag("total_rides").over(by_month),
            "same_month_prev_year": F.lag("total_rides", 12).over(by_month),
        }
    ).select(
        *monthly.columns,
        "prev_month_rides",
        ride.growth_pct(rides, F.col("prev_month_rides")).alias("mom_growth_pct"),
        "same_month_prev_year",
        ride.growth_pct(rides, F.col("same_month_prev_year")).alias("yoy_growth_pct"),
    )


def ridership_over_time(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """How has ridership grown? One row per month and rider type."""
    return with_growth(monthly_ridership(fact, dates)).orderBy("year_month", "member_casual")


def station_activity(fact: DataFrame) -> DataFrame:
    """Departures, arrivals and departure minutes per station key, in one scan of the fact."""
    departure = F.struct(
        F.col("start_station_sk").alias("station_sk"), F.col(_DURATION).alias("minutes")
    )
    arrival = F.struct(
        F.col("end_station_sk").alias("station_sk"), F.lit(None).cast("decimal(10,2)").alias("minutes")
    )
    return (
        fact.select(F.posexplode(F.array(departure, arrival)).alias("is_arrival", "e"))
        .filter("e.station_sk is not null")
        .groupBy(F.col("e.station_sk").alias("station_sk"))
        .agg(
            F.count_if(F.col("is_arrival") == 0).alias("departures"),
            F.count_if(F.col("is_arrival") == 1).alias("arrivals"),
            F.sum("e.minutes").alias("departure_minutes"),
        )
    )


def top_stations(fact: DataFrame, stations: DataFrame) -> DataFrame:
    """Which stations are the hubs? One row per station, also those without rides.

    The fact is scanned once: the flows, one row per station, are staged before they are ranked.
    """
    zero = F.lit(0)
    flows = (
        stations.select("station_sk", "station_name", "station_lat", "station_lng", "availability")
        .join(station_activity(fact), "station_sk", "left")
        .withColumns(
            {
                "total_departures": F.coalesce("departures", zero),
                "total_arrivals": F.coalesce("arrivals", zero),
            }
        )
        .withColumns(
            {
                "total_activity": F.col("total_departures") + F.col("total_arrivals"),
                "net_flow": F.col("total_departures") - F.col("total_arrivals"),
                "avg_departure_duration_min": ride.mean(
                    F.col("departure_minutes"), F.col("departures")
                ),
            }
        )
    )
    flows = ranking.with_dense_ranks(
        stage(flows, "station-flows"),
        departure_rank="total_departures",
        arrival_rank="total_arrivals",
        activity_rank="total_activity",
    )
    return flows.select(
        "station_sk",
        "station_name",
        "station_lat",
        "station_lng",
        "availability",
        "total_departures",
        "total_arrivals",
        "total_activity",
        "net_flow",
        ride.flow_label(F.col("net_flow")).alias("flow_type"),
        "avg_departure_duration_min",
        "departure_rank",
        "arrival_rank",
        "activity_rank",
    ).orderBy(F.desc("total_activity"))


def route_totals(fact: DataFrame) -> DataFrame:
    """Trips and durations per (start, end) station key; rides without both keys are left out."""
    both = fact.filter(
        F.col("start_station_sk").isNotNull() & F.col("end_station_sk").isNotNull()
    ).select("start_station_sk", "end_station_sk", _DURATION)
    return _duration_stats(both, ["start_station_sk", "end_station_sk"], "total_trips")


def top_routes(fact: DataFrame, stations: DataFrame, region: Region = NYC) -> DataFrame:
    """Most travelled station pairs.

    Names join the pairs after counting, not every ride before. The pairs are staged, so that the
    ranks read them and not the fact again.
    """
    start_lat, start_lng = region.route_start_columns
    start = stations.select(
        F.col("station_sk").alias("start_station_sk"),
        F.col("station_name").alias("start_station"),
        F.col("station_lat").alias(start_lat),
        F.col("station_lng").alias(start_lng),
    )
    end = stations.select(
        F.col("station_sk").alias("end_station_sk"),
        F.col("station_name").alias("end_station"),
        F.col("station_lat").alias("end_lat"),
        F.col("station_lng").alias("end_lng"),
    )
    named = route_totals(fact).join(start, "start_station_sk").join(end, "end_station_sk")
    return (
        ranking.with_dense_ranks(stage(named, "routes"), route_rank="total_trips")
        .select(
            "start_station",
            "end_station",
            start_lat,
            start_lng,
            "end_lat",
            "end_lng",
            "total_trips",
            "avg_duration_min",
            "median_duration_min",
            (F.col("start_station_sk") == F.col("end_station_sk")).alias("is_round_trip"),
            "route_rank",
        )
        .orderBy(F.desc("total_trips"))
    )


def top_routes_by_rank(routes: DataFrame, rank: int = 10) -> DataFrame:
    """Routes up to a rank; routes that tie all stay."""
    return routes.filter(F.col("route_rank") <= rank)


def top_stations_by_activity(stations: DataFrame, n: int = 20) -> DataFrame:
    """The n most active stations; ties are settled by name to give the same rows every time."""
    return ranking.top_n(stations, n, F.asc("activity_rank"), F.asc("station_name"))
