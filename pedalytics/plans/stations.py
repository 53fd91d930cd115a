"""The station dimension, keyed by canonical station name."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalytics.config import LAYOUT_OF_KEY, LEGACY_LAYOUTS, MODERN, Compat, Region
from pedalytics.functions import ride, text, time
from pedalytics.operators import quantile
from pedalytics.session import stage


def observations(
    trips: DataFrame,
    region: Region,
    layout_of_key: Mapping[str, str] = LAYOUT_OF_KEY,
    compat: Compat = Compat(),
) -> DataFrame:
    """Both ends of every trip as station sightings inside the region's box; one scan of trips."""

    def end(side: str) -> Column:
        return F.struct(
            text.canonical_name(F.col(f"{side}_station_name")).alias("station_name"),
            F.col(f"{side}_station_id").alias("station_id"),
            F.col(f"{side}_lat").alias("lat"),
            F.col(f"{side}_lng").alias("lng"),
        )

    label = text.layout_label(F.col("_source_file"), layout_of_key, compat.key_by_split)
    return (
        trips.select(
            label.alias("source_schema"), F.explode(F.array(end("start"), end("end"))).alias("o")
        )
        .select("o.*", "source_schema")
        .filter(
            F.col("station_name").isNotNull()
            & F.col("lat").between(*region.lat)
            & F.col("lng").between(*region.lng)
        )
    )


def station_key(name: Column) -> Column:
    """Key of a station: a function of its name, so a rebuild gives the same keys again."""
    return F.xxhash64(name)


def station_stats(seen: DataFrame) -> DataFrame:
    """One row per canonical name: ids per era, spread, sightings and a bracket for each median.

    One aggregate over one scan; a string maximum and the sketches are combined map-side by hash.
    """
    legacy, modern = F.col("source_schema").isin(*LEGACY_LAYOUTS), F.col("source_schema") == MODERN
    sketched = seen.groupBy("station_name").agg(
        F.max(F.when(legacy, F.col("station_id"))).alias("legacy_station_id"),
        F.max(F.when(modern, F.col("station_id"))).alias("modern_station_id"),
        F.bool_or(legacy).alias("in_legacy"),
        F.bool_or(modern).alias("in_modern"),
        F.count(F.lit(1)).alias("trip_observations"),
        F.round(F.max("lat") - F.min("lat"), 6).alias("lat_variance"),
        F.round(F.max("lng") - F.min("lng"), 6).alias("lng_variance"),
        quantile.sketch("lat").alias("lat_sketch"),
        quantile.sketch("lng").alias("lng_sketch"),
    )
    return sketched.withColumns(
        {"lat": quantile.bracket("lat_sketch"), "lng": quantile.bracket("lng_sketch")}
    ).drop("lat_sketch", "lng_sketch")


def by_axis(rows: DataFrame, value: str) -> DataFrame:
    """Rows (station_name, lat, lng) as two of (station_name, axis, value): both axes go through one pass."""
    axes = F.create_map(F.lit("lat"), F.col("lat"), F.lit("lng"), F.col("lng"))
    return rows.select("station_name", F.explode(axes).alias("axis", value))


def dim_station(
    trips: DataFrame,
    region: Region,
    layout_of_key: Mapping[str, str] = LAYOUT_OF_KEY,
    compat: Compat = Compat(),
) -> DataFrame:
    """One row per canonical name: ids per era, median coordinates, spread and sightings.

    Trips are scanned twice: for the aggregates with their sketches, and for the exact medians.
    """
    seen = observations(trips, region, layout_of_key, compat)
    stats = stage(station_stats(seen), "station-stats")
    brackets = by_axis(stats, "b").select("station_name", "axis", "b.lo", "b.hi")
    median = quantile.median_in_brackets(
        by_axis(seen, "position"), ["station_name", "axis"], "position", brackets, "median"
    )
    is_lat = F.col("axis") == "lat"
    medians = median.groupBy("station_name").agg(
        F.max(F.when(is_lat, F.col("median"))).alias("station_lat"),
        F.max(F.when(~is_lat, F.col("median"))).alias("station_lng"),
    )
    now = time.now()
    return stats.join(medians, "station_name").select(
        station_key(F.col("station_name")).alias("station_sk"),
        "station_name",
        "legacy_station_id",
        "modern_station_id",
        "station_lat",
        "station_lng",
        "in_legacy",
        "in_modern",
        ride.availability(F.col("in_legacy"), F.col("in_modern")).alias("availability"),
        "trip_observations",
        "lat_variance",
        "lng_variance",
        now.alias("_created_at"),
        now.alias("_updated_at"),
    )
