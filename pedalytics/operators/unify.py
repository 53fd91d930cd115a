"""Three file layouts brought to one trip table."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalytics.config import LEGACY_V1, LEGACY_V2, MODERN
from pedalytics.functions import text, time
from pedalytics.schemas import TRIPS_ALL
from pedalytics.session import stage

# Unified name of each staging column that goes by another name there.
_LEGACY_NAMES = {
    "start_station_latitude": "start_lat",
    "start_station_longitude": "start_lng",
    "end_station_latitude": "end_lat",
    "end_station_longitude": "end_lng",
}
_RENAMED = {
    MODERN: {},
    LEGACY_V1: {
        **_LEGACY_NAMES,
        "starttime": "started_at",
        "stoptime": "ended_at",
        "tripduration": "trip_duration",
        "usertype": "member_casual",
    },
    LEGACY_V2: {
        **_LEGACY_NAMES,
        "start_time": "started_at",
        "stop_time": "ended_at",
        "bike_id": "bikeid",
        "user_type": "member_casual",
    },
}


def _derived(layout: str) -> dict[str, Column]:
    if layout == MODERN:
        return {"trip_duration": time.seconds_between(F.col("started_at"), F.col("ended_at"))}
    return {
        "start_station_id": F.col("start_station_id").cast("string"),
        "end_station_id": F.col("end_station_id").cast("string"),
        "member_casual": text.rider_type_of_user_type(F.col("member_casual")),
    }


def to_unified(staging: DataFrame, layout: str) -> DataFrame:
    """Rename, derive and reorder one layout; columns a layout lacks become typed nulls."""
    renamed = staging.withColumnsRenamed(_RENAMED[layout])
    new = _derived(layout) | {"_loaded_at_tbl": time.now()}
    have = {*renamed.columns, *new}
    new |= {f.name: F.lit(None).cast(f.dataType) for f in TRIPS_ALL.fields if f.name not in have}
    return renamed.withColumns(new).select(*TRIPS_ALL.fieldNames())


def union_layouts(staging: Mapping[str, DataFrame]) -> DataFrame:
    """All given layouts as one frame of unified trips."""
    return reduce(DataFrame.unionByName, [to_unified(df, layout) for layout, df in staging.items()])


def trip_key() -> Column:
    """Surrogate key of a trip: a function of its lineage, so rebuilding does not change it."""
    return F.xxhash64("_source_file", "_source_row_number")


def drop_repeated_trips(trips: DataFrame) -> DataFrame:
    """Opt-in: keep one trip per natural key, the ride id, or bike and start time where there is none.

    Trips that have neither cannot be told to be the same; they all stay.
    """
    bike_and_time = F.concat(F.col("bikeid").cast("string"), F.lit("@"), F.col("started_at").cast("string"))
    keyed = trips.withColumn("_natural", F.coalesce(F.col("ride_id"), bike_and_time))
    once = keyed.filter(F.col("_natural").isNotNull()).dropDuplicates(["_natural"])
    return once.unionByName(keyed.filter(F.col("_natural").isNull())).drop("_natural")


def repeated_trips(trips: DataFrame) -> DataFrame:
    """Natural keys that occur more than once, with the number of source files they come from.

    Hashes of the keys are counted first, a few bytes a trip; only trips whose hash occurs again are
    grouped by the keys themselves. These are counted per file first, so a key repeated very often is spread
    over its files and tasks.
    """
    keys = ["ride_id", "bikeid", "started_at"]
    keyed = trips.select(
        "ride_id",
        F.when(F.col("ride_id").isNull(), F.col("bikeid")).alias("bikeid"),
        F.when(F.col("ride_id").isNull(), F.col("started_at")).alias("started_at"),
        "_source_file",
    )
    hashed = F.xxhash64(*keys)
    often = keyed.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_hash")
    again = keyed.join(stage(often, "repeated-hashes"), hashed == F.col("_hash"), "left_semi")
    per_file = again.groupBy(*keys, "_source_file").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_file.groupBy(*keys)
        .agg(F.sum("n").alias("trips"), F.count(F.lit(1)).alias("source_files"))
        .filter(F.col("trips") > 1)
    )
