"""Small hand-written unified trips."""

import datetime as dt

from pyspark.sql import Row

from pedalytics.schemas import TRIPS_ALL

DEFAULTS = dict.fromkeys(TRIPS_ALL.fieldNames())
NYC_MODERN = "nyc_dc497b4333c4_part0001.csv.gz"
NYC_V1 = "nyc_473144999085_part0001.csv.gz"


def trip(n, **values):
    base = dict(
        started_at=dt.datetime(2016, 5, 4, 8, 30),
        ended_at=dt.datetime(2016, 5, 4, 8, 40),
        trip_duration=600,
        start_station_name="A",
        end_station_name="B",
        start_lat=40.7,
        start_lng=-74.0,
        end_lat=40.8,
        end_lng=-73.9,
        member_casual="member",
        _source_file=NYC_MODERN,
        _source_row_number=n,
    )
    return Row(**(DEFAULTS | base | values))


def frame(spark, *rows):
    names = TRIPS_ALL.fieldNames()
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRIPS_ALL)
