import datetime as dt

from pyspark.sql import functions as F

from pedalytics.config import LEGACY_V1, NYC
from pedalytics.operators.joins import unseen
from pedalytics.operators.unify import drop_repeated_trips, repeated_trips, to_unified
from pedalytics.plans import calendar, rides, stations
from pedalytics.schemas import LAYOUT_SCHEMA, STAGING_META, TRIPS_ALL
from trips import frame, trip


def test_legacy_layout_is_renamed_and_filled(spark):
    fields = LAYOUT_SCHEMA[LEGACY_V1].fields + STAGING_META.fields
    values = dict.fromkeys(f.name for f in fields) | {
        "tripduration": 600, "starttime": dt.datetime(2014, 1, 1), "start_station_id": 72,
        "usertype": "Subscriber", "bikeid": 5, "_source_file": "f", "_source_row_number": 3,
    }
    schema = STAGING_META.__class__(fields)
    staged = spark.createDataFrame([tuple(values[f.name] for f in fields)], schema)
    unified = to_unified(staged, LEGACY_V1)
    assert [(f.name, f.dataType) for f in unified.schema] == [(f.name, f.dataType) for f in TRIPS_ALL]
    row = unified.first()
    assert (row["ride_id"], row["start_station_id"], row["member_casual"]) == (None, "72", "member")
    assert row["started_at"] == dt.datetime(2014, 1, 1) and row["trip_duration"] == 600


def test_quality_limits(spark):
    seconds = {1: 59, 2: 60, 3: 86_400, 4: 86_401, 5: None}
    days = {6: (2012, 12, 31), 7: (2013, 1, 1), 8: (2030, 12, 31), 9: (2031, 1, 1)}
    rows = [trip(n, trip_duration=s) for n, s in seconds.items()]
    rows += [trip(n, started_at=dt.datetime(*d, 23, 59)) for n, d in days.items()]
    rows.append(trip(10, started_at=None))
    kept = rides.qualifying(frame(spark, *rows)).select("_source_row_number").collect()
    assert {r[0] for r in kept} == {2, 3, 7, 8}


def test_unknown_station_leaves_a_null_key(spark):
    trips = frame(spark, trip(1), trip(2, start_station_name="Out", start_lat=10.0), trip(3, end_station_name=None))
    dim = stations.dim_station(trips, NYC)
    fact = {r["_source_row_number"]: r for r in rides.fact_ride(trips, dim).collect()}
    assert len(fact) == 3
    assert fact[2]["start_station_sk"] is None and fact[2]["end_station_sk"] is not None
    assert fact[3]["end_station_sk"] is None
    assert fact[1]["start_date_sk"] == 20160504 and fact[1]["start_hour"] == 8
    checks = rides.rides_without_station(rides.fact_ride(trips, dim)).first()
    assert tuple(checks) == (1, 1)


def test_load_is_idempotent_and_keeps_duplicates_of_one_batch(spark):
    batch = frame(spark, trip(1), trip(1), trip(2))
    assert unseen(batch, None).count() == 3
    assert unseen(batch, batch).count() == 0
    assert unseen(frame(spark, trip(2), trip(3)), batch).count() == 1


def test_rows_without_a_file_load_every_time(spark):
    batch = frame(spark, trip(1, _source_file=None))
    assert unseen(batch, batch).count() == 1


def test_repeated_trips(spark):
    began = dt.datetime(2015, 1, 1)
    trips = frame(
        spark,
        trip(1, ride_id="x"), trip(2, ride_id="x", _source_file="other"), trip(3, ride_id="y"),
        trip(4, bikeid=7, started_at=began), trip(5, bikeid=7, started_at=began), trip(6, bikeid=8),
    )
    found = {(r["ride_id"], r["bikeid"]): (r["trips"], r["source_files"]) for r in repeated_trips(trips).collect()}
    assert found == {("x", None): (2, 2), (None, 7): (2, 1)}
    assert drop_repeated_trips(trips).count() == 4
    unknown = frame(spark, trip(7), trip(8), trip(9, bikeid=7, started_at=None))
    assert drop_repeated_trips(unknown).count() == 3


def test_rides_by_year_counts_each_ride(spark):
    trips = frame(spark, trip(1), trip(2), trip(3, started_at=dt.datetime(2022, 1, 17)))
    fact = rides.qualifying(trips).select(
        F.date_format("started_at", "yyyyMMdd").cast("int").alias("start_date_sk")
    )
    years = rides.rides_by_year(fact, calendar.dim_dates(spark)).collect()
    assert [tuple(r) for r in years] == [(2016, 2), (2022, 1)]


def test_only_trips_whose_hash_repeats_are_grouped_by_their_keys(spark):
    trips = spark.range(1000).selectExpr(
        "if(id < 3, 'twice', CAST(id AS STRING)) AS ride_id", "id AS bikeid", "TIMESTAMP_NTZ'2014-01-01' AS started_at",
        "concat('f', id % 2) AS _source_file")
    found = repeated_trips(trips)
    assert "LeftSemi" in found._jdf.queryExecution().executedPlan().toString()
    assert [(r["ride_id"], r["trips"], r["source_files"]) for r in found.collect()] == [("twice", 3, 2)]
