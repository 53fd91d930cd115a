import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F

from pedalytics.config import JERSEY_CITY, NYC, Compat
from pedalytics.operators import ranking
from pedalytics.plans import calendar, reports, rides, stations
from trips import frame, trip


@pytest.fixture(scope="module")
def star(spark):
    rows = [trip(n) for n in range(1, 4)]
    rows += [trip(n, end_station_name="A", end_lat=40.7, end_lng=-74.0) for n in (4, 5)]
    rows += [trip(6, start_station_name="C", end_station_name="A", trip_duration=1201)]
    rows += [trip(7, start_station_name="Quiet", end_station_name="Quiet", trip_duration=10)]
    rows += [trip(8, started_at=dt.datetime(2022, 1, 17), member_casual="casual")]
    rows += [trip(9, started_at=dt.datetime(2016, 6, 1)), trip(10, started_at=dt.datetime(2016, 8, 1))]
    trips = frame(spark, *rows).cache()
    dim = stations.dim_station(trips, NYC).cache()
    return rides.fact_ride(trips, dim).cache(), dim


def test_growth_is_by_rows(spark, star):
    fact, _ = star
    report = reports.ridership_over_time(fact, calendar.dim_dates(spark)).collect()
    member = [r for r in report if r["member_casual"] == "member"]
    assert [(r["year_month"], r["total_rides"], r["prev_month_rides"]) for r in member] == [
        ("2016-05", 6, None), ("2016-06", 1, 6), ("2016-08", 1, 1),
    ]
    assert [r["mom_growth_pct"] for r in member] == [None, decimal.Decimal("-83.33"), decimal.Decimal("0.00")]
    assert member[0]["median_duration_min"] == decimal.Decimal("10.00")
    assert member[0]["avg_duration_min"] == decimal.Decimal("11.67")  # 5 x 10.00 and 20.02


def test_year_back_is_twelve_rows(spark):
    monthly = spark.createDataFrame(
        [(f"{2000 + n // 12}-{n % 12 + 1:02d}", "m", n + 1) for n in range(14) if n != 5],
        "year_month string, member_casual string, total_rides long",
    )
    last = {r["year_month"]: r["same_month_prev_year"] for r in reports.with_growth(monthly).collect()}
    assert last["2001-01"] is None and last["2001-02"] == 1


def test_doubled_holiday_counts_twice_on_request(spark, star):
    fact, _ = star
    for fanout, n in ((False, 1), (True, 2)):
        dates = calendar.dim_dates(spark, compat=Compat(holiday_fanout=fanout))
        report = reports.monthly_ridership(fact, dates)
        assert report.filter("member_casual = 'casual'").first()["total_rides"] == n
        counted = report.agg(F.sum("total_rides")).first()[0]
        assert counted == fact.count() + (n - 1)


def test_stations(star):
    fact, dim = star
    rows = {r["station_name"]: r for r in reports.top_stations(fact, dim).collect()}
    assert (rows["A"]["total_departures"], rows["A"]["total_arrivals"]) == (8, 3)
    assert rows["A"]["flow_type"] == "NET EXPORTER" and rows["A"]["activity_rank"] == 1
    assert rows["B"]["flow_type"] == "NET IMPORTER"
    quiet = rows["QUIET"]
    assert (quiet["total_activity"], quiet["flow_type"], quiet["avg_departure_duration_min"]) == (
        0, "BALANCED", None,
    )
    assert sum(r["total_departures"] for r in rows.values()) == fact.filter("start_station_sk is not null").count()
    for count, rank in (("total_departures", "departure_rank"), ("total_arrivals", "arrival_rank")):
        ordered = sorted({r[count] for r in rows.values()}, reverse=True)
        assert all(r[rank] == ordered.index(r[count]) + 1 for r in rows.values())


def test_routes(star):
    fact, dim = star
    rows = {(r["start_station"], r["end_station"]): r for r in reports.top_routes(fact, dim).collect()}
    assert rows["A", "A"]["is_round_trip"] and not rows["A", "B"]["is_round_trip"]
    assert [rows[k]["route_rank"] for k in (("A", "B"), ("A", "A"), ("C", "A"))] == [1, 2, 3]
    assert rows["C", "A"]["median_duration_min"] == decimal.Decimal("20.02")
    assert reports.top_routes(fact, dim, JERSEY_CITY).columns[2:4] == ["station_lat", "station_lng"]
    assert reports.top_routes_by_rank(reports.top_routes(fact, dim), 2).count() == 2


def test_median_between_two_durations_rounds_half_up(spark, star):
    _, dim = star
    rows = frame(spark, trip(1, trip_duration=61), trip(2, trip_duration=62))  # 1.02 and 1.03
    fact = rides.fact_ride(rows, dim)
    assert reports.route_totals(fact).first()["median_duration_min"] == decimal.Decimal("1.03")


def test_ranks_and_positions(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 9), ("d", 1)], "k string, n long")
    ranked = ranking.with_dense_ranks(df, rank="n").collect()
    assert {r["k"]: r["rank"] for r in ranked} == {"c": 1, "a": 2, "b": 2, "d": 3}
    placed = ranking.with_position(df, "n", "k", "at").collect()
    assert {r["k"]: r["at"] for r in placed} == {"c": 1, "a": 2, "b": 3, "d": 4}


def test_ranks_are_broadcast_whatever_the_threshold(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = ranking.with_dense_ranks(df, rank="n")
        assert "BroadcastHashJoin" in ranked._jdf.queryExecution().executedPlan().toString()
        assert {(r["n"], r["rank"]) for r in ranked.collect()} == {(2, 1), (1, 2), (0, 3)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
