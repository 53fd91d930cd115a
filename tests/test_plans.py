"""The physical plans the jobs are written for."""

import re

import pytest
from pyspark.sql import functions as F

from pedalytics.config import NYC
from pedalytics.operators.joins import unseen
from pedalytics.plans import reports, rides
from pedalytics.plans.warehouse import Warehouse
from pedalytics.sinks.tables import append_bucketed
from pedalytics.sources import driver_tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def house(spark, tmp_path_factory):
    house = Warehouse(spark, str(tmp_path_factory.mktemp("plans")))
    house.load_trips_from(driver_tables.staging(spark, SF, NYC), NYC)
    house.build_dates()
    house.build_stations(NYC)
    house.build_fact(NYC, full_reload=True)
    return house


def plan(df, run=False):
    if run:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def scans(text, column):
    return len(re.findall(rf"FileScan parquet \[[^\]]*\b{column}\b", text))


def test_ridership_scans_the_fact_once_and_only_three_columns(house):
    text = plan(house.ridership_over_time(NYC))
    assert scans(text, "trip_duration_min") == 1 and "BroadcastHashJoin" in text
    read = re.search(r"ReadSchema: (struct<[^>]*trip_duration_min[^>]*>)", text).group(1)
    assert sorted(re.findall(r"(\w+):", read)) == ["member_casual", "start_date_sk", "trip_duration_min"]


def test_reports_scan_the_fact_once(house):
    for df in (reports.station_activity(house.fact(NYC)), reports.route_totals(house.fact(NYC))):
        text = plan(df)
        assert scans(text, "trip_duration_min") == 1 and "SinglePartition" not in text


def test_only_distinct_counts_are_ranked_in_one_task(house):
    text = plan(house.top_routes(NYC))
    single = text.split("Exchange SinglePartition")
    assert len(single) == 2
    assert re.match(r"[^\n]*\n[^\n]*HashAggregate\(keys=\[total_trips#\d+L?\]", single[1])


def test_quality_filters_reach_the_scan(spark, house):
    execution = rides.qualifying(house.trips(NYC))._jdf.queryExecution()
    text = spark._jvm.PythonSQLUtils.explainString(execution, "formatted")
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(trip_duration,60)" in pushed
    assert "GreaterThanOrEqual(started_at" in pushed


def test_stored_dimension_is_broadcast_by_size_and_shuffled_beyond(spark, house):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        small = plan(rides.fact_ride(house.trips(NYC), house.stations(NYC)))
        assert small.count("BroadcastHashJoin") == 2
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10b")
        large = rides.fact_ride(house.trips(NYC), house.stations(NYC))
        assert "BroadcastHashJoin" not in plan(large) and plan(large).count("SortMergeJoin") == 2
        assert large.count() == house.fact(NYC).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_station_build_shuffles_counts_only(house):
    from pedalytics.plans import stations

    text = plan(stations.dim_station(house.trips(NYC), NYC))
    for before in text.split("Exchange hashpartitioning")[1:]:
        assert "Aggregate" in before.split("\n")[1]


def test_stations_are_built_by_two_scans(house):
    from pedalytics.operators import quantile
    from pedalytics.plans import stations

    seen = stations.observations(house.trips(NYC), NYC)
    stats = stations.station_stats(seen)
    brackets = house.spark.createDataFrame([], "station_name string, axis string, lo double, hi double")
    keys = ["station_name", "axis"]
    counts = quantile.counts_in_brackets(stations.by_axis(seen, "position"), keys, "position", brackets)
    for one in (stats, counts):
        text = plan(one)
        assert scans(text, "start_station_name") == 1
        for before in text.split("Exchange hashpartitioning")[1:]:
            assert "HashAggregate" in before.split("\n")[1]
    assert "FileScan" in plan(stations.dim_station(house.trips(NYC), NYC))
    assert scans(plan(stations.dim_station(house.trips(NYC), NYC)), "start_station_name") == 0


def test_latest_log_rows_are_found_without_a_sort(spark):
    from pedalytics.plans import audit

    log = spark.createDataFrame(
        [(1, "a", "FAILED"), (2, "a", "SUCCESS"), (3, "b", "SUCCESS"), (3, "b", "FAILED"), (None, "c", "FAILED"),
         (5, None, "FAILED"), (5, None, "FAILED"), ((1 << 63) - 1, "d", "SUCCESS"), (-(1 << 63), "d", "FAILED")],
        "log_id long, output_file string, status string")
    latest = audit.latest_status(log)
    assert not re.search(r"\bSort\b|SortAggregate|SortMergeJoin", plan(latest))
    rows = latest.collect()
    assert len(rows) == 5 and {r["output_file"] for r in rows} == {"a", "b", "c", None, "d"}
    assert {r["output_file"]: r["status"] for r in rows if r["output_file"] in ("a", "d")} == {"a": "SUCCESS", "d": "SUCCESS"}


def test_bucketed_tables_are_antijoined_without_a_shuffle(spark, house):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    keys = ("_source_file", "_source_row_number")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        append_bucketed(house.trips(NYC).limit(0), "all_trips", 8, *keys)
        append_bucketed(house.trips(NYC).filter("trip_duration < 5000"), "all_trips", 8, *keys)
        append_bucketed(house.trips(NYC), "new_trips", 8, *keys)
        fresh = unseen(spark.table("new_trips"), spark.table("all_trips"))
        assert "Exchange" not in plan(fresh) and "LeftAnti" in plan(fresh)
        assert fresh.count() == house.trips(NYC).filter("trip_duration >= 5000").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE IF EXISTS all_trips")
        spark.sql("DROP TABLE IF EXISTS new_trips")


def test_fact_is_laid_out_by_month(spark, house):
    files = {f.split("FACT_RIDE/")[1].rsplit("/", 1)[0] for f in house.fact(NYC).inputFiles()}
    assert all(re.fullmatch(r"start_year=\d{4}/start_month=\d{1,2}", f) for f in files)
    pruned = house.fact(NYC).filter("start_year = 2014 and start_month = 3")
    assert "PartitionFilters: [isnotnull(start_year" in plan(pruned)
    assert pruned.filter("start_date_sk not between 20140301 and 20140331").count() == 0


def test_running_totals_and_ordinals_use_many_tasks(spark):
    from pedalytics.operators.prefix import ordinals, running_total
    from pedalytics.operators.ranking import with_position

    rows = [(k, n, (n * 7) % 11 if n % 13 else None) for k in ("a", None) for n in range(400)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    got = {(r["k"], r["n"]): r["t"] for r in running_total(df, ["k"], [F.asc("n")], F.col("v"), "t", 7).collect()}
    for k in ("a", None):
        total = 0
        for key, n, v in sorted((r for r in rows if r[0] == k), key=lambda r: r[1]):
            assert got[k, n] == total
            total += v or 0
    assert [r["n"] for r in ordinals(df.filter("k = 'a'"), [F.desc("n")], "o", 5).orderBy("o").collect()] == list(range(399, -1, -1))
    tied = spark.range(1000).select(F.lit(3).alias("c"), F.col("id").cast("string").alias("name"))
    placed = with_position(tied, "c", "name", "p")
    assert [r["name"] for r in placed.orderBy("p").collect()] == sorted(str(i) for i in range(1000))
    many = ordinals(tied, [F.desc("c"), F.asc("name")], "p", 6)
    assert many.select("p").distinct().count() == 1000
    ranges = tied.repartitionByRange(6, F.desc("c"), F.asc("name")).select(F.spark_partition_id().alias("r")).distinct().count()
    assert ranges == 6  # one tie, six tasks


def test_views_scan_the_fact_once(spark, tmp_path):
    from pedalytics.config import NYC
    from pedalytics.plans import reports, views

    fact = spark.range(3000).selectExpr(
        "id % 7 AS start_station_sk", "nullif(id % 5, 4) AS end_station_sk", "CAST(20140101 + id % 28 AS INT) AS start_date_sk",
        "CASE id % 3 WHEN 0 THEN 'member' WHEN 1 THEN 'casual' END AS member_casual", "CAST(id % 50 AS DECIMAL(10,2)) AS trip_duration_min")
    dim = spark.range(9).selectExpr("id AS station_sk", "concat('S', id) AS station_name", "1.5D AS station_lat", "2.5D AS station_lng", "'BOTH' AS availability")
    fact.write.parquet(str(tmp_path / "fact"))
    dim.write.parquet(str(tmp_path / "dim"))
    fact, dim = spark.read.parquet(str(tmp_path / "fact")), spark.read.parquet(str(tmp_path / "dim"))
    for sql, frame in ((views.top_routes(str(tmp_path / "fact"), str(tmp_path / "dim"), NYC), reports.top_routes(fact, dim)),
                       (views.top_stations(str(tmp_path / "fact"), str(tmp_path / "dim")), reports.top_stations(fact, dim))):
        view = spark.sql(sql)
        assert view.columns == frame.columns
        assert sorted(map(str, view.collect())) == sorted(map(str, frame.collect()))
        plan = view._jdf.queryExecution().executedPlan().toString()
        final = plan[: plan.find("Initial Plan")] if "Initial Plan" in plan else plan
        assert final.count("/fact]") <= 1, final
