import random
import statistics

import pytest
from pyspark.sql import functions as F

from pedalytics.config import JERSEY_CITY, LAYOUT_OF_KEY_BY_HEADER, NYC
from pedalytics.operators import quantile
from pedalytics.plans import stations
from trips import NYC_V1, frame, trip


def by_name(dim):
    return {r["station_name"]: r for r in dim.collect()}


def test_spellings_are_one_station_and_eras_keep_their_ids(spark):
    trips = frame(
        spark,
        trip(1, start_station_name=" w 21 st ", start_station_id="9", start_lat=40.1),
        trip(2, start_station_name="W 21 ST", start_station_id="10", start_lat=40.4),
        trip(3, start_station_name="w 21 St", start_station_id="77", start_lat=40.2, _source_file=NYC_V1),
        trip(4, start_station_name="W 21 ST", start_station_id=None, start_lat=40.5),
    )
    station = by_name(stations.dim_station(trips, NYC))["W 21 ST"]
    assert station["modern_station_id"] == "9"  # greatest as text
    assert station["legacy_station_id"] == "77"
    assert station["availability"] == "BOTH" and station["trip_observations"] == 4
    assert station["station_lat"] == statistics.median([40.1, 40.4, 40.2, 40.5])
    assert station["lat_variance"] == 0.4


def test_boxes(spark):
    trips = frame(
        spark,
        trip(1, start_station_name="Zero", start_lat=0.0),
        trip(2, start_station_name="North", start_lat=41.5),
        trip(3, start_station_name="Edge", start_lat=42.0, start_lng=-75.0),
        trip(4, start_station_name=None),
        trip(5, start_station_name="", start_lat=None),
    )
    assert set(by_name(stations.dim_station(trips, NYC))) == {"NORTH", "EDGE", "B"}
    assert set(by_name(stations.dim_station(trips, JERSEY_CITY))) == {"B"}


def test_label_maps_give_the_same_stations(spark):
    trips = frame(spark, trip(1), trip(2, _source_file=NYC_V1), trip(3, start_station_name=""))
    columns = ["station_sk", "station_name", "availability", "station_lat", "trip_observations"]
    one = stations.dim_station(trips, NYC).select(columns).collect()
    two = stations.dim_station(trips, NYC, LAYOUT_OF_KEY_BY_HEADER).select(columns).collect()
    assert sorted(one) == sorted(two) and {r["station_name"] for r in one} == {"A", "B", ""}


def test_keys_survive_a_rebuild_with_new_stations(spark):
    first = by_name(stations.dim_station(frame(spark, trip(1)), NYC))
    more = frame(spark, trip(1), trip(2, start_station_name="0 First"))
    assert by_name(stations.dim_station(more, NYC))["A"]["station_sk"] == first["A"]["station_sk"]


GROUPS = {
    "hot": lambda rng: [40 + rng.random() * 1e-7 for _ in range(30_001)],
    "even": lambda rng: [rng.uniform(0, 100) for _ in range(1_000)],
    "two_ends": lambda rng: [0.0, 100.0],
    "one": lambda rng: [55.5],
    "ties": lambda rng: [1.0] * 500 + [2.0] * 500,
    "lower_half": lambda rng: [3.0] * 501 + [99.0] * 500,
}


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_median_of_doubles_is_exact_for_hot_and_odd_groups(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(7)
    groups = {k: make(rng) for k, make in GROUPS.items()}
    rows = [(k, v) for k, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double")
    got = quantile.median_of_doubles(df, ["k"], "v", F.lit(0.0), F.lit(100.0), "m").collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["k"]: r["m"] for r in got} == {k: statistics.median(v) for k, v in groups.items()}


def sketched_brackets(df, k="k", v="v"):
    found = df.groupBy(k).agg(quantile.sketch(v).alias("s")).select(k, quantile.bracket("s").alias("b"))
    return found.select(k, "b.lo", "b.hi")


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_median_in_brackets_is_exact_for_hot_and_odd_groups(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    rng = random.Random(7)
    groups = {k: make(rng) for k, make in GROUPS.items()}
    df = spark.createDataFrame([(k, v) for k, values in groups.items() for v in values], "k string, v double")
    got = quantile.median_in_brackets(df, ["k"], "v", sketched_brackets(df), "m").collect()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {r["k"]: r["m"] for r in got} == {k: statistics.median(v) for k, v in groups.items()}


def test_brackets_that_miss_are_made_good(spark):
    groups = {"below": (0.0, 1.0), "above": (50.0, 60.0), "between": (3.4, 3.6), "none": (None, None)}
    values = {k: [1.0, 2.0, 3.0, 4.0, 5.0, 40.0] for k in groups}
    df = spark.createDataFrame([(k, v) for k in groups for v in values[k]], "k string, v double")
    brackets = spark.createDataFrame([(k, *b) for k, b in groups.items()], "k string, lo double, hi double")
    got = quantile.median_in_brackets(df, ["k"], "v", brackets, "m").collect()
    assert {r["k"]: r["m"] for r in got} == dict.fromkeys(groups, 3.5)


def test_median_in_brackets_leaves_nulls_out_and_puts_nan_last(spark):
    nan, inf = float("nan"), float("inf")
    rows = [("a", v) for v in (None, None, 1.0, 2.0, 3.0, 100.0)] + [("b", v) for v in (1.0, 2.0, nan)]
    rows += [("c", None), ("d", -inf), ("d", -inf), ("d", 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = quantile.median_in_brackets(df, ["k"], "v", sketched_brackets(df), "m").collect()
    assert {r["k"]: r["m"] for r in got} == {"a": 2.5, "b": 2.0, "d": -inf}


def test_a_bracket_leaves_few_values_to_count(spark):
    df = spark.range(200_000).selectExpr("'k' AS k", "double(id) AS v")
    counts = quantile.counts_in_brackets(df, ["k"], "v", sketched_brackets(df)).collect()
    assert len(counts) < 16_000 and sum(r[quantile.COUNT] for r in counts) == 200_000


def test_median_leaves_nulls_out_and_puts_nan_last(spark):
    nan = float("nan")
    rows = [("a", v) for v in (None, None, None, 1.0, 2.0, 3.0, 100.0)] + [("b", v) for v in (1.0, 2.0, nan)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = quantile.median_of_doubles(df, ["k"], "v", F.lit(0.0), F.lit(100.0), "m").collect()
    assert {r["k"]: r["m"] for r in got} == {"a": 2.5, "b": 2.0}


def test_folding_bounds_the_values_left_per_group(spark):
    df = spark.range(200_000).selectExpr("'k' AS k", "double(id) / 2000 AS v")
    bucket = F.floor(F.col("v") / F.lit(100.0 / quantile.BUCKETS))
    middle = quantile.middle_buckets(df, ["k"], bucket)
    left = quantile.histogram(quantile.fold_outside(df, ["k"], "v", bucket, middle), ["k"], "v").collect()
    assert len(left) < 12 and sum(r[quantile.COUNT] for r in left) == 200_000


def test_observations_take_both_ends(spark):
    seen = stations.observations(frame(spark, trip(1)), NYC).collect()
    assert sorted(r["station_name"] for r in seen) == ["A", "B"]
    assert {r["source_schema"] for r in seen} == {"MODERN"}
