"""The ingest's commit protocol and loads that touch few files."""

import gzip
import os

import pytest
from pyspark.sql import functions as F
from test_files import HEADER, modern, part

from pedalytics.config import MODERN, NYC
from pedalytics.operators.joins import row_bitmaps, unseen, unseen_by_file, without_rows
from pedalytics.plans import audit, ingest
from pedalytics.plans.warehouse import Warehouse
from pedalytics.schemas import MANIFEST_FILE
from pedalytics.session import stage
from pedalytics.sources import csv_parts


def name(n):
    return f"nyc_dc497b4333c4_part{n:04d}.csv.gz"


@pytest.fixture
def house(spark, tmp_path):
    inbox = str(tmp_path / "inbox")
    house = Warehouse(spark, str(tmp_path / "wh"))

    def add(*numbers):
        for n in numbers:
            part(inbox, name(n), [modern(n * 10 + i) for i in range(n)])
        rows = [(name(n), "nyc", "nyc", "dc497b4333c4", 100, ["a.csv"], "2024") for n in numbers]
        house.register_parts(spark.createDataFrame(rows, MANIFEST_FILE))

    return house, inbox, add


def staged(house):
    return sorted((r["_source_file"], r["n"]) for r in house.staging(NYC, MODERN).groupBy("_source_file").agg(F.count("*").alias("n")).collect())


def test_a_broken_run_leaves_no_rows(spark, house):
    house, inbox, add = house
    add(3)
    queue = audit.work_queue(house.manifest(), house.log()).collect()
    table = house.path("STAGING_NYC", "TRIPS_MODERN")
    ingest.load_layout(spark, queue, inbox, table, MODERN, 7)  # dies before its log row
    assert staged(house) == []
    add(2)
    assert house.ingest(inbox).success == 2
    assert staged(house) == [(name(2), 2), (name(3), 3)] and house.load_trips(NYC).rows == 5
    assert [os.path.basename(p) for p in ingest.uncommitted(spark, table, house.log())] == ["_load=7"]
    assert house.drop_uncommitted(NYC, MODERN) == 1 and staged(house) == [(name(2), 2), (name(3), 3)]


def test_bad_parts_cost_one_more_scan(spark, house, monkeypatch):
    house, inbox, add = house
    add(*range(1, 9))
    whole = gzip.compress((HEADER + modern(1) + "\n").encode() * 2000)
    for n, data in ((2, b"no gzip"), (3, whole[: len(whole) // 2]), (4, whole[:-6] + b"x" * 6)):
        with open(f"{inbox}/{name(n)}", "wb") as f:
            f.write(data)
    os.remove(f"{inbox}/{name(5)}")
    scans, read = [], csv_parts.read_parts
    monkeypatch.setattr(csv_parts, "read_parts", lambda spark, paths, layout: scans.append(len(paths)) or read(spark, paths, layout))
    result = house.ingest(inbox)
    assert (result.success, result.failed, scans) == (4, 4, [8, 4])
    errors = {r["output_file"]: r["error_message"] for r in house.log().filter("status = 'FAILED'").collect()}
    assert errors[name(5)] == "the part is not there" and errors[name(3)] == "the part ends within its gzip stream"
    assert "no gzip stream" in errors[name(2)] and "no gzip stream" in errors[name(4)]
    assert staged(house) == [(name(n), n) for n in (1, 6, 7, 8)]


def test_a_failure_of_no_part_ends_the_run(spark, house, monkeypatch):
    house, inbox, add = house
    add(1, 2)

    def full(*_):
        raise OSError("no space left on device")

    monkeypatch.setattr(csv_parts, "read_parts", full)
    with pytest.raises(OSError, match="no space"):
        house.ingest(inbox)
    assert house.log().count() == 0
    monkeypatch.undo()
    assert house.ingest(inbox).success == 2


def test_slices_are_committed_one_by_one(spark, house, monkeypatch):
    house, inbox, add = house
    add(1, 2, 3, 4, 5)
    monkeypatch.setattr(ingest, "SLICE", 2)
    load, calls = ingest.load_layout, []

    def third_breaks(*a):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("lost")
        return load(*a)

    monkeypatch.setattr(ingest, "load_layout", third_breaks)
    with pytest.raises(OSError):
        house.ingest(inbox)
    assert [n for n, _ in staged(house)] == [name(n) for n in (1, 2, 3, 4)]
    assert house.ingest(inbox).total == 1 and len(staged(house)) == 5


def test_force_and_reset(spark, house):
    house, inbox, add = house
    add(1, 2)
    os.remove(f"{inbox}/{name(2)}")
    assert house.ingest(inbox).failed == 1
    assert house.ingest(inbox, max_attempts=1).total == 0
    part(inbox, name(2), [modern(20), modern(21)])
    assert house.ingest(inbox, max_attempts=1, reset_failed=True).success == 1
    part(inbox, name(1), [modern(30), modern(31), modern(32)])  # another content under the same name
    assert house.ingest(inbox).total == 0
    assert house.ingest(inbox, force=True).success == 2
    assert staged(house) == [(name(1), 3), (name(2), 2)]


def test_archive(spark, house, tmp_path):
    house, inbox, add = house
    add(1, 2)
    house.ingest(inbox)
    add(3)
    archive = str(tmp_path / "done")
    assert (house.archive_loaded(inbox, archive), house.archive_loaded(inbox, archive)) == (2, 0)
    assert sorted(f for f in os.listdir(archive) if not f.startswith(".")) == [name(1), name(2)]
    assert house.ingest(inbox).success == 1 and house.archive_loaded(inbox) == 1
    assert not [f for f in os.listdir(inbox) if f.endswith(".gz")]


def test_a_table_without_layout_fails_alone(spark, house):
    house, inbox, add = house
    add(1)
    rows = house.manifest().withColumns({"output_file": F.lit("odd.csv.gz"), "sf_table": F.lit("TRIPS_ODD")})
    stage(rows, "odd-part").write.mode("append").parquet(house.path("LOGGING", "STAGE_MANIFEST"))
    result = house.ingest(inbox)
    assert (result.success, result.failed) == (1, 1)
    bad = house.log().filter("status = 'FAILED'").first()
    assert bad["error_message"] == "no column layout for table 'TRIPS_ODD'" and bad["rows_loaded"] == 0


def keyed(spark, *rows):
    return spark.createDataFrame(list(rows), "_source_file string, _source_row_number long, v string")


def test_unseen_by_file_agrees_with_unseen(spark):
    target = keyed(spark, *[(f, n, "old") for f in "abc" for n in range(5)], ("d", 1, "old"), ("d", 3, "old"))
    source = keyed(
        spark, *[(f, n, "new") for f in "ab" for n in range(5)], *[("d", n, "new") for n in (1, 2, 3, 3, 4, 4)],
        ("e", 1, "new"), ("e", 1, "new"), ("c", 7, "new"), (None, 1, "new"), ("e", None, "new"), ("a", 2, "twice"))
    got = sorted(map(tuple, unseen_by_file(source, target).collect()), key=repr)
    assert got == sorted(map(tuple, unseen(source, target).collect()), key=repr) and len(got) == 8
    assert unseen_by_file(source, None) is source


def test_new_files_are_not_joined_with_the_target(spark, tmp_path):
    spark.range(200_000).select(
        F.concat(F.lit("f"), (F.col("id") % 500).cast("string")).alias("_source_file"),
        F.col("id").alias("_source_row_number"), F.lit("old").alias("v")).write.parquet(str(tmp_path / "target"))
    target = spark.read.parquet(str(tmp_path / "target"))
    plan = unseen_by_file(keyed(spark, ("g1", 1, "x"), ("f1", 1, "x")).filter("_source_file = 'g1'"), target)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "/target" not in text and plan.count() == 1
    # Of a file that is partly there only its own rows are shuffled.
    partly = unseen_by_file(keyed(spark, ("f1", 1, "x"), ("f1", 200_001, "x")), target)
    text = partly._jdf.queryExecution().executedPlan().toString()
    scan = text[: text.index("/target")]
    assert "BroadcastHashJoin" in scan and partly.count() == 1


def test_compaction_bounds_the_files_of_a_month(spark, tmp_path):
    from pedalytics.sinks import tables

    path = str(tmp_path / "fact")
    for n in range(6):
        days = spark.range(200).selectExpr(
            f"CAST(20140101 + 100 * (id % {9 if n < 2 else 3}) + id % 28 AS INT) AS start_date_sk",
            f"id + {n * 1000} AS ride_sk")
        tables.write_fact(days, path, "FACT_RIDE")
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    crowded = {(r["start_year"], r["start_month"]) for r in tables.crowded_months(spark, path, 4).collect()}
    assert crowded == {(2014, 1), (2014, 2), (2014, 3)}
    untouched = {f for f in os.listdir(f"{path}/start_year=2014/start_month=5")}
    assert tables.compact_fact(spark, path, 4) == 3 and tables.compact_fact(spark, path, 4) == 0
    assert tables.crowded_months(spark, path, 2).count() == 0
    assert {f for f in os.listdir(f"{path}/start_year=2014/start_month=5")} == untouched
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before


def test_compaction_bounds_the_rows_of_a_task(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from pedalytics.sinks import tables

    path = str(tmp_path / "fact")
    # January: all on one day; February: evenly over days; from March on small months.
    for n in range(4):
        january = spark.range(1500).selectExpr("20140105 AS start_date_sk", f"id + {n * 10_000} AS ride_sk")
        february = spark.range(700).selectExpr("CAST(20140201 + id % 28 AS INT) AS start_date_sk", f"id + {n * 10_000 + 2000} AS ride_sk")
        small = spark.range(200).selectExpr("CAST(20140301 + 100 * (id % 4) AS INT) AS start_date_sk", f"id + {n * 10_000 + 4000} AS ride_sk")
        tables.write_fact(january.unionByName(february).unionByName(small), path, "FACT_RIDE")
    before = sorted(map(tuple, spark.read.parquet(path).collect()))
    monkeypatch.setattr(tables, "FILE_ROWS", 1000, raising=False)
    assert tables.compact_fact(spark, path, 3) == 6
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == before
    files = spark.read.parquet(path).groupBy("start_month", F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("start_date_sk").alias("lo"), F.max("start_date_sk").alias("hi")).collect()
    of = {m: sorted([r for r in files if r["start_month"] == m], key=lambda r: r["lo"]) for m in range(1, 7)}
    assert [len(of[m]) for m in range(1, 7)] == [3, 3, 1, 1, 1, 1]  # 6,000, 2,800 and 200 rows
    assert max(r["n"] for r in of[1]) < 2300 and max(r["n"] for r in of[2]) < 1100
    assert all(a["hi"] <= b["lo"] for a, b in zip(of[2], of[2][1:]))  # runs of days


def test_rows_are_left_out_by_bitmaps(spark):
    numbers = [-40_000, -1, 0, 1, 7, 8, 32_767, 32_768, 32_769, 65_536, 1 << 40]
    target = keyed(spark, *[("a", n, "old") for n in numbers], ("b", 2, "old"), ("a", None, "old"))
    source = keyed(spark, *[(f, n + d, "new") for f in ("a", "b") for n in numbers for d in (0, 0, 1)], (None, 1, "new"), ("a", None, "new"))
    left = without_rows(source, row_bitmaps(target, "_source_file", "_source_row_number"), "_source_file", "_source_row_number")
    assert sorted(map(tuple, left.collect()), key=repr) == sorted(map(tuple, unseen(source, target).collect()), key=repr)
