import glob
import gzip
import hashlib
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from pedalytics.config import JERSEY_CITY, LEGACY_V1, LEGACY_V2, MODERN, NYC
from pedalytics.plans.warehouse import Warehouse
from pedalytics.schemas import MANIFEST_FILE, RAW_HEADER
from pedalytics.session import one_file_per_task, scratch_dir, stage
from pedalytics.sinks import parts
from pedalytics.sinks.parts import write_manifest, write_parts, write_report
from pedalytics.sources import csv_parts, files
from pedalytics.streaming.incremental import start_incremental_load
from pedalytics.workload import round_trips


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8") as f:
        f.write(text)


def modern(n, **values):
    base = dict(
        ride_id=f"r{n}", rideable_type="classic", started_at=f"2021-05-0{n % 9 + 1} 08:00:00",
        ended_at=f"2021-05-0{n % 9 + 1} 08:10:00", start_station_name="A", start_station_id="1",
        end_station_name="B", end_station_id="2", start_lat="40.7", start_lng="-74.0",
        end_lat="40.8", end_lng="-73.95", member_casual="member",
    ) | values
    return ",".join(base[c] for c in RAW_HEADER[MODERN])


HEADER = ",".join(RAW_HEADER[MODERN]) + "\n"


def part(folder, name, lines, header=HEADER):
    path = f"{folder}/{name}"
    write(path, header + "".join(line + "\n" for line in lines))
    return path


def test_edge_rows(spark, tmp_path):
    header = ",".join(RAW_HEADER[LEGACY_V2]) + "\n"
    good = '600,6/1/2015 0:00,6/1/2015 0:10,72,"a, ""b""",40.7,-74,79,"two\nlines",40.7,-74,5,Customer,1985.0,1'
    name = "nyc_473144999085_part0001.csv.gz"
    part(
        tmp_path,
        name,
        [
            good,
            good.replace("600", "abc"),
            "600,2015-06-01 00:00:00,2015-06-01 00:10:00,72,NULL",
            good.replace("Customer", "null") + ",extra",
            good.replace("6/1/2015 0:10", "later"),
        ],
        header,
    )
    rows = csv_parts.read_parts(spark, str(tmp_path), LEGACY_V2).orderBy("_source_row_number").collect()
    assert [r["_source_row_number"] for r in rows] == [1, 2, 3, 4, 5]
    assert [r["_error"] for r in rows] == [None, "trip_duration", None, None, "stop_time"]
    assert rows[0]["start_station_name"] == 'a, "b"' and rows[0]["end_station_name"] == "two\nlines"
    assert rows[0]["birth_year"] == 1985 and str(rows[0]["start_time"]) == "2015-06-01 00:00:00"
    assert rows[2]["start_station_name"] is None and rows[2]["gender"] is None
    assert rows[3]["user_type"] is None and rows[3]["gender"] == 1
    assert {r["_source_file"] for r in rows} == {name}
    assert csv_parts.good_rows(csv_parts.read_parts(spark, str(tmp_path), LEGACY_V2)).count() == 3


def test_rows_are_numbered_per_file(spark, tmp_path):
    for n in range(30):
        part(tmp_path, f"p{n:02d}.csv{'.gz' if n % 2 else ''}", [modern(i) for i in range(n + 1)])
    rows = csv_parts.read_parts(spark, str(tmp_path), MODERN)
    per_file = rows.groupBy("_source_file").agg(
        F.count("*").alias("n"), F.min("_source_row_number").alias("lo"), F.max("_source_row_number").alias("hi")
    )
    assert {(r["n"], r["lo"], r["hi"]) for r in per_file.collect()} == {(n, 1, n) for n in range(1, 31)}
    wrong = rows.filter(F.regexp_extract("ride_id", r"r(\d+)", 1).cast("int") + 1 != F.col("_source_row_number"))
    assert wrong.count() == 0


@pytest.fixture
def inbox(tmp_path):
    folder = str(tmp_path / "inbox")
    entries = []

    def add(name, lines, region="nyc", key="dc497b4333c4"):
        part(folder, name, lines)
        entries.append((name, region, region, key, 100, ["a.csv"], "2024"))

    add("nyc_dc497b4333c4_part0001.csv.gz", [modern(1), modern(2), modern(3, start_lat="north")])
    add("nyc_dc497b4333c4_part0002.csv.gz", [modern(4)])
    add("jersey_city_dc497b4333c4_part0001.csv.gz", [modern(5), modern(6)], "jersey_city")
    add("nyc_dc497b4333c4_part0003.csv.gz", [modern(7, start_lat="x")])
    add("nyc_dc497b4333c4_part0004.csv.gz", [])
    entries.append(("nyc_dc497b4333c4_part0009.csv.gz", "nyc", "nyc", "dc497b4333c4", 100, [], "2024"))
    bad = f"{folder}/nyc_dc497b4333c4_part0005.csv.gz"
    with open(bad, "wb") as f:
        f.write(b"this is no gzip file")
    entries.append((os.path.basename(bad), "nyc", "nyc", "dc497b4333c4", 100, [], "2024"))
    entries.append(("mars.csv.gz", "mars", "mars", "dc497b4333c4", 100, [], "2024"))
    return folder, entries


def test_ingest_and_build(spark, tmp_path, inbox):
    folder, entries = inbox
    house = Warehouse(spark, str(tmp_path / "wh"))
    write_manifest(spark.createDataFrame(entries, MANIFEST_FILE), str(tmp_path / "manifest"))
    manifest = files.read_manifest(spark, str(tmp_path / "manifest"))
    assert files.read_manifest(spark, str(tmp_path / "manifest"), "mars").count() == 1
    assert house.register_parts(manifest).rows == 7
    assert house.register_parts(manifest).rows == 0

    result = house.ingest(folder, "all")
    assert (result.total, result.success, result.failed) == (7, 4, 3)
    log = {r["output_file"]: r for r in house.log().collect()}
    one = log["nyc_dc497b4333c4_part0001.csv.gz"]
    assert (one["status"], one["rows_loaded"], one["errors_seen"], one["attempt"]) == ("SUCCESS", 2, 1, 1)
    assert one["copy_status_raw"] == "PARTIALLY_LOADED"
    assert log["nyc_dc497b4333c4_part0003.csv.gz"]["error_message"] == "every row was rejected"
    assert log["nyc_dc497b4333c4_part0004.csv.gz"]["status"] == "SUCCESS"
    assert log["nyc_dc497b4333c4_part0005.csv.gz"]["status"] == "FAILED"
    assert log["nyc_dc497b4333c4_part0009.csv.gz"]["status"] == "FAILED"
    assert len({r["log_id"] for r in log.values()}) == 7

    # A second run takes only the failed parts, and adds no row twice.
    again = house.ingest(folder, "nyc")
    assert (again.total, again.success) == (3, 0)
    assert (result.skipped, again.skipped) == (0, 3)
    given_up = house.ingest(folder, "nyc", max_attempts=2)
    assert (given_up.total, given_up.skipped) == (0, 6)
    assert house.log().filter("attempt = 2").count() == 3
    assert {r["discrepancy"] for r in house.row_count_check().collect()} == {0}

    assert house.load_layout(NYC, MODERN).rows == 3
    assert house.load_trips(NYC).rows == 0
    assert house.load_trips(JERSEY_CITY).rows == 2
    assert house.build_dates().rows == 6574
    for region, stations, fact in ((NYC, 2, 3), (JERSEY_CITY, 2, 2)):
        assert house.build_stations(region).rows == stations
        assert house.build_fact(region).rows == fact
        assert house.build_fact(region).rows == 0
    assert house.build_fact(NYC, full_reload=True).rows == 3
    house.publish_views()
    top = spark.sql("SELECT * FROM rpt_top_routes_nyc WHERE route_rank <= 10").collect()
    assert [(r["start_station"], r["end_station"], r["total_trips"]) for r in top] == [("A", "B", 3)]
    assert spark.sql("SELECT count(*) FROM v_pending_files").first()[0] == 3
    assert spark.sql("SELECT sum(total_rides) FROM rpt_ridership_over_time_jc").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM rpt_top_stations_nyc").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM v_latest_ingest_status").first()[0] == 7
    assert spark.sql("SELECT count(*) FROM v_table_row_counts").first()[0] == 2
    part(folder, "nyc_dc497b4333c4_part0010.csv.gz", [modern(70), modern(71)])
    more = [("nyc_dc497b4333c4_part0010.csv.gz", "nyc", "nyc", "dc497b4333c4", 100, [], "2024")]
    assert house.register_parts(spark.createDataFrame(more, MANIFEST_FILE)).rows == 1
    assert house.ingest(folder, "nyc", max_attempts=2).success == 1
    assert house.load_trips(NYC).rows == house.build_fact(NYC).rows == 2
    assert spark.sql("SELECT sum(total_trips) FROM rpt_top_routes_nyc").first()[0] == 5
    assert spark.sql("SELECT sum(total_rides) FROM rpt_ridership_over_time_nyc").first()[0] == 5
    assert spark.sql("SELECT count(*) FROM v_latest_ingest_status").first()[0] == 8
    later = house.load_trips(NYC, files=["nyc_dc497b4333c4_part0001.csv.gz"])
    assert later.rows == 0 and "TRIPS_ALL" in str(later)


def test_inventory_and_parts(spark, tmp_path):
    root, out = f"{tmp_path}/raw", f"{tmp_path}/parts"
    rows = [modern(n, ride_id=f"id{n}") for n in range(400)]
    write(f"{root}/2021 trips/big.csv", HEADER + "\n".join(rows) + "\n")
    for n in range(6):
        write(f"{root}/2021 trips/s{n}.csv", HEADER.upper() + modern(n) + "\n")
    write(f"{root}/JC-2021/x.csv", HEADER + modern(1) + "\n")
    write(f"{root}/odd/o.csv", "only,two\n1,2\n")
    write(f"{root}/__MACOSX/odd/._o.csv", "x\n")
    write(f"{root}/odd/blank.csv", "\n")
    write(f"{root}/zips/in.zip", "zip")
    inventory = stage(files.inventory(spark, root, tasks=4), "inventory-test").cache()
    found = {r["relative_path"]: r for r in inventory.collect()}
    assert len(found) == 11 and found["2021 trips/big.csv"]["schema_key"] == "dc497b4333c4"
    assert found["JC-2021/x.csv"]["region"] == "jersey_city" and found["zips/in.zip"]["columns"] is None
    assert found["odd/o.csv"]["column_count"] == 2 and found["odd/blank.csv"]["schema_key"] is None

    scanned = files.inventory(spark, root, scan=True).collect()
    assert {r["relative_path"]: r for r in scanned} == found

    manifest = write_parts(spark, root, inventory, out, max_bytes=2_000).collect()
    trips = csv_parts.read_parts(spark, f"{out}/region=*/schema_key=dc497b4333c4/part=*", MODERN)
    assert trips.count() == 407 and trips.filter("_error is not null").count() == 0
    nyc = [m for m in manifest if m["region"] == "nyc" and m["schema_key"] == "dc497b4333c4"]
    assert {f for m in nyc for f in m["source_files"]} == {"2021 trips/big.csv"} | {
        f"2021 trips/s{n}.csv" for n in range(6)
    }
    big = [m for m in nyc if "2021 trips/big.csv" in m["source_files"]]
    assert len(big) > 1 and all(m["gzip_size_bytes"] < 4_000 for m in manifest)
    write_report(inventory, f"{tmp_path}/report")
    write_report(inventory.drop("columns"), f"{tmp_path}/json", as_json=True)
    assert spark.read.option("header", True).csv(f"{tmp_path}/report").count() == 11


def test_logs(spark, tmp_path):
    entries = [
        {"output_file": "a", "status": "FAILED", "attempt": 1, "ended_at_utc": "2024-01-01"},
        {"output_file": "a", "status": "SUCCESS", "attempt": 2, "ended_at_utc": "2024-01-02"},
        {"output_file": "b", "status": "FAILED", "attempt": 1, "ended_at_utc": "2024-01-01"},
    ]
    text = "\n".join(json.dumps(e) for e in entries) + "\n{broken\n\n"
    write(f"{tmp_path}/log.jsonl", text)
    latest = {r["output_file"]: r["status"] for r in files.read_load_log(spark, f"{tmp_path}/log.jsonl").collect()}
    assert latest == {"a": "SUCCESS", "b": "FAILED"}
    assert files.read_upload_log(spark, f"{tmp_path}/log.jsonl").count() == 2
    write(f"{tmp_path}/dl.jsonl", '{"file_name": "z", "download_status": "SUCCESS", "file_size_bytes": 5}\n')
    assert files.read_download_log(spark, f"{tmp_path}/dl.jsonl").first()["file_size_bytes"] == 5
    write(f"{tmp_path}/ex.jsonl", '{"nested_zip_path": "z", "extract_status": "SUCCESS", "csv_file_count": 3}\n')
    assert files.read_extract_log(spark, f"{tmp_path}/ex.jsonl").first()["csv_file_count"] == 3
    write(f"{tmp_path}/index.csv", "file_name,s3_key,file_format,file_size_bytes,last_modified,file_url\na.zip,a.zip,zip,12,2024-01-02T03:04:05.000Z,h\n")
    index = files.read_file_index(spark, f"{tmp_path}/index.csv").first()
    assert index["file_size_bytes"] == 12 and index["last_modified"].year == 2024


def test_stream_loads_each_part_once(spark, tmp_path):
    inbox, target, archive = f"{tmp_path}/in", f"{tmp_path}/trips", f"{tmp_path}/done"
    first = part(inbox, "nyc_dc497b4333c4_part0001.csv.gz", [modern(1), modern(2, start_lat="?")])

    def run(checkpoint):
        start_incremental_load(spark, inbox, MODERN, target, f"{tmp_path}/{checkpoint}", archive).awaitTermination()
        return spark.read.parquet(target).count()

    assert os.path.exists(first) and run("c1") == 1
    part(inbox, "nyc_dc497b4333c4_part0002.csv.gz", [modern(3), modern(4)])
    assert run("c1") == 3
    assert run("c2") == 3
    rows = spark.read.parquet(target).select("_source_file", "_source_row_number", "trip_duration").collect()
    rejected = spark.read.parquet(f"{target}_rejected").select("_source_row_number", "_error").collect()
    assert [tuple(r) for r in rejected] == [(2, "start_lat")]
    assert sorted(tuple(r) for r in rows) == [
        ("nyc_dc497b4333c4_part0001.csv.gz", 1, 600),
        ("nyc_dc497b4333c4_part0002.csv.gz", 1, 600),
        ("nyc_dc497b4333c4_part0002.csv.gz", 2, 600),
    ]


def test_parts_of_odd_names_keep_label_and_numbers(spark, tmp_path):
    """Names are made once a file: no row of the scan carries the address or goes through a pattern."""
    folder = f"{tmp_path}/a b+c%20/region=nyc/schema_key=dc497b4333c4/part=0001"
    part(folder, "x 1+%41.csv.gz", [modern(1), modern(2)])
    part(folder, "y.csv.gz", [modern(3)])
    rows = csv_parts.raw_parts(spark, f"{tmp_path}/a b+c%20/region=*/schema_key=*/part=*", MODERN)
    found = sorted((r["_source_file"], r["_source_row_number"]) for r in rows.collect())
    assert found == [
        ("nyc_dc497b4333c4_part0001-x%201+%2541.csv.gz", 1), ("nyc_dc497b4333c4_part0001-x%201+%2541.csv.gz", 2),
        ("nyc_dc497b4333c4_part0001-y.csv.gz", 1)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan[: plan.index("Join ")] and "file_path" not in plan


def test_parts_are_written_without_a_sort(spark, tmp_path):
    """Rows go to the files of a few folders as they come; addresses are not decoded row by row."""
    root, out = f"{tmp_path}/raw d+%41", f"{tmp_path}/parts"
    for folder in ("2021", "JC-2021", "2021 b%20+"):
        write(f"{root}/{folder}/x.csv", HEADER + "\n".join(modern(n) for n in range(20)) + "\n")
    inventory = stage(files.inventory(spark, root, tasks=2), "inventory-unsorted")
    plans = []
    real = parts._write_csv
    parts._write_csv = lambda rows, *rest: (plans.append(rows._jdf.queryExecution().optimizedPlan().toString()), real(rows, *rest))
    try:
        manifest = write_parts(spark, root, inventory, out).collect()
        assert plans and "url_decode" not in plans[0] and "UrlCodec" not in plans[0]
    finally:
        parts._write_csv = real
    read = csv_parts.read_parts(spark, f"{out}/region=*/schema_key=*/part=*", MODERN)
    assert read.count() == 60 and read.filter("_error is not null").count() == 0
    assert sorted(f for m in manifest for f in m["source_files"]) == ["2021 b%20+/x.csv", "2021/x.csv", "JC-2021/x.csv"]
    assert int(one_file_per_task(spark).conf.get("spark.sql.maxConcurrentOutputFileWriters")) > 0


def test_mean_record_counts_records_not_lines(spark):
    lines = spark.createDataFrame([("a,b",), ('"x ""y"" z',), ('w",1',), ('"c,d",2',)], "value string")
    assert lines.agg(parts.mean_record()).first()[0] == (4 + 11 + 5 + 8) / 3
    assert lines.limit(0).agg(parts.mean_record()).first()[0] is None


def test_parts_are_parsed_in_one_projection(spark, tmp_path):
    from pedalytics.schemas import RAW_HEADER

    lines = [",".join(RAW_HEADER[MODERN])]
    times = ["2024-01-01 10:00:00", "1/2/2024 3:04", "NULL", "null", '""', "", " ", "soon"]
    for n, t in enumerate(times):
        row = dict.fromkeys(RAW_HEADER[MODERN], "NULL") | {"ride_id": f"r{n}", "started_at": t, "start_lat": "null" if n % 2 else "40.5x"}
        lines.append(",".join(row[h] for h in RAW_HEADER[MODERN]))
    folder = tmp_path / "region=nyc" / "schema_key=dc497b4333c4" / "part=0001"
    folder.mkdir(parents=True)
    (folder / "p.csv").write_text("\n".join(lines) + "\n")
    rows = csv_parts.read_parts(spark, str(folder), MODERN)
    found = {r["ride_id"]: r for r in rows.collect()}
    assert [found[f"r{n}"]["started_at"] is None for n in range(8)] == [False, False] + 6 * [True]
    bad = [found[f"r{n}"]["_error"] for n in range(8)]
    assert bad == ["start_lat", None, "start_lat", None, "start_lat", None, "started_at,start_lat", "started_at"]
    assert {r["_source_file"] for r in found.values()} == {"nyc_dc497b4333c4_part0001-p.csv"}
    assert all(r["rideable_type"] is None and r["_source_row_number"] == int(k[1:]) + 1 for k, r in found.items())
    # No row's address is rewritten, and rows meet the label of their file as typed values.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "replace(input_file_name()" not in plan
    below = plan[plan.index("Join LeftOuter") :]
    assert "_unread" in below and "try_cast" in below.replace("TRY_CAST", "try_cast").replace("cast(", "try_cast(")


def shuffle_files(spark):
    """Sizes of the shuffle files on the executors' disks, by name."""
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    found = [blocks.apply(n) for n in range(blocks.size())]
    return {f.getName(): f.length() for f in found if f.getName().startswith("shuffle_")}


def test_parts_are_written_in_slices_that_leave_no_shuffle_files(spark, tmp_path, monkeypatch):
    root, out = f"{tmp_path}/raw", f"{tmp_path}/parts"
    for n in range(9):
        folder = "JC-2021" if n % 3 == 0 else "2021 trips"
        names = [hashlib.sha256(f"{n} {i}".encode()).hexdigest() for i in range(1_000)]
        write(f"{root}/{folder}/x {n}.csv", HEADER + "\n".join(modern(n, ride_id=x) for x in names) + "\n")
    inventory = stage(files.inventory(spark, root, tasks=2), "inventory-slices")
    plan = parts.plan_parts(inventory, 100_000)
    slices = [[tuple(r)[:3] for r in s] for s in parts.slices_of_parts(plan, 600_000)]
    assert len(slices) > 2 and sorted(f for s in slices for f in s) == sorted(tuple(r) for r in plan.select("relative_path", "region", "part").collect())
    homes = [{f[1:] for f in s} for s in slices]
    assert sum(map(len, homes)) == len(set.union(*homes))  # no part is in two slices
    monkeypatch.setattr(parts, "WRITE_BYTES", 600_000)
    before = shuffle_files(spark)
    manifest = write_parts(spark, root, inventory, out, max_bytes=100_000).collect()
    for _ in range(50):  # they are deleted in the background
        left = sum(size for name, size in shuffle_files(spark).items() if name not in before)
        if left < 300_000:
            break
        time.sleep(0.1)
    assert left < 300_000  # of 1.7 MB
    read = csv_parts.read_parts(spark, f"{out}/region=*/schema_key=*/part=*", MODERN)
    assert (read.count(), read.select("ride_id").distinct().count()) == (9_000, 9_000)
    assert {f for m in manifest for f in m["source_files"]} == {f"{'JC-2021' if n % 3 == 0 else '2021 trips'}/x {n}.csv" for n in range(9)}
    assert os.path.exists(f"{root}/JC-2021/x 0.csv")


def test_consumed_raw_files_go_with_their_parts(spark, tmp_path):
    root, out = f"{tmp_path}/raw d+%41", f"{tmp_path}/parts"
    for folder in ("2021 b%20+", "JC-2021"):
        write(f"{root}/{folder}/x.csv", HEADER + "\n".join(modern(n) for n in range(20)) + "\n")
    write(f"{root}/zips/in.zip", "zip")
    inventory = stage(files.inventory(spark, root, tasks=2), "inventory-consumed")
    write_parts(spark, root, inventory, out, region="nyc", consume=True)
    assert not os.path.exists(f"{root}/2021 b%20+/x.csv")
    assert os.path.exists(f"{root}/JC-2021/x.csv") and os.path.exists(f"{root}/zips/in.zip")
    assert csv_parts.read_parts(spark, f"{out}/region=*/schema_key=*/part=*", MODERN).count() == 20


@pytest.fixture(scope="module")
def few_rows(spark, tmp_path_factory):
    """Line items and events of two regions in the columns that the layouts are made of."""
    at = str(tmp_path_factory.mktemp("few-rows"))
    k = F.col("id")
    spark.range(300).select(
        k.alias("l_orderkey"), (k % 9).alias("l_partkey"), (k % 7).alias("l_suppkey"), (k % 7 + 1).cast("int").alias("l_linenumber"),
        (k * 1.5 + 100).alias("l_extendedprice"), F.lit("A").alias("l_returnflag"), F.lit("1996-02-03").cast("date").alias("l_shipdate"),
    ).write.parquet(f"{at}/lineitem.parquet")
    spark.range(90).select(
        k.alias("event_id"), F.lit("ride").alias("event_type"), F.lit("2014-02-03 04:05:06").cast("timestamp_ntz").alias("ts"),
        (k + 60.0).alias("value"), (k % 5).alias("user_id"),
    ).write.parquet(f"{at}/events.parquet")
    return at


def test_round_trips_leave_no_raw_files(spark, few_rows):
    before = set(glob.glob(f"{scratch_dir(spark)}/raw-files-*"))
    out, manifest = round_trips._write_grouped(spark, few_rows)
    assert set(glob.glob(f"{scratch_dir(spark)}/raw-files-*")) <= before
    assert manifest.count() == 4 and all(m["source_files"] for m in manifest.collect())
    rows = [csv_parts.read_parts(spark, f"{out}/region=*/schema_key={k}/part=*", x).count() for k, x in (("e24ee8457e0e", LEGACY_V1), ("dc497b4333c4", MODERN))]
    assert rows == [300, 90]
