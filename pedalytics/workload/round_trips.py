"""Queries that go through files: the driver's tables written as raw CSV, then taken in again."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalytics.config import JERSEY_CITY, LAYOUTS, LEGACY_V1, MODERN, NYC, REGIONS, TABLE_OF_LAYOUT, Region
from pedalytics.functions import time
from pedalytics.operators.unify import to_unified, union_layouts
from pedalytics.plans import audit, ingest, rides
from pedalytics.plans.warehouse import Warehouse
from pedalytics.schemas import LAYOUT_SCHEMA, LEGACY_V2, MANIFEST_FILE, RAW_HEADER
from pedalytics.session import delete, release, scratch_dir, stage
from pedalytics.sinks import tables
from pedalytics.sinks.parts import CSV_OUT, write_manifest, write_parts, write_report
from pedalytics.sources import csv_parts, files
from pedalytics.sources import driver_tables as source
from pedalytics.streaming.incremental import start_incremental_load

_BEGAN = {MODERN: "started_at", LEGACY_V1: "starttime", LEGACY_V2: "start_time"}


def _folder(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _raw(staged: DataFrame, layout: str) -> DataFrame:
    """Staged rows as text under the raw header of their layout."""
    names = LAYOUT_SCHEMA[layout].fieldNames()
    return staged.select(
        *[F.col(n).cast("string").alias(h) for n, h in zip(names, RAW_HEADER[layout], strict=True)]
    )


def _slash(ts: Column) -> Column:
    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    day = F.concat_ws("/", F.month(ts), F.dayofmonth(ts), F.year(ts))
    return F.concat(day, F.lit(" "), F.hour(ts), F.lit(":"), two(F.minute(ts)), F.lit(":"), two(F.second(ts)))


def write_legacy_parts(spark: SparkSession, sf_dir: str) -> str:
    """Orders as gzip CSV of the second legacy layout, with slash dates, null tokens, quotes, whole
    numbers spelled with decimals and unreadable bike ids here and there."""
    bike, began = F.col("bike_id"), F.col("start_time")
    name = F.col("start_station_name")
    rows = source.legacy_v2_staging(spark, sf_dir).withColumns(
        {
            "bike_id": F.when(bike % 50 == 0, "abc").otherwise(bike.cast("string")),
            "start_time": F.when(bike % 4 == 1, _slash(began)).otherwise(began.cast("string")),
            "start_station_name": F.when(bike % 70 == 3, "NULL")
            .when(bike % 70 == 4, "null")
            .when(bike % 70 == 5, F.lit('5 Av, "North"\nside'))
            .otherwise(name),
            "birth_year": F.when(bike % 6 == 2, F.concat("birth_year", F.lit(".0"))).otherwise(
                F.col("birth_year").cast("string")
            ),
        }
    )
    folder = _folder(spark, "legacy-parts")
    _raw(rows, LEGACY_V2).write.options(compression="gzip", **CSV_OUT).csv(folder)
    return folder


def write_raw_files(spark: SparkSession, sf_dir: str) -> str:
    """Line items and events as plain CSV files of two layouts in folders of two regions."""
    root = _folder(spark, "raw-files")
    for layout, staged, key in (
        (LEGACY_V1, source.legacy_v1_staging(spark, sf_dir), F.col("bikeid")),
        (MODERN, source.modern_staging(spark, sf_dir), F.col("ride_id").cast("long")),
    ):
        for folder, mine in ((f"{layout}-trips", key % 3 != 0), (f"JC-{layout}-trips", key % 3 == 0)):
            _raw(staged.filter(mine), layout).write.options(**CSV_OUT).csv(f"{root}/{folder}/2014")
    return root


def _write_grouped(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The raw files as parts, and their manifest; the raw files, several times as large, go once their parts are written."""
    root, out = write_raw_files(spark, sf_dir), _folder(spark, "parts")
    inventory = stage(files.inventory(spark, root, tasks=8), "inventory")
    manifest = stage(write_parts(spark, root, inventory, out, consume=True), "manifest")
    delete(spark, root)
    release(inventory)
    return out, manifest


def regroup_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, manifest = _write_grouped(spark, sf_dir)
    label = F.col("_source_file")
    counts = None
    for layout, key, seconds in (
        (LEGACY_V1, "e24ee8457e0e", F.col("tripduration")),
        (MODERN, "dc497b4333c4", F.lit(None).cast("long")),
    ):
        rows = csv_parts.read_parts(spark, f"{out}/region=*/schema_key={key}/part=*", layout)
        per_file = rows.groupBy(label).agg(
            F.count_if(F.col("_error").isNull()).alias("good_rows"),
            F.count_if(F.col("_error").isNotNull()).alias("bad_rows"),
            F.sum(seconds).alias("seconds"),
        )
        per_region = per_file.groupBy(
            F.regexp_extract(label, r"^(.+)_[0-9a-f]{12}_part", 1).alias("region"),
            F.regexp_extract(label, r"_([0-9a-f]{12})_part", 1).alias("schema_key"),
        ).agg(*[F.sum(c).alias(c) for c in ("good_rows", "bad_rows", "seconds")])
        counts = per_region if counts is None else counts.unionByName(per_region)
    lineage = manifest.groupBy("region", "schema_key").agg(
        F.count_if(F.coalesce(F.size("source_files"), F.lit(0)) == 0).alias("parts_without_source"),
        F.count_if(F.col("gzip_size_bytes") <= 0).alias("empty_parts"),
    )
    return counts.join(lineage, ["region", "schema_key"])


def ingest_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register, ingest and unify; then all of it again, which adds nothing."""
    out, manifest = _write_grouped(spark, sf_dir)
    warehouse = Warehouse(spark, _folder(spark, "warehouse"))
    again = []
    for _ in range(2):
        registered = warehouse.register_parts(manifest)
        ingested = warehouse.ingest(out)
        loaded = [warehouse.load_trips(region) for region in REGIONS.values()]
        again = [registered.rows, ingested.total, sum(w.rows for w in loaded)]
    check = warehouse.row_count_check().select("sf_schema", "sf_table", "log_rows_loaded", "discrepancy")
    trips = None
    for region in REGIONS.values():
        counted = warehouse.trips(region).agg(F.count(F.lit(1)).alias("unified")).select(
            F.lit(region.staging_schema).alias("sf_schema"), "unified"
        )
        trips = counted if trips is None else trips.unionByName(counted)
    return check.join(trips, "sf_schema").withColumn("added_again", F.lit(sum(again)))


def _missing_part(spark: SparkSession) -> DataFrame:
    """A manifest entry whose part is not in the inbox."""
    name = "region=nyc/schema_key=dc497b4333c4/part=9999/lost.csv.gz"
    entry = (name, "nyc", "nyc", "dc497b4333c4", 100, ["lost.csv"], "2024-01-01 00:00:00")
    return spark.createDataFrame([entry], MANIFEST_FILE)


def ingest_after_a_crash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that dies between writing a part and logging it, then a whole one, then a repeat.

    The dead run's rows stay in the staging folder and are never seen; a part that is not there fails
    in both later runs and blames no other.
    """
    out, manifest = _write_grouped(spark, sf_dir)
    house = Warehouse(spark, _folder(spark, "warehouse"))
    house.register_parts(manifest.unionByName(_missing_part(spark)))
    queue = audit.work_queue(house.manifest(), house.log())
    first = queue.filter("sf_table = 'TRIPS_MODERN' AND region = 'nyc' AND output_file NOT LIKE '%lost%'")
    first = first.orderBy("output_file").limit(1).collect()
    table = house.path("STAGING_NYC", "TRIPS_MODERN")
    ingest.load_layout(spark, first, out, table, MODERN, 1)
    unseen_rows = house.staging(NYC, MODERN).count()
    runs = [house.ingest(out), house.ingest(out)]
    loaded = [house.load_trips(r).rows for _ in range(2) for r in REGIONS.values()]
    left = len(ingest.uncommitted(spark, table, house.log()))
    dropped = house.drop_uncommitted(NYC, MODERN)
    check = house.row_count_check().select("sf_schema", "sf_table", "log_rows_loaded", "actual_row_count", "discrepancy")
    figures = {
        "rows_before_commit": unseen_rows, "failed_first": runs[0].failed, "tried_again": runs[1].total,
        "failed_again": runs[1].failed, "left_behind": left, "dropped": dropped, "added_again": sum(loaded[len(REGIONS):]),
    }
    trips = spark.createDataFrame(
        [(r.staging_schema, house.trips(r).count()) for r in REGIONS.values()], "sf_schema string, unified long")
    return check.join(trips, "sf_schema").select("*", *[F.lit(v).cast("long").alias(k) for k, v in figures.items()])


def ingest_by_force(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts loaded, then loaded again by force: only rows of the last load are there, and none is new."""
    out, manifest = _write_grouped(spark, sf_dir)
    house = Warehouse(spark, _folder(spark, "warehouse"))
    house.register_parts(manifest)
    house.ingest(out)
    for region in REGIONS.values():
        house.load_trips(region)
    again = house.ingest(out, force=True)
    added = sum(house.load_trips(r).rows for r in REGIONS.values())
    attempts = house.log().groupBy("sf_schema", "sf_table").agg(F.max("attempt").cast("long").alias("attempts"))
    counted = {(r.staging_schema, TABLE_OF_LAYOUT[x]): house.staging(r, x) for r in REGIONS.values() for x in (LEGACY_V2, MODERN)}
    return audit.actual_counts(counted).join(attempts, ["sf_schema", "sf_table"]).select(
        "*", F.lit(again.failed).cast("long").alias("failed"), F.lit(again.skipped).cast("long").alias("skipped"),
        F.lit(added).cast("long").alias("added"))


def archive_after_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts are moved out of the inbox once they are loaded, and read back from where they went."""
    out, manifest = _write_grouped(spark, sf_dir)
    archive = _folder(spark, "archive")
    house = Warehouse(spark, _folder(spark, "warehouse"))
    house.register_parts(manifest.unionByName(_missing_part(spark)))
    house.ingest(out, "nyc")
    moved = [house.archive_loaded(out, archive), house.archive_loaded(out, archive)]
    kept = files.list_files(spark, archive, "*.csv.gz").count()
    house.ingest(out)
    house.archive_loaded(out, archive)
    counts = None
    for layout, key in ((LEGACY_V1, "e24ee8457e0e"), (MODERN, "dc497b4333c4")):
        rows = csv_parts.read_parts(spark, f"{archive}/region=*/schema_key={key}/part=*", layout)
        per_file = rows.groupBy("_source_file").agg(F.count(F.lit(1)).alias("n"))
        mine = per_file.groupBy(F.regexp_extract("_source_file", r"^(.+)_[0-9a-f]{12}_part", 1).alias("region")).agg(
            F.sum("n").alias("archived_rows")).withColumn("schema_key", F.lit(key))
        counts = mine if counts is None else counts.unionByName(mine)
    left = files.list_files(spark, out, "*.csv.gz").count()
    return counts.select(
        "*", F.lit(moved[0] == kept).alias("all_moved"), F.lit(moved[1]).cast("long").alias("moved_again"),
        F.lit(left).cast("long").alias("left_in_inbox"))


def stream_with_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with unreadable rows through the stream: run, run again, and run with a fresh checkpoint."""
    inbox, target = write_legacy_parts(spark, sf_dir), _folder(spark, "stream-trips")
    first, second = _folder(spark, "checkpoint"), _folder(spark, "checkpoint")
    for checkpoint in (first, first, second):
        start_incremental_load(spark, inbox, LEGACY_V2, target, checkpoint).awaitTermination()
    trips = spark.read.parquet(target).agg(F.count(F.lit(1)).alias("trips"), F.sum("bikeid").alias("bikes"))
    rejected = spark.read.parquet(f"{target}_rejected").agg(
        F.count(F.lit(1)).alias("rejected"), F.count_distinct("_error").alias("kinds_of_error"))
    log = spark.read.parquet(f"{target}_log").groupBy("_stream").agg(
        F.sum("rows_loaded").alias("loaded"), F.sum("errors_seen").alias("errors"),
        (F.count(F.lit(1)) - F.count_distinct("_source_file")).alias("twice"))
    log = log.agg(
        F.count(F.lit(1)).alias("streams"), F.min("loaded").alias("logged_least"), F.max("loaded").alias("logged_most"),
        F.max("errors").alias("logged_errors"), F.sum("twice").alias("logged_twice"))
    one = F.lit(1).alias("one")
    return trips.select("*", one).join(rejected.select("*", one), "one").join(log.select("*", one), "one").drop("one")


def manifest_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The part manifest written as JSON lines and read back for one region."""
    path = _folder(spark, "manifest-file")
    manifest = source.part_manifest(spark, sf_dir)
    write_manifest(manifest.withColumn("snowflake_schema_folder", F.col("region")), path)
    entries = files.read_manifest(spark, path, "jersey_city")
    return entries.select(
        "output_file", "region", "schema_key", "gzip_size_bytes", F.size("source_files").cast("long").alias("source_file_count"),
        F.col("created_at_utc").isNull().alias("undated"))


def load_log_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load log as JSON lines with broken lines between, read back: the last entry of each part."""
    path = _folder(spark, "load-log-file")
    log = source.ingest_log(spark, sf_dir).withColumnsRenamed({"rows_loaded": "copy_rows_loaded"})
    ended = F.date_format("ended_at_utc", "yyyy-MM-dd HH:mm:ss")
    entry = F.to_json(F.struct("output_file", "region", "attempt", "status", "copy_rows_loaded", "error_message", ended.alias("ended_at_utc")))
    broken = F.when(F.col("log_id") % 10 == 0, F.lit('{"output_file": "half'))
    log.select(F.explode(F.array_compact(F.array(entry, broken))).alias("value")).write.text(path)
    latest = files.read_load_log(spark, path)
    return latest.select("output_file", "region", F.col("attempt").cast("long").alias("attempt"), "status", "ended_at_utc")


def index_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive index written as a CSV report and read back: archives and bytes by format and month."""
    path = _folder(spark, "index-file")
    orders = source.read(spark, sf_dir, "orders")
    key = F.concat(F.lit("trips, "), F.col("o_orderstatus"), F.lit("/"), F.col("o_orderkey").cast("string"),
                   F.when(F.col("o_orderkey") % 3 == 0, ".CSV").otherwise(".zip"))
    size = F.round(F.col("o_totalprice") * 100).cast("long")
    entries = orders.select(*files.index_entry(key, size, F.col("o_orderdate").cast("timestamp"), "https://host/"))
    write_report(entries, path)
    index = files.read_file_index(spark, path)
    return index.groupBy("file_format", F.date_format("last_modified", "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("archives"), F.sum("file_size_bytes").alias("bytes"),
        F.count_if(F.col("file_url") == F.concat(F.lit("https://host/"), F.col("s3_key"))).alias("addressed"),
        F.count_if(F.col("s3_key").endswith(F.col("file_name"))).alias("named"))


def loads_by_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three layouts loaded one by one, a repeat of each, and the fact built, extended and reloaded."""
    house = Warehouse(spark, _folder(spark, "warehouse"))
    staged = {x: stage(df, f"staged-{x}") for x, df in source.staging(spark, sf_dir).items()}
    early = {x: df.filter(F.year(_BEGAN[x]) < 2014) for x, df in staged.items()}
    rows = []
    house.build_dates()
    for layout in LAYOUTS:
        done = [house.load_trips_from({layout: df[layout]}, NYC).rows for df in (early, staged, staged)]
        rows.append((layout, *done))
    house.build_stations(NYC)
    built = [house.build_fact(NYC).rows, house.build_fact(NYC).rows, house.build_fact(NYC, full_reload=True).rows]
    rows.append(("FACT", *built))
    calendars = {house.dates(r).count() for r in REGIONS.values()}
    return spark.createDataFrame(
        [(*r, calendars == {6574}) for r in rows], "loaded string, first long, second long, third long, same_calendar boolean")


def capped_parts(spark: SparkSession, sf_dir: str, max_bytes: int) -> DataFrame:
    """Orders as plain CSV with quotes and line breaks, written as parts of at most ``max_bytes``, and read back."""
    root, out = _folder(spark, "raw-files"), _folder(spark, "capped-parts")
    bike, name = F.col("bike_id"), F.col("start_station_name")
    odd = F.when(bike % 7 == 5, F.lit('5 Av, "North"\nside')).otherwise(name)
    rows = source.legacy_v2_staging(spark, sf_dir).withColumn("start_station_name", odd)
    for folder, mine in (("trips", bike % 3 != 0), ("JC-trips", bike % 3 == 0)):
        _raw(rows.filter(mine), LEGACY_V2).write.options(**CSV_OUT).csv(f"{root}/{folder}/2014")
    manifest = stage(write_parts(spark, root, stage(files.inventory(spark, root, tasks=8), "inventory"), out, max_bytes=max_bytes), "manifest")
    read = csv_parts.read_parts(spark, f"{out}/region=*/schema_key=473144999085/part=*", LEGACY_V2)
    values = read.groupBy(F.regexp_extract("_source_file", r"^(.+)_[0-9a-f]{12}_part", 1).alias("region")).agg(
        F.count_if(F.col("_error").isNull()).alias("good_rows"), F.count_if(F.col("_error").isNotNull()).alias("bad_rows"),
        F.sum("bike_id").alias("bikes"), F.sum("trip_duration").alias("seconds"),
        F.count_if(F.col("start_station_name") == '5 Av, "North"\nside').alias("broken_names"),
        F.count_distinct("start_time", "bike_id").alias("different"))
    sizes = manifest.groupBy("region").agg(
        F.count_if(F.col("gzip_size_bytes") > max_bytes).alias("oversized"), (F.count(F.lit(1)) > 1).alias("several_parts"))
    return values.join(sizes, "region")


def fact_in_two_steps(spark: SparkSession, sf_dir: str, region: Region) -> None:
    """Views over a fact of early rides; later rides are then added by another warehouse object, which knows of no view."""
    root = _folder(spark, "warehouse")
    first, second = Warehouse(spark, root), Warehouse(spark, root)
    first.build_dates()
    first.load_trips_from(source.staging(spark, sf_dir, region), region)
    first.build_stations(region)
    early = rides.fact_ride(first.trips(region).filter(F.year("started_at") < 2014), first.stations(region))
    tables.write_fact(early, first.path(region.staging_schema.replace("STAGING_", "INT_UDM_"), "FACT_RIDE"), "FACT_RIDE")
    first.publish_views()
    second.build_fact(region)


def fact_in_many_appends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rides appended in five loads by hour, then compacted: rides, first and last day of each month, and files left."""
    path = _folder(spark, "fact")
    trips = rides.qualifying(union_layouts(source.staging(spark, sf_dir)))
    fact = stage(trips.select(
        time.date_key(F.col("started_at")).alias("start_date_sk"), F.hour("started_at").alias("start_hour"), "trip_duration"), "rides")
    for n in range(5):
        tables.write_fact(fact.filter(F.col("start_hour") % 5 == n), path, "FACT_RIDE")
    crowded = tables.crowded_months(spark, path, 3).count()
    done = tables.compact_fact(spark, path, 3)
    left = tables.crowded_months(spark, path, 3).count()
    months = spark.read.parquet(path).groupBy("start_year", "start_month").agg(
        F.count(F.lit(1)).alias("rides"), F.sum("trip_duration").alias("seconds"),
        F.min("start_date_sk").alias("first_day"), F.max("start_date_sk").alias("last_day"))
    return months.select(
        "*", F.lit(crowded > 0).alias("was_crowded"), F.lit(done == crowded).alias("all_compacted"), F.lit(left).cast("long").alias("crowded_left"))


def stream_parts_twice(spark: SparkSession, sf_dir: str, layout: str) -> DataFrame:
    """The stream run to the end with one checkpoint, with it again, and with a new one."""
    inbox, target = _folder(spark, "inbox"), _folder(spark, "stream-trips")
    staged = source.modern_staging(spark, sf_dir, JERSEY_CITY)
    _raw(staged, layout).write.options(compression="gzip", **CSV_OUT).csv(inbox)
    first, second = _folder(spark, "checkpoint"), _folder(spark, "checkpoint")
    for checkpoint in (first, first, second):
        start_incremental_load(spark, inbox, layout, target, checkpoint).awaitTermination()
    loaded = spark.read.parquet(target).groupBy("member_casual").agg(
        F.count(F.lit(1)).alias("trips"), F.sum("trip_duration").alias("seconds")
    )
    direct = (
        to_unified(staged, layout)
        .groupBy("member_casual")
        .agg(F.count(F.lit(1)).alias("expected_trips"))
    )
    return loaded.join(
        direct, loaded["member_casual"].eqNullSafe(direct["member_casual"]), "left"
    ).select(loaded["member_casual"], "trips", "expected_trips", "seconds")
