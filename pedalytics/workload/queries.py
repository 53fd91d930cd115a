"""Named queries on the driver's tables, one per operator or report."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics.config import (
    JERSEY_CITY,
    LAYOUT_OF_KEY_BY_HEADER,
    LEGACY_V2,
    MODERN,
    NYC,
    Compat,
    Region,
)
from pedalytics.functions import ride, text, time
from pedalytics.operators import quantile, ranking
from pedalytics.operators.joins import attach_key, unseen
from pedalytics.operators.unify import repeated_trips, union_layouts
from pedalytics.plans import audit, calendar, reports, rides, stations
from pedalytics.session import stage
from pedalytics.sinks.parts import plan_parts
from pedalytics.sources import csv_parts
from pedalytics.sources import driver_tables as source
from pedalytics.sources.files import describe_files
from pedalytics.workload import round_trips

Query = Callable[[SparkSession, str], DataFrame]


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every engine shares: long, double, text dates."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def _trips(spark: SparkSession, sf_dir: str, region: Region = NYC) -> DataFrame:
    return union_layouts(source.staging(spark, sf_dir, region))


def _stations(spark: SparkSession, sf_dir: str, region: Region = NYC, **options) -> DataFrame:
    """The station dimension, stored before it is joined so that its true size is known."""
    return stage(stations.dim_station(_trips(spark, sf_dir, region), region, **options), "dim_station")


def _fact(spark: SparkSession, sf_dir: str, dim: DataFrame, region: Region = NYC) -> DataFrame:
    return rides.fact_ride(_trips(spark, sf_dir, region), dim)


def _fact_without_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of the fact, for reports that use no station key."""
    trips = rides.qualifying(_trips(spark, sf_dir))
    return trips.select(
        time.date_key(F.col("started_at")).alias("start_date_sk"),
        ride.minutes(F.col("trip_duration")).alias("trip_duration_min"),
        text.rider_type(F.col("member_casual")).alias("member_casual"),
    )


_UNIFIED = [
    "ride_id", "rideable_type", "bikeid", "started_at", "ended_at", "trip_duration",
    "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    "start_lat", "start_lng", "end_lat", "end_lng", "member_casual", "birth_year", "gender",
    "_source_file",
]
_DIM = [
    "station_name", "legacy_station_id", "modern_station_id",
    "round(station_lat, 8) AS station_lat", "round(station_lng, 8) AS station_lng",
    "in_legacy", "in_modern", "availability", "trip_observations", "lat_variance", "lng_variance",
]


# ---- layouts and loads --------------------------------------------------------------------------


def union_of_layouts(spark, sf_dir):
    return _trips(spark, sf_dir).select(*_UNIFIED)


def modern_duration(spark, sf_dir):
    staged = source.modern_staging(spark, sf_dir)
    seconds = time.seconds_between(F.col("started_at"), F.col("ended_at"))
    return staged.select("ride_id", "started_at", "ended_at", seconds.alias("trip_duration"))


def anti_join_incremental(spark, sf_dir):
    """Everything loaded but the trips of 2014 and later; the load adds just those."""
    trips = _trips(spark, sf_dir)
    loaded = trips.filter(F.year("started_at") < 2014)
    return unseen(trips, loaded).select(*_UNIFIED)


def trips_by_natural_key(spark, sf_dir):
    return repeated_trips(_trips(spark, sf_dir))


def rider_types(spark, sf_dir):
    trips = _trips(spark, sf_dir).select("member_casual", "rideable_type")
    return trips.groupBy(
        text.rider_type(F.col("member_casual")).alias("member_casual"),
        text.clean_code(F.col("rideable_type")).alias("rideable_type"),
    ).agg(F.count(F.lit(1)).alias("trips"))


# ---- calendar -----------------------------------------------------------------------------------


def _rides_per_day(spark, sf_dir, dates):
    """Calendar days with the trips that start on them (none on most)."""
    per_day = (
        _trips(spark, sf_dir)
        .groupBy(F.to_date("started_at").alias("full_date"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return dates.join(per_day, "full_date", "left").withColumn("trips", F.coalesce("n", F.lit(0)))


def dim_dates(spark, sf_dir):
    dates = calendar.dim_dates(spark)
    return _rides_per_day(spark, sf_dir, dates).select(*dates.columns, "trips")


def dim_dates_holiday_fanout(spark, sf_dir):
    dates = calendar.dim_dates(spark, compat=Compat(holiday_fanout=True, short_names=True))
    names = ["date_sk", "full_date", "day_of_week_name", "month_name", "holiday_name", "trips"]
    return _rides_per_day(spark, sf_dir, dates).filter("is_holiday").select(*names)


def rides_by_season(spark, sf_dir):
    fact, dates = _fact_without_stations(spark, sf_dir), calendar.dim_dates(spark)
    per_day = fact.groupBy("start_date_sk").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_day.join(dates, F.col("start_date_sk") == F.col("date_sk"))
        .groupBy("season", "is_weekend", "is_holiday")
        .agg(F.sum("n").alias("rides"))
    )


# ---- stations -----------------------------------------------------------------------------------


def dim_station(spark, sf_dir):
    return stations.dim_station(_trips(spark, sf_dir), NYC).selectExpr(*_DIM)


def dim_station_jc_box(spark, sf_dir):
    return stations.dim_station(_trips(spark, sf_dir, JERSEY_CITY), JERSEY_CITY).selectExpr(*_DIM)


def dim_station_by_split_key(spark, sf_dir):
    """Keys cut by '_' fail for a region name that holds one: all stations come out as legacy."""
    trips = _trips(spark, sf_dir, JERSEY_CITY)
    return stations.dim_station(trips, JERSEY_CITY, compat=Compat(key_by_split=True)).selectExpr(*_DIM)


def dim_station_header_keys(spark, sf_dir):
    """The other legacy labelling must give the same stations."""
    trips = _trips(spark, sf_dir)
    return stations.dim_station(trips, NYC, layout_of_key=LAYOUT_OF_KEY_BY_HEADER).selectExpr(*_DIM)


def station_observations(spark, sf_dir):
    return stations.observations(_trips(spark, sf_dir), NYC)


def availability_counts(spark, sf_dir):
    return rides.stations_by_availability(stations.dim_station(_trips(spark, sf_dir), NYC))


# ---- fact ---------------------------------------------------------------------------------------

_FACT = [
    "ride_id",
    "start_station_sk IS NOT NULL AS has_start_station",
    "end_station_sk IS NOT NULL AS has_end_station",
    "start_date_sk", "end_date_sk", "started_at", "ended_at", "trip_duration_sec",
    "trip_duration_min", "start_hour", "rideable_type", "bikeid", "member_casual", "birth_year",
    "gender", "age_at_ride", "age_bucket", "source_schema", "_source_file",
]


def fact_ride(spark, sf_dir):
    return _fact(spark, sf_dir, _stations(spark, sf_dir)).selectExpr(*_FACT)


def fact_incremental(spark, sf_dir):
    """Rides before 2015 are in the fact; the next build adds the others."""
    trips, dim = _trips(spark, sf_dir), _stations(spark, sf_dir)
    loaded = rides.qualifying(trips).filter(F.year("started_at") < 2015)
    return rides.fact_ride(trips, dim, existing=loaded).selectExpr(*_FACT)


def fact_ride_jc(spark, sf_dir):
    dim = _stations(spark, sf_dir, JERSEY_CITY)
    return _fact(spark, sf_dir, dim, JERSEY_CITY).selectExpr(*_FACT)


def age_bucket(spark, sf_dir):
    began, born = F.col("started_at"), F.col("birth_year")
    return (
        _trips(spark, sf_dir)
        .groupBy(
            ride.age_at(began, born).alias("age_at_ride"),
            ride.age_band(began, born).alias("age_bucket"),
        )
        .agg(F.count(F.lit(1)).alias("trips"))
    )


def source_schema_label(spark, sf_dir):
    """Labels by key pattern and by split, for both regions."""
    name = F.col("_source_file")
    both = _trips(spark, sf_dir, NYC).unionByName(_trips(spark, sf_dir, JERSEY_CITY))
    return both.groupBy(
        name,
        text.layout_label(name).alias("by_pattern"),
        text.layout_label(name, by_split=True).alias("by_split"),
    ).agg(F.count(F.lit(1)).alias("trips"))


def role_playing_join(spark, sf_dir):
    """One station dimension joined in two roles; unmatched names stay null."""
    dim = _stations(spark, sf_dir)
    rows = _trips(spark, sf_dir)
    for side in ("start", "end"):
        name = text.canonical_name(F.col(f"{side}_station_name"))
        rows = attach_key(rows, dim, name, "station_name", "availability", f"{side}_known")
    return rows.groupBy("start_known", "end_known").agg(F.count(F.lit(1)).alias("trips"))


# ---- reports ------------------------------------------------------------------------------------

_STATIONS = [
    "station_name", "round(station_lat, 8) AS station_lat",
    "round(station_lng, 8) AS station_lng", "availability", "total_departures",
    "total_arrivals", "total_activity", "net_flow", "flow_type", "avg_departure_duration_min",
    "departure_rank", "arrival_rank", "activity_rank",
]


def _routes(spark, sf_dir, region: Region = NYC):
    dim = _stations(spark, sf_dir, region)
    routes = reports.top_routes(_fact(spark, sf_dir, dim, region), dim, region)
    coords = [c for c in routes.columns if c.endswith(("_lat", "_lng"))]
    return routes.withColumns({c: F.round(c, 8) for c in coords})


def _top_stations(spark, sf_dir, region: Region = NYC):
    dim = _stations(spark, sf_dir, region)
    return reports.top_stations(_fact(spark, sf_dir, dim, region), dim)


def ridership_over_time(spark, sf_dir):
    return reports.ridership_over_time(
        _fact_without_stations(spark, sf_dir), calendar.dim_dates(spark)
    )


def ridership_holiday_fanout(spark, sf_dir):
    """With the doubled holiday kept, rides of that day count twice."""
    dates = calendar.dim_dates(spark, compat=Compat(holiday_fanout=True))
    return reports.ridership_over_time(_fact_without_stations(spark, sf_dir), dates)


def top_stations(spark, sf_dir):
    return _top_stations(spark, sf_dir).selectExpr(*_STATIONS)


def top_stations_jc(spark, sf_dir):
    return _top_stations(spark, sf_dir, JERSEY_CITY).selectExpr(*_STATIONS)


def top_stations_limit20(spark, sf_dir):
    leaders = reports.top_stations_by_activity(_top_stations(spark, sf_dir), 20)
    return leaders.select(
        "station_name", "total_departures", "total_arrivals", "net_flow", "flow_type"
    )


def top_routes(spark, sf_dir):
    return _routes(spark, sf_dir)


def top_routes_jc(spark, sf_dir):
    return _routes(spark, sf_dir, JERSEY_CITY)


def top_routes_rank10(spark, sf_dir):
    return reports.top_routes_by_rank(_routes(spark, sf_dir), 10).select(
        "start_station", "end_station", "total_trips", "is_round_trip", "route_rank"
    )


def station_activity(spark, sf_dir):
    """Departures and arrivals by station in one scan, before names are attached."""
    dim = _stations(spark, sf_dir)
    activity = reports.station_activity(_fact(spark, sf_dir, dim))
    return activity.join(dim.select("station_sk", "station_name"), "station_sk").select(
        "station_name", "departures", "arrivals", "departure_minutes"
    )


def monthly_median(spark, sf_dir):
    monthly = reports.monthly_ridership(
        _fact_without_stations(spark, sf_dir), calendar.dim_dates(spark)
    )
    return monthly.select("year_month", "member_casual", "median_duration_min", "avg_duration_min")


def lag_growth(spark, sf_dir):
    """Growth columns on monthly counts of orders by priority."""
    monthly = (
        source.read(spark, sf_dir, "orders")
        .groupBy(
            F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
            F.col("o_orderpriority").alias("member_casual"),
        )
        .agg(F.count(F.lit(1)).alias("total_rides"))
    )
    return reports.with_growth(monthly)


def dense_rank_counts(spark, sf_dir):
    """Dense rank of (part, supplier) pairs by their number of line items."""
    pairs = (
        source.read(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return ranking.with_dense_ranks(stage(pairs, "pairs"), pair_rank="n").select(
        "l_partkey", "l_suppkey", "n", "pair_rank"
    )


def exact_median_of_doubles(spark, sf_dir):
    """The skew-proof median of price per return flag."""
    prices = source.read(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    medians = quantile.median_of_doubles(
        prices, ["l_returnflag"], "l_extendedprice", F.lit(0.0), F.lit(1_000_000.0), "median_price"
    )
    return medians.withColumn("median_price", F.round("median_price", 6))


# ---- checks -------------------------------------------------------------------------------------


def rides_by_year(spark, sf_dir):
    return rides.rides_by_year(_fact_without_stations(spark, sf_dir), calendar.dim_dates(spark))


def missing_station(spark, sf_dir):
    return rides.rides_without_station(_fact(spark, sf_dir, _stations(spark, sf_dir)))


def end_date_check(spark, sf_dir):
    trips = rides.qualifying(_trips(spark, sf_dir))
    keyed = trips.select(time.date_key(F.col("ended_at")).alias("end_date_sk"))
    return rides.rides_ending_off_calendar(keyed, end=calendar.dt.date(2017, 12, 31))


# ---- load audit ---------------------------------------------------------------------------------


def _manifest(spark, sf_dir):
    return audit.manifest_rows(audit.routed(source.part_manifest(spark, sf_dir)))


def latest_status(spark, sf_dir):
    return audit.latest_status(source.ingest_log(spark, sf_dir))


def pending_files(spark, sf_dir):
    return audit.pending_files(_manifest(spark, sf_dir), source.ingest_log(spark, sf_dir))


def pending_files_jc(spark, sf_dir):
    manifest, log = _manifest(spark, sf_dir), source.ingest_log(spark, sf_dir)
    return audit.pending_files(manifest, log, "jersey_city").select("output_file", "last_status")


def work_queue(spark, sf_dir):
    return audit.work_queue(_manifest(spark, sf_dir), source.ingest_log(spark, sf_dir))


def row_count_check(spark, sf_dir):
    tables = {}
    for region in (NYC, JERSEY_CITY):
        for layout, df in source.staging(spark, sf_dir, region).items():
            tables[(region.staging_schema, f"TRIPS_{layout}")] = df
    return audit.row_count_check(source.ingest_log(spark, sf_dir), audit.actual_counts(tables))


def failed_files(spark, sf_dir):
    return audit.failed_files(source.ingest_log(spark, sf_dir))


def partial_loads(spark, sf_dir):
    return audit.partial_loads(source.ingest_log(spark, sf_dir))


def run_overview(spark, sf_dir):
    return audit.run_overview(source.ingest_log(spark, sf_dir))


def run_summary(spark, sf_dir):
    log = source.ingest_log(spark, sf_dir)
    return audit.run_summary(log).select("status", "files", "rows_loaded")


def copy_statuses(spark, sf_dir):
    return audit.statuses_by_file(source.ingest_log(spark, sf_dir))


def _retries(spark, sf_dir, **options):
    log = source.ingest_log(spark, sf_dir)
    queue = audit.retry_queue(
        source.part_manifest(spark, sf_dir), audit.latest_status(log), **options
    )
    return queue.select("output_file", "last_status", "last_attempt", "decision", "attempt")


def retry_queue(spark, sf_dir):
    return _retries(spark, sf_dir)


def retry_queue_reset(spark, sf_dir):
    return _retries(spark, sf_dir, reset_failed=True)


def upload_queue(spark, sf_dir):
    return _retries(spark, sf_dir, uploads=True)


def route_manifest(spark, sf_dir):
    return _manifest(spark, sf_dir).drop("created_at")


def skipped_manifest(spark, sf_dir):
    return audit.skipped_entries(audit.routed(source.part_manifest(spark, sf_dir)))


def new_manifest_rows(spark, sf_dir):
    """Parts logged as loaded count as registered; the others are new."""
    log = source.ingest_log(spark, sf_dir).filter("status = 'SUCCESS'")
    return audit.new_manifest_rows(_manifest(spark, sf_dir), log).select("output_file", "sf_table")


def manifest_summary(spark, sf_dir):
    return audit.manifest_summary(_manifest(spark, sf_dir))


def _inventory(spark, sf_dir):
    return describe_files(source.raw_files(spark, sf_dir))


def schema_fingerprint(spark, sf_dir):
    return _inventory(spark, sf_dir).select(
        "relative_path", "file_type", "region", "column_count", "columns", "schema_key"
    )


def schema_signatures(spark, sf_dir):
    return audit.schema_signatures(_inventory(spark, sf_dir))


def common_schemas(spark, sf_dir):
    top = audit.most_common_schemas(audit.schema_signatures(_inventory(spark, sf_dir)), 5)
    return top.select("schema_signature", "file_count", "column_count")


def bundle_structure(spark, sf_dir):
    return audit.bundle_structure(_inventory(spark, sf_dir))


def file_groups(spark, sf_dir):
    return audit.file_groups(_inventory(spark, sf_dir))


def size_audit(spark, sf_dir):
    return audit.size_audit(
        source.file_index(spark, sf_dir),
        source.local_files(spark, sf_dir),
        source.download_log(spark, sf_dir),
    )


def size_tolerance(spark, sf_dir):
    """Files whose size agrees with the index within the tolerance."""
    both = source.file_index(spark, sf_dir).join(source.local_files(spark, sf_dir), "file_name")
    agree = audit.sizes_agree(F.col("local_size"), F.col("file_size_bytes"))
    return both.groupBy(agree.alias("agree")).agg(F.count(F.lit(1)).alias("files"))


def missing_members(spark, sf_dir):
    index, found = source.file_index(spark, sf_dir), source.local_files(spark, sf_dir)
    return audit.missing_members(index, found, "file_name").select("file_name")


# ---- through files ------------------------------------------------------------------------------


def csv_ingest(spark, sf_dir):
    """Orders written as gzip CSV parts and read back: rows loaded, rejected and values."""
    folder = round_trips.write_legacy_parts(spark, sf_dir)
    rows = csv_parts.read_parts(spark, folder, LEGACY_V2)
    return rows.groupBy(F.year("start_time").alias("start_year"), "user_type").agg(
        F.count_if(F.col("_error").isNull()).alias("rows_loaded"),
        F.count_if(F.col("_error").isNotNull()).alias("errors_seen"),
        F.count_if(F.col("start_station_name").isNull()).alias("unnamed_starts"),
        F.sum(F.when(F.col("_error").isNull(), F.col("trip_duration"))).alias("seconds"),
        F.sum(F.when(F.col("_error").isNull(), F.col("bike_id"))).alias("bikes"),
    )


def csv_row_numbers(spark, sf_dir):
    """Row numbers run from 1 without a gap in every part."""
    folder = round_trips.write_legacy_parts(spark, sf_dir)
    per_file = (
        csv_parts.read_parts(spark, folder, LEGACY_V2)
        .groupBy("_source_file")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_source_row_number").alias("lo"),
            F.max("_source_row_number").alias("hi"),
            F.sum("_source_row_number").alias("total"),
        )
    )
    whole = (F.col("lo") == 1) & (F.col("hi") == F.col("n"))
    sound = whole & (F.col("total") * 2 == F.col("n") * (F.col("n") + 1))
    return per_file.agg(
        F.sum("n").alias("total_rows"), F.count_if(~sound).alias("misnumbered_files")
    )


def part_writer(spark, sf_dir):
    """Raw files of two regions and layouts, grouped into parts and read back."""
    return round_trips.regroup_parts(spark, sf_dir)


def staged_ingest(spark, sf_dir):
    """Parts registered, ingested, unified and logged through the warehouse."""
    return round_trips.ingest_parts(spark, sf_dir)


def incremental_stream(spark, sf_dir):
    """Event parts through the file stream, run twice; the second run adds nothing."""
    return round_trips.stream_parts_twice(spark, sf_dir, MODERN)


def ingest_recovery(spark, sf_dir):
    """Ingest after a run that broke off between its rows and its log."""
    return round_trips.ingest_after_a_crash(spark, sf_dir)


def ingest_forced(spark, sf_dir):
    """Ingest of all parts again by force; the last load takes the place of the first."""
    return round_trips.ingest_by_force(spark, sf_dir)


def ingest_archive(spark, sf_dir):
    """Loaded parts moved out of the inbox, and read from the archive."""
    return round_trips.archive_after_ingest(spark, sf_dir)


def stream_rejects(spark, sf_dir):
    """Rejected rows and the log of a stream, over a repeat and a fresh checkpoint."""
    return round_trips.stream_with_rejects(spark, sf_dir)


def read_manifest_file(spark, sf_dir):
    return round_trips.manifest_file(spark, sf_dir)


def read_load_log_file(spark, sf_dir):
    return round_trips.load_log_file(spark, sf_dir)


def read_index_file(spark, sf_dir):
    return round_trips.index_file(spark, sf_dir)


def incremental_loads(spark, sf_dir):
    """Each layout and the fact loaded in two steps, repeated, and reloaded."""
    return round_trips.loads_by_layout(spark, sf_dir)


def part_plan(spark, sf_dir):
    """Which part each raw file goes to, with parts of 40 kB."""
    files = _inventory(spark, sf_dir).filter("schema_key IS NOT NULL").withColumn("schema_key", F.left("schema_key", F.lit(1)))
    return plan_parts(files, 40_000).select("relative_path", "region", "schema_key", "part")


def part_writer_capped(spark, sf_dir):
    """Parts of at most 20,000 bytes as written, line breaks and quotes included."""
    return round_trips.capped_parts(spark, sf_dir, 20_000)


def view_ridership_jc(spark, sf_dir):
    """The stored view of Jersey City's ridership, read after the fact has grown."""
    round_trips.fact_in_two_steps(spark, sf_dir, JERSEY_CITY)
    return spark.table("rpt_ridership_over_time_jc")


def view_top_routes(spark, sf_dir):
    """The stored view of the routes, read after the fact has grown."""
    round_trips.fact_in_two_steps(spark, sf_dir, NYC)
    routes = spark.table("rpt_top_routes_nyc")
    return routes.withColumns({c: F.round(c, 8) for c in routes.columns if c.endswith(("_lat", "_lng"))})


def view_top_stations(spark, sf_dir):
    """The stored view of the stations, read after the fact has grown."""
    round_trips.fact_in_two_steps(spark, sf_dir, NYC)
    return spark.table("rpt_top_stations_nyc").selectExpr(*_STATIONS)


def fact_compaction(spark, sf_dir):
    """A fact of many appends whose crowded months are written anew."""
    return round_trips.fact_in_many_appends(spark, sf_dir)


def in_order(df: DataFrame) -> DataFrame:
    """A report's rows with their place in its order."""
    return df.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)


def ridership_in_order(spark, sf_dir):
    return in_order(ridership_over_time(spark, sf_dir)).select("place", "year_month", "member_casual", "total_rides")


def stations_in_order(spark, sf_dir):
    """The place of each activity figure in the report's order; stations that tie may stand in any order."""
    rows = in_order(_top_stations(spark, sf_dir))
    return rows.groupBy("total_activity").agg(F.min("place").alias("first_place"), F.max("place").alias("last_place"))


def routes_in_order(spark, sf_dir):
    rows = in_order(_routes(spark, sf_dir))
    return rows.groupBy("total_trips").agg(F.min("place").alias("first_place"), F.max("place").alias("last_place"))


def pending_in_order(spark, sf_dir):
    return in_order(pending_files(spark, sf_dir)).select("place", "output_file")


def failed_in_order(spark, sf_dir):
    """Failed parts from the last on; those of one moment may stand in any order."""
    rows = in_order(failed_files(spark, sf_dir))
    return rows.groupBy("ended_at_utc").agg(F.min("place").alias("first_place"), F.max("place").alias("last_place"))


def rides_by_hour(spark, sf_dir):
    """Rides of the fact by starting hour and rider type."""
    trips = rides.qualifying(_trips(spark, sf_dir))
    return trips.groupBy(
        F.hour("started_at").alias("start_hour"), text.rider_type(F.col("member_casual")).alias("member_casual")
    ).agg(F.count(F.lit(1)).alias("rides"))


def load_stamps(spark, sf_dir):
    """Load stamps are of now, in UTC, and one for all rows of a load."""
    before = F.current_timestamp() - F.expr("INTERVAL 1 HOUR")
    after = F.current_timestamp() + F.expr("INTERVAL 1 HOUR")
    stamp = F.to_timestamp(F.concat(F.col("_loaded_at_tbl").cast("string"), F.lit("Z")))
    rows = _trips(spark, sf_dir).groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("_loaded_at_tbl").alias("stamps"),
        F.count_if((stamp > before) & (stamp < after)).alias("of_now"))
    return rows


def repeated_inventory(spark, sf_dir):
    """Files listed several times count once; equal headers have equal ids."""
    files = source.raw_files(spark, sf_dir)
    twice = files.unionByName(files.filter(F.col("size_bytes") % 3 == 0)).dropDuplicates(["relative_path"])
    found = describe_files(twice)
    return found.groupBy("file_type", "region").agg(
        F.count(F.lit(1)).alias("files"), F.count_distinct("schema_id").alias("schema_ids"),
        F.count_distinct("schema_key").alias("schema_keys"))


def _named(*functions: Query) -> dict[str, Query]:
    return {f.__name__: f for f in functions}


QUERIES: dict[str, Query] = {
    "union_layouts": union_of_layouts,
    **_named(
        modern_duration, anti_join_incremental, trips_by_natural_key, rider_types,
        dim_dates, dim_dates_holiday_fanout, rides_by_season,
        dim_station, dim_station_jc_box, dim_station_by_split_key, dim_station_header_keys,
        station_observations, availability_counts,
        fact_ride, fact_incremental, fact_ride_jc, age_bucket, source_schema_label,
        role_playing_join,
        ridership_over_time, ridership_holiday_fanout, top_stations, top_stations_jc,
        top_stations_limit20, top_routes, top_routes_jc, top_routes_rank10, station_activity,
        monthly_median, lag_growth, dense_rank_counts, exact_median_of_doubles,
        rides_by_year, missing_station, end_date_check,
        latest_status, pending_files, pending_files_jc, work_queue, row_count_check, failed_files,
        partial_loads, run_overview, run_summary, copy_statuses, retry_queue, retry_queue_reset,
        upload_queue, route_manifest, skipped_manifest, new_manifest_rows, manifest_summary,
        schema_fingerprint, schema_signatures, common_schemas, bundle_structure, file_groups,
        size_audit, size_tolerance, missing_members,
        csv_ingest, csv_row_numbers, part_writer, staged_ingest, incremental_stream,
        ingest_recovery, ingest_forced, ingest_archive, stream_rejects, incremental_loads,
        read_manifest_file, read_load_log_file, read_index_file,
        ridership_in_order, stations_in_order, routes_in_order, pending_in_order, failed_in_order,
        rides_by_hour, load_stamps, repeated_inventory, part_plan, part_writer_capped,
        fact_compaction, view_ridership_jc, view_top_routes, view_top_stations,
    ),
}


def all_queries() -> dict[str, Query]:
    def shared_types(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(spark, sf_dir))

    return {name: shared_types(query) for name, query in QUERIES.items()}
