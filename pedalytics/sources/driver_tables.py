"""Trip layouts derived from the driver's order, line-item and event tables.

Plain projections: no join, no window, no shuffle, so this feeds the engine at any scale. Lineage is
the position of the row in its Parquet file, as it is the position in a CSV file after an ingest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalytics.config import LAYOUT_OF_KEY, LEGACY_V1, LEGACY_V2, MODERN, NYC, Region
from pedalytics.schemas import LAYOUT_SCHEMA, STAGING_META

# The driver's orders date from 1995 on; so moved, some fall before the calendar, most into it.
YEARS_LATER = "INTERVAL '17' YEAR"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _name(no: str, row: str) -> str:
    """Name of station ``no`` in one of several spellings; on some rows it is blank or missing."""
    plain = f"concat('Pier ', {no}, ' St')"
    return (
        f"CASE WHEN ({row}) % 97 = 0 THEN '' WHEN ({row}) % 89 = 0 THEN CAST(NULL AS STRING) "
        f"WHEN ({row}) % 3 = 0 THEN concat('  ', upper({plain}), ' ') ELSE {plain} END"
    )


def _lat(no: str, row: str) -> str:
    """Latitude of a station with some noise per row."""
    return f"40.0D + double(({no}) % 250) / 100.0D + double(({row}) % 7 - 3) / 10000.0D"


def _lng(no: str, row: str) -> str:
    return f"-75.2D + double(({no}) % 170) / 50.0D + double(({row}) % 11 - 5) / 10000.0D"


def _place(side: str, no: str, row: str, where: str, lat: str, lng: str) -> dict[str, str]:
    return {
        f"{side}_station_id": no,
        f"{side}_station_name": _name(no, row),
        f"{side}_{lat}": _lat(no, where),
        f"{side}_{lng}": _lng(no, where),
    }


def _lineage(region: Region, layout: str) -> dict[str, str]:
    key = next(k for k, v in LAYOUT_OF_KEY.items() if v == layout)
    stem = "replace(_metadata.file_name, '.parquet', '')"
    return {
        "_source_file": f"concat('{region.name}_{key}_part-', {stem}, '.csv.gz')",
        "_source_row_number": "_metadata.row_index + 1",
        "_loaded_at": "current_timestamp()",
    }


def _after(ts: str, seconds: str) -> str:
    return f"{ts} + INTERVAL '1' SECOND * ({seconds})"


def _layout(df: DataFrame, region: Region, layout: str, columns: dict[str, str]) -> DataFrame:
    """The columns in the order and types of the layout's staging table."""
    exprs = columns | _lineage(region, layout)
    fields = [*LAYOUT_SCHEMA[layout].fields, *STAGING_META.fields]
    return df.selectExpr(
        *[f"CAST({exprs[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in fields]
    )


def modern_staging(spark: SparkSession, sf_dir: str, region: Region = NYC) -> DataFrame:
    """Rides of the current layout from ``events``; times carry microseconds."""
    columns = {
        "ride_id": "event_id",
        "rideable_type": "concat(' ', upper(event_type))",
        "started_at": "ts",
        "ended_at": _after("ts", "round(value * 37, 2)"),
        **_place("start", "user_id % 240", "event_id", "event_id", "lat", "lng"),
        **_place("end", "event_id % 240", "event_id + 1", "event_id + 1", "lat", "lng"),
        "member_casual": "CASE user_id % 3 WHEN 0 THEN 'member' WHEN 1 THEN ' Casual ' END",
    }
    return _layout(read(spark, sf_dir, "events"), region, MODERN, columns)


def legacy_v1_staging(spark: SparkSession, sf_dir: str, region: Region = NYC) -> DataFrame:
    """Rides of the first legacy layout from ``lineitem``."""
    seconds, lat, lng = "floor(l_extendedprice)", "station_latitude", "station_longitude"
    began = _after(f"(l_shipdate + {YEARS_LATER})", "(l_orderkey * 61 + l_partkey) % 86400")
    end = "l_partkey % 300"
    columns = {
        "tripduration": seconds,
        "starttime": began,
        "stoptime": _after(began, seconds),
        **_place("start", "l_suppkey", "l_orderkey", "l_orderkey", lat, lng),
        **_place("end", end, "l_orderkey + l_linenumber", "l_partkey", lat, lng),
        "bikeid": "l_partkey",
        "usertype": "CASE WHEN l_returnflag = 'A' THEN 'Subscriber' "
        "WHEN l_returnflag = 'R' THEN 'CUSTOMER' WHEN l_linenumber < 7 THEN 'Dependent' END",
        "birth_year": "CASE WHEN l_linenumber <> 6 THEN 1880 + l_orderkey % 140 END",
        "gender": "l_linenumber % 3",
    }
    return _layout(read(spark, sf_dir, "lineitem"), region, LEGACY_V1, columns)


def legacy_v2_staging(spark: SparkSession, sf_dir: str, region: Region = NYC) -> DataFrame:
    """Rides of the second legacy layout from ``orders``."""
    seconds, lat, lng = "floor(o_totalprice) % 100000", "station_latitude", "station_longitude"
    began = _after(f"(o_orderdate + {YEARS_LATER})", "(o_custkey * 53 + o_orderkey) % 86400")
    columns = {
        "trip_duration": seconds,
        "start_time": began,
        "stop_time": _after(began, seconds),
        **_place("start", "o_custkey % 300", "o_orderkey", "o_orderkey", lat, lng),
        **_place("end", "o_orderkey % 400", "o_orderkey + 1", "o_orderkey + 1", lat, lng),
        "bike_id": "o_custkey",
        "user_type": "CASE o_orderstatus WHEN 'F' THEN 'subscriber' WHEN 'O' THEN 'Customer' END",
        "birth_year": "1900 + o_custkey % 125",
        "gender": "o_orderkey % 3",
    }
    return _layout(read(spark, sf_dir, "orders"), region, LEGACY_V2, columns)


def staging(spark: SparkSession, sf_dir: str, region: Region = NYC) -> dict[str, DataFrame]:
    return {
        MODERN: modern_staging(spark, sf_dir, region),
        LEGACY_V1: legacy_v1_staging(spark, sf_dir, region),
        LEGACY_V2: legacy_v2_staging(spark, sf_dir, region),
    }


# ---- manifest, log, index and inventory frames for the audit queries ----------------------------


def _cents(c: Column) -> Column:
    return F.round(c * 100).cast("long")


def _part_columns() -> dict[str, Column]:
    """The part an order belongs to: one per month, status and priority of the orders."""
    priority = F.left("o_orderpriority", F.lit(1))
    region = (
        F.when(priority.isin("1", "2"), "jersey_city").when(priority == "5", "uptown").otherwise("nyc")
    )
    key = (
        F.when(priority == "4", "ffffffffffff")
        .when(F.col("o_orderstatus") == "F", "dc497b4333c4")
        .when(F.col("o_orderstatus") == "O", "473144999085")
        .otherwise("e24ee8457e0e")
    )
    month = F.date_format("o_orderdate", "yyyyMM")
    name = F.concat(region, F.lit("_"), key, F.lit("_part"), month, priority, "o_orderstatus")
    return {
        "region": region,
        "schema_key": key,
        "output_file": F.concat(region, F.lit("/"), key, F.lit("/"), name, F.lit(".csv.gz")),
    }


def part_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A part manifest with one entry per order month, status and priority."""
    orders = read(spark, sf_dir, "orders").withColumns(_part_columns())
    return orders.groupBy("output_file", "region", "schema_key").agg(
        F.sum(_cents(F.col("o_totalprice"))).alias("gzip_size_bytes"),
        F.array_repeat(F.lit("x.csv"), (F.count(F.lit(1)) % 4).cast("int")).alias("source_files"),
    )


def ingest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load log with one attempt per order; some parts have none."""
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    status = (
        F.when(customer % 4 == 0, "FAILED").when(customer % 9 == 1, "DRY_RUN").otherwise("SUCCESS")
    )
    unlogged = (F.left("o_orderpriority", F.lit(1)) == "3") & (F.month("o_orderdate") % 4 == 0)
    key, region = F.col("schema_key"), F.col("region")
    layout = F.when(key == "dc497b4333c4", "TRIPS_MODERN").when(key == "473144999085", "TRIPS_LEGACY_V1")
    return (
        read(spark, sf_dir, "orders")
        .filter(~unlogged)
        .withColumns(_part_columns())
        .select(
            order.alias("log_id"),
            "output_file",
            "region",
            "schema_key",
            F.when(region == "jersey_city", "STAGING_JC").otherwise("STAGING_NYC").alias("sf_schema"),
            layout.when(key == "e24ee8457e0e", "TRIPS_LEGACY_V2").alias("sf_table"),
            (_cents(F.col("o_totalprice")) / 1024.0).alias("gzip_size_mb"),
            (1 + order % 5).cast("int").alias("attempt"),
            F.expr(_after("o_orderdate", "o_orderkey")).alias("ended_at_utc"),
            status.alias("status"),
            customer.alias("rows_loaded"),
            F.when(customer % 6 != 5, order % 4).alias("errors_seen"),
            F.concat_ws("|", status, F.col("o_orderstatus")).alias("copy_status_raw"),
            F.when(status == "FAILED", F.concat(F.lit("error "), customer.cast("string"))).alias(
                "error_message"
            ),
            (customer % 3 == 0).alias("stage_verified"),
        )
    )


def _zip_name() -> Column:
    return F.concat(F.col("o_orderkey").cast("string"), F.lit("-trips.zip")).alias("file_name")


def file_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index of archives, one per order."""
    return read(spark, sf_dir, "orders").select(
        _zip_name(), _cents(F.col("o_totalprice")).alias("file_size_bytes")
    )


def local_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes found on disk: some archives are missing or of another size."""
    size, customer = _cents(F.col("o_totalprice")), F.col("o_custkey")
    off = F.when(customer % 5 == 0, 1000).when(customer % 7 == 0, 5000).otherwise(0)
    return (
        read(spark, sf_dir, "orders")
        .filter(customer % 11 != 0)
        .select(_zip_name(), (size + off).alias("local_size"))
    )


def download_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last download entry per archive: some are missing, failed or of another size."""
    size, customer = _cents(F.col("o_totalprice")), F.col("o_custkey")
    status = F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCESS")
    logged = F.when(customer % 17 == 0, None).when(customer % 19 == 0, size + 3).otherwise(size)
    return (
        read(spark, sf_dir, "orders")
        .filter(customer % 13 != 0)
        .select(_zip_name(), status.alias("download_status"), logged.alias("file_size_bytes"))
    )


def raw_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw files as an inventory scan finds them, one per part: path, size and header."""
    size, key = F.col("p_size"), F.col("p_partkey")
    folder = F.when(size % 4 == 0, F.concat(F.lit("jc-"), "p_brand")).otherwise(F.col("p_brand"))
    is_zip = (size % 3 == 0) | F.col("p_brand").endswith("1")
    prefix = F.when(size % 5 == 0, "JC-").otherwise("")
    path = F.concat(
        folder,
        F.lit("/"),
        F.replace(F.col("p_name"), F.lit(" "), F.lit("/")),
        F.lit("/"),
        prefix,
        key.cast("string"),
        F.when(is_zip, ".zip").otherwise(".CSV"),
    )
    header = F.array(
        F.lit("Trip Id"), F.concat(F.lit(" "), F.upper("p_name")), F.col("p_type"), F.lit("station ")
    )
    return read(spark, sf_dir, "part").select(
        path.alias("relative_path"),
        _cents(F.col("p_retailprice")).alias("size_bytes"),
        F.when(~is_zip, header).alias("columns"),
    )
