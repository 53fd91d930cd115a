"""Fixed schemas. Raw files bind to a layout by column position, never by header name."""

from __future__ import annotations

from pyspark.sql import types as T

from pedalytics.config import LEGACY_V1, LEGACY_V2, MODERN

_S, _L, _I, _D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
_TS, _DEC, _B = T.TimestampNTZType(), T.DecimalType(10, 2), T.BooleanType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


LAYOUT_SCHEMA = {
    MODERN: _struct(
        ("ride_id", _S), ("rideable_type", _S), ("started_at", _TS), ("ended_at", _TS),
        ("start_station_name", _S), ("start_station_id", _S),
        ("end_station_name", _S), ("end_station_id", _S),
        ("start_lat", _D), ("start_lng", _D), ("end_lat", _D), ("end_lng", _D),
        ("member_casual", _S),
    ),
    LEGACY_V1: _struct(
        ("tripduration", _L), ("starttime", _TS), ("stoptime", _TS),
        ("start_station_id", _L), ("start_station_name", _S),
        ("start_station_latitude", _D), ("start_station_longitude", _D),
        ("end_station_id", _L), ("end_station_name", _S),
        ("end_station_latitude", _D), ("end_station_longitude", _D),
        ("bikeid", _L), ("usertype", _S), ("birth_year", _I), ("gender", _I),
    ),
    LEGACY_V2: _struct(
        ("trip_duration", _L), ("start_time", _TS), ("stop_time", _TS),
        ("start_station_id", _L), ("start_station_name", _S),
        ("start_station_latitude", _D), ("start_station_longitude", _D),
        ("end_station_id", _L), ("end_station_name", _S),
        ("end_station_latitude", _D), ("end_station_longitude", _D),
        ("bike_id", _L), ("user_type", _S), ("birth_year", _I), ("gender", _I),
    ),
}

# Header lines of the raw files, by which a layout is recognised.
RAW_HEADER = {
    MODERN: (
        "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
        "start_station_id", "end_station_name", "end_station_id", "start_lat", "start_lng",
        "end_lat", "end_lng", "member_casual",
    ),
    LEGACY_V1: (
        "tripduration", "starttime", "stoptime", "start station id", "start station name",
        "start station latitude", "start station longitude", "end station id", "end station name",
        "end station latitude", "end station longitude", "bikeid", "usertype", "birth year",
        "gender",
    ),
    LEGACY_V2: (
        "Trip Duration", "Start Time", "Stop Time", "Start Station ID", "Start Station Name",
        "Start Station Latitude", "Start Station Longitude", "End Station ID", "End Station Name",
        "End Station Latitude", "End Station Longitude", "Bike ID", "User Type", "Birth Year",
        "Gender",
    ),
}

LINEAGE = ("_source_file", "_source_row_number")

STAGING_META = _struct(("_source_file", _S), ("_source_row_number", _L), ("_loaded_at", _TS))

# Unified trips, without the surrogate key: that one is derived from the lineage columns.
TRIPS_ALL = _struct(
    ("ride_id", _S), ("rideable_type", _S), ("bikeid", _L),
    ("started_at", _TS), ("ended_at", _TS), ("trip_duration", _L),
    ("start_station_name", _S), ("start_station_id", _S),
    ("end_station_name", _S), ("end_station_id", _S),
    ("start_lat", _D), ("start_lng", _D), ("end_lat", _D), ("end_lng", _D),
    ("member_casual", _S), ("birth_year", _I), ("gender", _I),
    ("_source_file", _S), ("_source_row_number", _L),
    ("_loaded_at", _TS), ("_loaded_at_tbl", _TS),
)

MANIFEST_FILE = _struct(
    ("output_file", _S), ("region", _S), ("snowflake_schema_folder", _S), ("schema_key", _S),
    ("gzip_size_bytes", _L), ("source_files", T.ArrayType(_S)), ("created_at_utc", _S),
)

STAGE_MANIFEST = _struct(
    ("output_file", _S), ("region", _S), ("schema_key", _S), ("sf_schema", _S), ("sf_table", _S),
    ("gzip_size_bytes", _L), ("source_file_count", _L), ("created_at", _TS),
)

INGEST_LOG = _struct(
    ("log_id", _L), ("output_file", _S), ("region", _S), ("schema_key", _S),
    ("sf_schema", _S), ("sf_table", _S), ("gzip_size_mb", _D), ("attempt", _I),
    ("triggered_by", _S), ("started_at_utc", _TS), ("ended_at_utc", _TS), ("status", _S),
    ("rows_loaded", _L), ("errors_seen", _L), ("copy_status_raw", _S), ("error_message", _S),
    ("created_at", _TS),
)

LOAD_LOG_FILE = _struct(
    ("output_file", _S), ("region", _S), ("schema_key", _S), ("gzip_size_mb", _D),
    ("source_files", T.ArrayType(_S)), ("attempt", _I), ("started_at_utc", _S),
    ("ended_at_utc", _S), ("status", _S), ("sf_schema", _S), ("sf_stage", _S), ("sf_table", _S),
    ("put_status", _S), ("copy_rows_loaded", _L), ("copy_errors_seen", _L),
    ("copy_statuses", T.ArrayType(_S)), ("error_message", _S),
)

UPLOAD_LOG_FILE = _struct(
    ("output_file", _S), ("stage_file_name", _S), ("region", _S), ("schema_key", _S),
    ("gzip_size_mb", _D), ("attempt", _I), ("started_at_utc", _S), ("ended_at_utc", _S),
    ("status", _S), ("put_status", _S), ("sf_stage", _S), ("stage_list_name", _S),
    ("stage_verified", _B), ("error_message", _S),
)

DOWNLOAD_LOG_FILE = _struct(
    ("file_name", _S), ("file_url", _S), ("download_start_utc", _S), ("download_end_utc", _S),
    ("download_status", _S), ("file_size_bytes", _L), ("local_zip_path", _S),
    ("unzip_status", _S), ("extracted_files", T.ArrayType(_S)), ("error_message", _S),
)

EXTRACT_LOG_FILE = _struct(
    ("bundle_name", _S), ("nested_zip_path", _S), ("extract_dir", _S), ("extract_start_utc", _S),
    ("extract_end_utc", _S), ("extract_status", _S), ("csv_file_count", _I), ("error_message", _S),
)

FILE_INDEX = _struct(
    ("file_name", _S), ("s3_key", _S), ("file_format", _S), ("file_size_bytes", _L),
    ("last_modified", T.TimestampType()), ("file_url", _S),
)
