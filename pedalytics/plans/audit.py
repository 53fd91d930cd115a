"""Load audit: manifest against log, queues, row-count checks, file and schema reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pedalytics import config
from pedalytics.functions import text, time
from pedalytics.operators.ranking import latest_by_number, top_n, with_position
from pedalytics.sources.files import for_region

# Classes of bundles, and the reasons a file audit gives.
ONLY_ZIPS, CSV_AND_ZIPS, CSV_FILES, OTHER_BUNDLE = (
    "nested_zip_only", "mixed_csv_and_nested_zip", "csv_present", "empty_or_other")
COMPLETE, MISSING_FILE, SIZE_DIFFERS, NO_LOG_ENTRY, LOG_STATUS, NO_LOGGED_SIZE, LOGGED_SIZE_DIFFERS = (
    "complete", "missing_local_file", "size_mismatch ", "no_log_entry", "log_status=", "log_missing_size",
    "log_size_mismatch ")


# ---- manifest ---------------------------------------------------------------------------------


def routed(manifest: DataFrame, layout_of_key: Mapping[str, str] = config.LAYOUT_OF_KEY) -> DataFrame:
    """Manifest entries with their target schema and table; null where there is no route."""
    schema_of = {r.name: r.staging_schema for r in config.REGIONS.values()}
    table_of = {key: config.TABLE_OF_LAYOUT[layout] for key, layout in layout_of_key.items()}
    return manifest.withColumns(
        {
            "sf_schema": text.lookup(F.col("region"), schema_of),
            "sf_table": text.lookup(F.col("schema_key"), table_of),
        }
    )


def manifest_rows(routes: DataFrame) -> DataFrame:
    """Routed entries as rows of the stage manifest."""
    return routes.filter(F.col("sf_schema").isNotNull() & F.col("sf_table").isNotNull()).select(
        "output_file",
        "region",
        "schema_key",
        "sf_schema",
        "sf_table",
        F.coalesce("gzip_size_bytes", F.lit(0)).alias("gzip_size_bytes"),
        F.coalesce(F.array_size("source_files"), F.lit(0)).cast("long").alias("source_file_count"),
        time.now().alias("created_at"),
    )


def skipped_entries(routes: DataFrame) -> DataFrame:
    """Entries without a route, with the reason; the region is looked at first."""
    reason = (
        F.when(F.col("sf_schema").isNull(), F.concat(F.lit("no schema for region "), _shown("region")))
        .when(F.col("sf_table").isNull(), F.concat(F.lit("no table for key "), _shown("schema_key")))
        .alias("reason")
    )
    return routes.select("output_file", "region", "schema_key", reason).filter("reason is not null")


def _shown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def new_manifest_rows(rows: DataFrame, registered: DataFrame | None) -> DataFrame:
    """Rows whose part is not registered yet; give ``None`` for a full replacement."""
    return rows if registered is None else rows.join(registered, "output_file", "left_anti")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    return (
        manifest.groupBy("region", "sf_table")
        .agg(F.count(F.lit(1)).alias("files"))
        .orderBy("region", "sf_table")
    )


# ---- log and queues ---------------------------------------------------------------------------


def latest_status(log: DataFrame) -> DataFrame:
    """The last attempt of each file."""
    return latest_by_number(log, ["output_file"], "log_id")


def _with_last_attempt(manifest: DataFrame, log: DataFrame) -> DataFrame:
    last = latest_status(log).select(
        "output_file",
        F.col("status").alias("last_status"),
        F.col("attempt").alias("last_attempt"),
        F.col("error_message").alias("last_error"),
        F.col("ended_at_utc").alias("last_attempt_at"),
    )
    return manifest.join(last, "output_file", "left")


def is_pending(status: Column) -> Column:
    return F.coalesce(status, F.lit("PENDING")) != "SUCCESS"


def _by_target() -> list[Column]:
    return [F.asc_nulls_last(c) for c in ("region", "sf_table", "output_file")]


def pending_files(manifest: DataFrame, log: DataFrame, region: str = "all") -> DataFrame:
    """Registered parts whose last attempt, if any, was no success."""
    return (
        _with_last_attempt(for_region(manifest, region), log)
        .filter(is_pending(F.col("last_status")))
        .select(
            "output_file",
            "region",
            "sf_schema",
            "sf_table",
            "gzip_size_bytes",
            "last_status",
            "last_attempt",
            "last_error",
            "last_attempt_at",
        )
        .orderBy(*_by_target())
    )


def work_queue(
    manifest: DataFrame,
    log: DataFrame,
    region: str = "all",
    max_attempts: int | None = None,
    reset_failed: bool = False,
    force: bool = False,
) -> DataFrame:
    """Parts to load now, each with the number of its next attempt.

    With ``max_attempts``, a part that failed so often is given up, unless ``reset_failed``. ``force``
    takes parts that were loaded before, too.
    """
    within = F.lit(True) if max_attempts is None else next_attempt(F.col("last_attempt")) <= max_attempts
    pending = is_pending(F.col("last_status")) & (F.lit(reset_failed) | within)
    return (
        _with_last_attempt(for_region(manifest, region), log)
        .filter(F.lit(force) | pending)
        .select(
            "output_file",
            "region",
            "schema_key",
            "sf_schema",
            "sf_table",
            "gzip_size_bytes",
            next_attempt(F.col("last_attempt")).alias("attempt"),
        )
    )


def next_attempt(last: Column) -> Column:
    return F.coalesce(last, F.lit(0)) + 1


def queue_decision(
    status: Column,
    attempts: Column,
    verified: Column | None = None,
    reset_failed: bool = False,
    force: bool = False,
) -> Column:
    """Whether a part runs again: RUN, DONE or GIVEN_UP.

    With ``verified`` (uploads), only a verified success is done, and anything else counts as a
    failed attempt.
    """
    retry = F.lit(reset_failed) | (F.coalesce(attempts, F.lit(1)) < config.MAX_RETRIES)
    done = status == "SUCCESS"
    if verified is not None:
        done = done & F.coalesce(verified, F.lit(False))
    first_time = status.isNull() | (status == "DRY_RUN") | F.lit(force)
    return F.when(first_time, "RUN").when(done, "DONE").when(retry, "RUN").otherwise("GIVEN_UP")


def retry_queue(
    manifest: DataFrame,
    latest: DataFrame,
    reset_failed: bool = False,
    force: bool = False,
    uploads: bool = False,
) -> DataFrame:
    """Manifest entries with the decision to run, and the next attempt's number."""
    verified = ["stage_verified"] if uploads else []
    prior = latest.select(
        "output_file", F.col("status").alias("last_status"), F.col("attempt").alias("last_attempt"),
        *verified,
    )
    decision = queue_decision(
        F.col("last_status"),
        F.col("last_attempt"),
        F.col("stage_verified") if uploads else None,
        reset_failed,
        force,
    )
    return manifest.join(prior, "output_file", "left").withColumns(
        {"decision": decision, "attempt": next_attempt(F.col("last_attempt"))}
    )


def failed_files(log: DataFrame) -> DataFrame:
    return (
        latest_status(log)
        .filter(F.col("status") == "FAILED")
        .select("output_file", "attempt", "error_message", "ended_at_utc")
        .orderBy(F.desc_nulls_first("ended_at_utc"))
    )


def partial_loads(log: DataFrame) -> DataFrame:
    return (
        log.filter((F.col("status") == "SUCCESS") & (F.col("errors_seen") > 0))
        .select("output_file", "sf_table", "rows_loaded", "errors_seen", "copy_status_raw")
        .orderBy(F.desc("errors_seen"))
    )


def run_overview(log: DataFrame) -> DataFrame:
    return (
        log.groupBy("status", "region", "sf_table")
        .agg(
            F.count(F.lit(1)).alias("file_count"),
            F.sum("rows_loaded").alias("total_rows"),
            F.sum("errors_seen").alias("total_errors"),
        )
        .orderBy(*[F.asc_nulls_last(c) for c in ("region", "sf_table", "status")])
    )


def run_summary(results: DataFrame) -> DataFrame:
    """One run in figures: files, rows and megabytes per status."""
    return results.groupBy("status").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.round(F.sum("gzip_size_mb"), 1).alias("megabytes"),
    )


def statuses_by_file(attempts: DataFrame) -> DataFrame:
    """Rows and errors summed per file, and its different statuses joined by '|'."""
    return attempts.groupBy("output_file").agg(
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("errors_seen").alias("errors_seen"),
        F.array_join(F.array_sort(F.collect_set("status")), "|").alias("copy_status_raw"),
    )


# ---- row-count cross-check --------------------------------------------------------------------


def actual_counts(tables: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Row count of each (schema, table), as one labelled frame."""
    labelled = [
        df.agg(F.count(F.lit(1)).alias("actual_row_count")).select(
            F.lit(schema).alias("sf_schema"), F.lit(table).alias("sf_table"), "actual_row_count"
        )
        for (schema, table), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, labelled)


def row_count_check(log: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows the log claims against rows the tables hold."""
    claimed = (
        log.filter(F.col("status") == "SUCCESS")
        .groupBy("sf_schema", "sf_table")
        .agg(
            F.sum("rows_loaded").alias("log_rows_loaded"),
            F.count(F.lit(1)).alias("files_loaded"),
        )
    )
    return (
        claimed.join(actual, ["sf_schema", "sf_table"])
        .withColumn("discrepancy", F.col("log_rows_loaded") - F.col("actual_row_count"))
        .orderBy("sf_schema", "sf_table")
    )


# ---- files and headers ------------------------------------------------------------------------


def bundle_class(csv_files: Column, zips: Column) -> Column:
    return (
        F.when((zips > 0) & (csv_files == 0), ONLY_ZIPS)
        .when((zips > 0) & (csv_files > 0), CSV_AND_ZIPS)
        .when(csv_files > 0, CSV_FILES)
        .otherwise(OTHER_BUNDLE)
    )


def bundle_structure(inventory: DataFrame) -> DataFrame:
    """CSV and zip counts per bundle, and what kind of bundle that makes it."""
    counts = inventory.groupBy("bundle_name").agg(
        F.count_if(F.col("file_type") == "csv").alias("csv_file_count"),
        F.count_if(F.col("file_type") == "zip").alias("nested_zip_count"),
    )
    kind = bundle_class(F.col("csv_file_count"), F.col("nested_zip_count"))
    return counts.withColumn("structure_type", kind).withColumn(
        "needs_nested_extract", F.col("structure_type") == ONLY_ZIPS
    )


def schema_signatures(inventory: DataFrame, samples: int = 5) -> DataFrame:
    """Files per distinct header, most frequent first, with a few sample paths.

    The inventory is read twice; stage it when it comes straight from opening files. The samples are
    the first paths by name, cut to ``samples`` per task and header before they are shuffled.
    """
    with_header = inventory.filter(F.col("columns").isNotNull()).select("columns", "relative_path")
    counts = with_header.groupBy("columns").agg(F.count(F.lit(1)).alias("file_count"))
    by_path = W.partitionBy("columns").orderBy("relative_path")
    paths = (
        with_header.withColumn("_nth", F.row_number().over(by_path))
        .filter(F.col("_nth") <= samples)
        .groupBy("columns")
        .agg(F.array_sort(F.collect_list("relative_path")).alias("paths"))
    )
    ranked = with_position(counts.join(paths, "columns"), "file_count", "columns", "_position")
    return ranked.select(
        F.concat(F.lit("schema_"), F.col("_position").cast("string")).alias("schema_signature"),
        "file_count",
        F.size(F.split("columns", r"\|")).alias("column_count"),
        "columns",
        F.array_join("paths", " ; ").alias("sample_paths"),
    )


def most_common_schemas(signatures: DataFrame, n: int = 5) -> DataFrame:
    return top_n(signatures, n, F.desc("file_count"), F.asc("columns"))


def file_groups(inventory: DataFrame) -> DataFrame:
    """Files and megabytes per (region, header fingerprint): one group of parts each."""
    return inventory.groupBy("region", "schema_key").agg(
        F.count(F.lit(1)).alias("files"), text.megabytes(F.sum("size_bytes")).alias("megabytes")
    )


def missing_members(expected: DataFrame, found: DataFrame, *keys: str) -> DataFrame:
    """Expected archive members of which no extracted file was found."""
    return expected.join(found, list(keys), "left_anti")


def sizes_agree(actual: Column, expected: Column) -> Column:
    """Equal within the tolerance for transferred files."""
    return F.abs(actual - expected) <= config.SIZE_TOLERANCE_BYTES


def size_audit(index: DataFrame, observed: DataFrame, log: DataFrame) -> DataFrame:
    """Whether each indexed file is complete, or why not; the first failed check gives the reason.

    ``observed`` holds (file_name, local_size), ``log`` one row per file with its download status
    and logged size.
    """
    expected, local = F.col("file_size_bytes"), F.col("local_size")
    logged, status = F.col("logged_size"), F.col("download_status")

    def sizes(kind: str, actual: Column) -> Column:
        shown = [F.lit(f"({kind}="), actual, F.lit(", expected="), expected, F.lit(")")]
        return F.concat(*[c.cast("string") for c in shown])

    reason = (
        F.when(local.isNull(), MISSING_FILE)
        .when(local != expected, F.concat(F.lit(SIZE_DIFFERS), sizes("local", local)))
        .when(~F.coalesce("logged_once", F.lit(False)), NO_LOG_ENTRY)
        .when(
            ~status.eqNullSafe("SUCCESS"),
            F.concat(F.lit(LOG_STATUS), F.coalesce(status, F.lit("None"))),
        )
        .when(logged.isNull(), NO_LOGGED_SIZE)
        .when(logged != expected, F.concat(F.lit(LOGGED_SIZE_DIFFERS), sizes("logged", logged)))
        .otherwise(COMPLETE)
    )
    entries = log.select(
        "file_name",
        "download_status",
        F.col("file_size_bytes").alias("logged_size"),
        F.lit(True).alias("logged_once"),
    )
    return (
        index.select("file_name", "file_size_bytes")
        .join(observed, "file_name", "left")
        .join(entries, "file_name", "left")
        .select("file_name", "file_size_bytes", reason.alias("reason"))
        .withColumn("is_complete", F.col("reason") == COMPLETE)
    )
