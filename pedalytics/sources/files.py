"""Manifest, log and index readers, and the inventory of raw CSV files."""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics import schemas
from pedalytics.functions import text
from pedalytics.operators.ranking import latest_per_key
from pedalytics.session import one_file_per_task

_HEADS = "path string, size_bytes long, modificationTime timestamp, columns array<string>"


def read_manifest(spark: SparkSession, path: str, region: str | None = None) -> DataFrame:
    """Part manifest (JSON lines); ``None`` or ``'all'`` keeps every region."""
    manifest = spark.read.schema(schemas.MANIFEST_FILE).json(path)
    return for_region(manifest, region)


def for_region(df: DataFrame, region: str | None) -> DataFrame:
    return df if region in (None, "all") else df.filter(F.col("region") == region)


def read_log(
    spark: SparkSession, path: str, schema: T.StructType, key: str, *order: str
) -> DataFrame:
    """JSON-lines log with unreadable lines skipped and only the last entry per key."""
    lines = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    return latest_per_key(lines.filter(F.col(key).isNotNull()), [key], *order)


def read_load_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.LOAD_LOG_FILE, "output_file", "attempt", "ended_at_utc")


def read_upload_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.UPLOAD_LOG_FILE, "output_file", "attempt", "ended_at_utc")


def read_download_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.DOWNLOAD_LOG_FILE, "file_name", "download_end_utc")


def read_extract_log(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, schemas.EXTRACT_LOG_FILE, "nested_zip_path", "extract_end_utc")


def read_file_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FILE_INDEX).option("header", True).csv(path)


def index_entry(key: Column, size: Column, modified: Column, base_url: str) -> list[Column]:
    """Index columns of one stored object: name, key, format, size, time and address."""
    name = text.basename(key)
    return [
        name.alias("file_name"),
        key.alias("s3_key"),
        text.extension(name).alias("file_format"),
        size.alias("file_size_bytes"),
        modified.alias("last_modified"),
        F.concat(F.lit(base_url), key).alias("file_url"),
    ]


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of all files below ``root``; their content is not read.

    Spark's file scans leave out files of zero bytes, so these are not listed.
    """
    found = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter=pattern)
        .load(root)
    )
    return found.select("path", F.col("length").alias("size_bytes"), "modificationTime")


def file_key() -> Column:
    """Hash of the address of the file that a row is read from: eight bytes a row, and nothing is made of the text."""
    return F.xxhash64(F.input_file_name())


def file_keys(spark: SparkSession, scan: DataFrame) -> DataFrame:
    """(path, _file) of the files of a scan: their addresses as ``plain_uri`` spells them, and their ``file_key``.

    Local addresses are listed under both of their spellings, so it does not matter which one a scan gives.
    """
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "_uri string")
    plain = plain_uri(F.col("_uri"))
    spelled = F.array_distinct(F.array("_uri", plain, F.regexp_replace(plain, "^file:/(?!/)", "file:///")))
    return listed.select(plain.alias("path"), F.explode(spelled).alias("_uri")).select("path", F.xxhash64("_uri").alias("_file")).distinct()


def plain_uri(uri: Column) -> Column:
    """Local addresses with one slash, as in ``_metadata.file_path``."""
    return F.replace(uri, F.lit("file:///"), F.lit("file:/"))


def open_stream(path: str):
    """The bytes of a file as they are stored."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_stream(path.removeprefix("file:").replace("//", "/"), compression=None)
    store, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return store.open_input_stream(inner, compression=None)


def _read_heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    csv.field_size_limit(1 << 31)

    def head(path: str) -> list[str] | None:
        with open_stream(path) as stream:
            lines = io.TextIOWrapper(stream, "utf-8", errors="replace", newline="")
            return next(csv.reader(lines), None) or None

    for batch in batches:
        yield batch.assign(columns=batch["path"].map(head))


def _heads_by_scan(spark: SparkSession, root: str) -> DataFrame:
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = (
        one_file_per_task(spark)
        .read.options(recursiveFileLookup=True, pathGlobFilter="*.[cC][sS][vV]")
        .text(root)
    )
    first = lines.select(
        text.decoded(F.col("_metadata.file_path")).alias("_file"), "value", position.alias("_position")
    ).filter(F.col("_position") == 0)
    header = F.when(F.trim("value") != "", text.header_columns(F.col("value")))
    return first.select("_file", header.alias("columns"))


def inventory(spark: SparkSession, root: str, tasks: int | None = None, scan: bool = False) -> DataFrame:
    """CSV and zip files below ``root``: bundle, path, size, header columns, fingerprint, region.

    One distributed pass opens each CSV for its first record only, however long; nothing is read
    in full. It opens what pyarrow can (local, s3, gs, hdfs with its library). ``scan`` reads the
    files through Spark instead, for any other file system, at the price of reading them whole.
    """
    listed = (
        list_files(spark, root)
        .filter(F.lower("path").rlike(r"\.(csv|zip)$") & ~F.col("path").contains("/__MACOSX/"))
        .dropDuplicates(["path"])
    )
    is_csv = F.lower("path").endswith(".csv")
    csv_files = listed.filter(is_csv)
    if scan:
        found = _heads_by_scan(spark, root)
        heads = csv_files.join(
            found, text.below(F.col("path"), root) == text.below(F.col("_file"), root), "left"
        ).drop("_file")
    else:
        dealt = csv_files.repartition(tasks, "path") if tasks else csv_files.repartition("path")
        heads = dealt.mapInPandas(_read_heads, _HEADS)
    no_head = F.lit(None).cast("array<string>").alias("columns")
    files = heads.unionByName(listed.filter(~is_csv).select("*", no_head))
    relative = text.below(F.col("path"), root).alias("relative_path")
    return describe_files(files.select(relative, "size_bytes", "columns"))


def describe_files(files: DataFrame) -> DataFrame:
    """Derived inventory columns for (relative_path, size_bytes, columns)."""
    path, columns = F.col("relative_path"), F.col("columns")
    trimmed = F.transform(columns, lambda c: F.trim(c))
    return files.select(
        F.element_at(F.split(path, "/"), 1).alias("bundle_name"),
        path,
        text.extension(text.basename(path)).alias("file_type"),
        "size_bytes",
        F.when(columns.isNotNull(), F.size(columns)).alias("column_count"),
        F.when(columns.isNotNull(), F.concat_ws("|", trimmed)).alias("columns"),
        F.when(columns.isNotNull(), F.xxhash64(F.concat_ws("|", trimmed))).alias("schema_id"),
        text.header_fingerprint(columns).alias("schema_key"),
        text.region_of_path(path).alias("region"),
    )
