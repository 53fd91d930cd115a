"""Grouped, size-capped ``.csv.gz`` parts and their manifest."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics import config
from pedalytics.functions import text, time
from pedalytics.operators.prefix import running_total
from pedalytics.session import delete, one_file_per_task, release, short_shuffles, stage, unsorted_writes
from pedalytics.sources.csv_parts import source_label
from pedalytics.sources.files import file_key, file_keys, list_files

# Text shrinks about this much under gzip; a first guess at part sizes, which are looked at once they are written.
GZIP_RATIO = 3
# Text that one write of parts shuffles; its shuffle files, about as large, go before the next write begins.
WRITE_BYTES = 12 << 30
# Written as read: quoted where needed, and no trimming.
CSV_OUT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def plan_parts(inventory: DataFrame, max_bytes: int = config.MAX_PART_BYTES) -> DataFrame:
    """Which part each file goes to: files of a (region, fingerprint) group, smallest first, are
    added until the part is full.

    The bytes before a file are a running total over ranges of files, so a group of any size is planned
    by many tasks.
    """
    files = inventory.filter("schema_key is not null")
    by_size = [F.asc("size_bytes"), F.asc("relative_path")]
    placed = running_total(files, ["region", "schema_key"], by_size, F.col("size_bytes"), "_before")
    number = (F.floor(F.col("_before") / F.lit(max_bytes * GZIP_RATIO)) + 1).cast("string")
    return placed.withColumn("part", F.lpad(number, F.greatest(F.lit(4), F.length(number)), F.lit("0"))).drop("_before")


def write_parts(
    spark: SparkSession,
    root: str,
    inventory: DataFrame,
    out: str,
    region: str = "all",
    max_bytes: int = config.MAX_PART_BYTES,
    consume: bool = False,
) -> DataFrame:
    """Write the files of the inventory below ``root`` as gzip CSV parts; returns the manifest.

    One write per layout, since columns differ, and per ``WRITE_BYTES`` of its files, since a write keeps all
    of its text on local disks once more. Rows meet their part through a join with the plan
    (one row per file, broadcast if small) and a rebalance that splits an outsized part, so a single
    huge file is compressed by many tasks. Parts land in ``region=/schema_key=/part=`` folders. A part whose
    bytes as written are above ``max_bytes`` is cut up, until each is within it or holds one row.
    ``consume`` deletes raw files once their parts are written.
    """
    chosen = inventory if region == "all" else inventory.filter(F.col("region") == region)
    plan = stage(plan_parts(chosen, max_bytes), "part-plan")
    for layout in plan.groupBy("schema_key").agg(F.min("columns").alias("columns")).toLocalIterator():
        _write_layout(spark, root, plan, layout["schema_key"], layout["columns"].split("|"), out, max_bytes, consume)
    return parts_manifest(spark, out, plan)


def _write_layout(
    spark: SparkSession,
    root: str,
    plan: DataFrame,
    schema_key: str,
    columns: list[str],
    out: str,
    max_bytes: int,
    consume: bool,
) -> None:
    base = root.rstrip("/")
    parts = f"{out.rstrip('/')}/region=*/schema_key={schema_key}/part=*"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])

    for files in slices_of_parts(plan.filter(F.col("schema_key") == schema_key), WRITE_BYTES):
        _write_slice(spark, base, files, schema, schema_key, out, max_bytes)
        for r in files if consume else ():
            delete(spark, f"{base}/{r['relative_path']}")
    while _cut_oversized(spark, parts, schema, out, max_bytes):
        pass


def slices_of_parts(plan: DataFrame, most: int) -> Iterator[list[Row]]:
    """(relative_path, region, part, size_bytes) of planned files: whole parts of ``most`` bytes together, or one larger part."""
    columns = ["relative_path", "region", "part", "size_bytes"]
    ordered = plan.select(*columns).orderBy("region", "part", "relative_path").toLocalIterator()
    files: list[Row] = []
    filled = 0
    for _, part in itertools.groupby(ordered, lambda r: (r["region"], r["part"])):
        own = list(part)
        size = sum(r["size_bytes"] or 0 for r in own)
        if files and filled + size > most:
            yield files
            files, filled = [], 0
        files, filled = files + own, filled + size
    if files:
        yield files


def _write_slice(
    spark: SparkSession, base: str, files: list[Row], schema: T.StructType, schema_key: str, out: str, max_bytes: int
) -> None:
    paths = [f"{base}/{r['relative_path']}" for r in files]
    scan = (
        short_shuffles(unsorted_writes(spark))
        .read.schema(schema)
        .options(header=True, enforceSchema=True, quote='"', escape='"', multiLine=True)
        .csv(paths)
    )
    # Addresses are decoded once a file; rows are joined by a hash of them.
    places = spark.createDataFrame([r[:3] for r in files], "relative_path string, region string, part string")
    named = file_keys(spark, scan).withColumn("relative_path", text.below(text.decoded(F.col("path")), base))
    placed_files = stage(named.join(places, "relative_path").select("_file", "region", "part"), "placed-files")
    rows = scan.withColumn("_file", file_key())
    average = spark.read.text(paths).agg(mean_record()).first()[0] or 1.0
    per_file = max(1, int(max_bytes * GZIP_RATIO / average))
    placed = rows.join(placed_files, "_file").drop("_file").withColumn("schema_key", F.lit(schema_key))
    _write_csv(placed.hint("rebalance", "region", "part"), out, per_file)
    release(placed_files)


def mean_record() -> Column:
    """Mean bytes of a record over the lines ``value`` of CSV files, for a first guess without parsing them.

    A record broken over lines begins and ends with a line of an odd number of quotes.
    """
    line, quote = F.col("value"), F.lit('"')
    odd = line.contains(quote) & ((F.octet_length(line) - F.octet_length(F.replace(line, quote))) % 2 == 1)
    records = F.count(F.lit(1)) - F.count_if(odd) / 2
    return F.sum(F.octet_length("value") + 1) / F.greatest(records, F.lit(1))


def _write_csv(rows: DataFrame, out: str, per_file: int) -> None:
    (
        rows.write.mode("append")
        .partitionBy("region", "schema_key", "part")
        .options(compression="gzip", maxRecordsPerFile=per_file, **CSV_OUT)
        .csv(out)
    )


def _cut_oversized(spark: SparkSession, parts: str, schema: T.StructType, out: str, max_bytes: int) -> bool:
    """Write written parts above ``max_bytes`` anew in files of fewer rows; whether there were any.

    The new files are there before the old ones go. Each part is read by one task, and all of them are
    cut by the same number of rows, the least that one of them needs.
    """
    sizes = list_files(spark, parts, "*.csv.gz").filter(F.col("size_bytes") > max_bytes).select("path", "size_bytes")
    paths = [r["path"] for r in sizes.toLocalIterator()]  # names of the parts to write anew
    if not paths:
        return False
    path = text.decoded(F.col("_metadata.file_path"))
    found = (
        one_file_per_task(spark)
        .read.schema(schema)
        .options(header=True, enforceSchema=True, quote='"', escape='"', multiLine=True)
        .csv(paths)
        .withColumns({c: F.regexp_extract(path, rf"/{c}=([^/]+)/", 1) for c in ("region", "schema_key", "part")})
        .withColumn("_path", text.basename(path))
    )
    counts = found.groupBy("_path").agg(F.count(F.lit(1)).alias("n"))
    large = sizes.select(text.basename(F.col("path")).alias("_path"), "size_bytes").join(counts.filter("n > 1"), "_path")
    fits = large.select(F.min(F.floor(F.col("n") * (0.9 * max_bytes) / F.col("size_bytes")))).first()[0]
    if fits is None:
        return False  # what is left are single rows
    several = counts.filter("n > 1").select("_path")
    _write_csv(found.join(several, "_path", "left_semi").drop("_path"), out, max(1, int(fits)))
    several = {r["_path"] for r in several.toLocalIterator()}
    for old in paths:
        if old.rpartition("/")[2] in several:
            delete(spark, old)
    return True


def parts_manifest(spark: SparkSession, out: str, plan: DataFrame) -> DataFrame:
    """One manifest row per written part: folder path, region, key, bytes, source files, time."""
    path = F.col("path")
    written = list_files(spark, out, "*.csv.gz").select(
        F.regexp_extract(path, r"(region=[^/]+/schema_key=[^/]+/.+)$", 1).alias("output_file"),
        F.regexp_extract(path, r"region=([^/]+)/", 1).alias("region"),
        F.regexp_extract(path, r"schema_key=([^/]+)/", 1).alias("schema_key"),
        F.regexp_extract(path, r"part=([^/]+)/", 1).alias("part"),
        F.col("size_bytes").alias("gzip_size_bytes"),
        source_label(path).alias("source_file"),
    )
    sources = plan.groupBy("region", "schema_key", "part").agg(
        F.array_sort(F.collect_set("relative_path")).alias("source_files")
    )
    return written.join(sources, ["region", "schema_key", "part"], "left").select(
        "output_file",
        "region",
        F.col("region").alias("snowflake_schema_folder"),
        "schema_key",
        "gzip_size_bytes",
        "source_files",
        time.now().cast("string").alias("created_at_utc"),
    )


def write_manifest(manifest: DataFrame, path: str) -> None:
    manifest.write.mode("append").json(path)


def write_report(report: DataFrame, path: str, as_json: bool = False) -> None:
    """Inventory, schema and bundle reports as CSV or JSON files."""
    writer = report.write.mode("overwrite")
    if as_json:
        writer.json(path)
    else:
        writer.option("header", True).csv(path)
