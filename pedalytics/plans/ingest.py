"""Batch ingest: pending parts to staging tables, with one log row per attempt.

The log is the commit. A run writes the rows of its parts to a folder of its own in the staging table
(``_load=<start of the run in microseconds>``), and only then the log rows, as one file. Rows count
only if the log has a success of that run for their part (``committed``); so what a run that broke
off has left behind, or what belongs to a part that failed, is never seen, and the parts are simply
taken up again. Of several successes of a part the last one counts.

All parts of a table are read in one scan. If it breaks, each part is opened by itself in a
distributed check, parts that cannot be read are logged as failed, and the rest is scanned once
more; a failure that no part explains (a full disk, lost permissions) ends the run and blames none.
"""

from __future__ import annotations

import datetime as dt
import itertools
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pedalytics.config import LAYOUT_OF_TABLE
from pedalytics.functions import text, time
from pedalytics.plans import audit
from pedalytics.schemas import INGEST_LOG
from pedalytics.session import release, stage
from pedalytics.sources import csv_parts, files

SLICE = 5_000  # parts whose names the driver holds at a time
TRIGGERED_BY = "ingest"


@dataclass(frozen=True)
class IngestResult:
    """Figures of one ingest run."""

    region: str
    total: int
    success: int
    failed: int
    skipped: int = 0  # registered parts that were loaded before or are given up

    def __str__(self) -> str:
        return (
            f"ingest complete | region={self.region} | total={self.total} | "
            f"success={self.success} | failed={self.failed} | skipped={self.skipped}"
        )


def load_id(started: dt.datetime) -> int:
    """Name of a run: its start in microseconds, which its log rows carry as well."""
    return (started - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


def committed(log: DataFrame) -> DataFrame:
    """(_load, _source_file) of the last success of each part."""
    done = log.filter(F.col("status") == "SUCCESS").groupBy("output_file").agg(F.max("started_at_utc").alias("at"))
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', at)")
    return done.select(micros.alias("_load"), _label().alias("_source_file"))


def _label():
    return csv_parts.source_label(F.concat(F.lit("/"), F.col("output_file")))


def visible(staged: DataFrame, log: DataFrame) -> DataFrame:
    """Good rows of a staging table that the log has committed; ``_load`` prunes the folders of other runs."""
    good = staged.filter(~F.col("_rejected"))
    return good.join(committed(log), ["_load", "_source_file"], "left_semi").drop("_rejected", "_load")


def unreadable(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Parts that cannot be opened or unpacked to their end, with the reason; one task opens some of them.

    Only what is wrong with the part itself counts: it is not there, or its bytes are no gzip stream.
    Any other failure is raised.
    """

    def fault(path: str) -> str | None:
        try:
            with files.open_stream(path) as stream:
                if not path.endswith(".gz"):
                    return None
                packed, empty = zlib.decompressobj(31), True
                while block := stream.read(1 << 20):
                    empty = False
                    while block:
                        packed.decompress(block)
                        block = packed.unused_data
                        if packed.eof and block:
                            packed = zlib.decompressobj(31)
                return None if packed.eof or empty else "the part ends within its gzip stream"
        except FileNotFoundError:
            return "the part is not there"
        except zlib.error as e:
            return f"the part is no gzip stream: {e}"

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fault(n) for n in names], pa.string())], names=["path", "fault"])

    tasks = min(len(paths), 4 * spark.sparkContext.defaultParallelism)
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks)
    found = listed.mapInArrow(check, "path string, fault string").filter("fault IS NOT NULL")
    return {r["path"]: r["fault"] for r in found.collect()}  # at most the parts of a slice


def _qualified(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def load_layout(
    spark: SparkSession, parts: Sequence[Row], inbox: str, table_path: str, layout: str, load: int
) -> DataFrame:
    """Write the rows of ``parts`` of one layout to the run's folder; what became of each part.

    Good and rejected rows are written in one pass, apart by the partition ``_rejected``.
    """
    folder = f"{table_path}/_load={load}"
    faults: dict[str, str] = {}

    def scan(names: Sequence[str]) -> DataFrame:
        typed = csv_parts.read_parts(spark, [f"{inbox}/{n}" for n in names], layout)
        rejected = F.col("_error").isNotNull().alias("_rejected")
        typed.select("*", rejected).write.mode("append").partitionBy("_rejected").parquet(folder)
        return spark.read.schema(typed.schema).parquet(folder)

    names = [r["output_file"] for r in parts]
    written = None
    try:
        written = scan(names)
    except Exception:
        root = _qualified(spark, inbox)
        found = unreadable(spark, [f"{root}/{n}" for n in names])
        faults = {n: found[f"{root}/{n}"] for n in names if f"{root}/{n}" in found}
        if not faults:
            raise  # no part is to blame
        names = [n for n in names if n not in faults]
        if names:
            written = scan(names)
    bad = _outcomes(spark, None, [(n, e) for n, e in faults.items()])
    return bad if written is None else bad.unionByName(_outcomes(spark, written, [(n, None) for n in names]))


def _outcomes(spark: SparkSession, written: DataFrame | None, parts: Sequence[tuple[str, str | None]]) -> DataFrame:
    """One row for each of ``parts`` (name, error): rows loaded and rejected."""
    names = spark.createDataFrame(parts, "output_file string, load_error string")
    none = F.lit(0).cast("long")
    if written is None:
        return names.select("output_file", none.alias("rows_loaded"), none.alias("errors_seen"), "load_error")
    counts = csv_parts.load_counts(written).withColumnRenamed("_source_file", "_counted")
    misnumbered = F.when(~F.col("numbered"), "rows of the file are not numbered from 1")
    return names.join(counts, _label() == F.col("_counted"), "left").select(
        "output_file",
        F.coalesce("rows_loaded", none).alias("rows_loaded"),
        F.coalesce("errors_seen", none).alias("errors_seen"),
        misnumbered.alias("load_error"),
    )


def log_rows(
    attempts: DataFrame, outcomes: DataFrame, started: dt.datetime, first_log_id: int
) -> DataFrame:
    """Log rows of a run. A part of which no row could be loaded for errors counts as failed."""
    nothing_loaded = (F.col("rows_loaded") == 0) & (F.col("errors_seen") > 0)
    message = F.coalesce(
        F.col("load_error"), F.when(nothing_loaded, F.lit("every row was rejected"))
    )
    status = F.when(message.isNull(), "SUCCESS").otherwise("FAILED")
    raw = (
        F.when(message.isNotNull(), "LOAD_FAILED")
        .when(F.col("errors_seen") > 0, "PARTIALLY_LOADED")
        .otherwise("LOADED")
    )
    derived = {
        # The start in microseconds plus the part's place in the run: later runs have larger ids.
        "log_id": F.lit(first_log_id) + F.col("_position"),
        "gzip_size_mb": text.megabytes(F.coalesce("gzip_size_bytes", F.lit(0))),
        "triggered_by": F.lit(TRIGGERED_BY),
        "started_at_utc": F.lit(started),
        "ended_at_utc": time.now(),
        "status": status,
        "copy_status_raw": raw,
        "error_message": message,
        "created_at": time.now(),
    }
    joined = attempts.join(outcomes, "output_file", "left").withColumns(
        {
            "rows_loaded": F.coalesce("rows_loaded", F.lit(0)),
            "errors_seen": F.coalesce("errors_seen", F.lit(0)),
        }
    )
    return joined.select(
        *[derived.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in INGEST_LOG.fields]
    )


def ingest(
    spark: SparkSession,
    manifest: DataFrame,
    log: DataFrame,
    inbox: str,
    table_path,
    log_path: str,
    region: str = "all",
    max_attempts: int | None = None,
    reset_failed: bool = False,
    force: bool = False,
) -> IngestResult:
    """Load all pending parts of ``region`` found below ``inbox``.

    ``max_attempts`` leaves out parts that failed so often, unless ``reset_failed``; without it every
    pending part is tried. ``force`` loads parts again that were loaded before: their new rows take
    the place of the old ones once they are loaded.

    ``table_path(schema, table)`` names the folder of a staging table. Parts are scanned together
    per target table, in slices of which the driver holds the names; each slice is committed alone.
    """
    queue = audit.work_queue(manifest, log, region, max_attempts, reset_failed, force)
    queue = stage(queue, "work-queue")
    total = queue.count()
    skipped = audit.for_region(manifest, region).count() - total
    done = dict.fromkeys(("SUCCESS", "FAILED"), 0)
    pending = queue.orderBy("region", "sf_schema", "sf_table", "output_file").toLocalIterator()
    for target, rows in itertools.groupby(pending, lambda r: (r["sf_schema"] or "", r["sf_table"] or "")):
        while parts := list(itertools.islice(rows, SLICE)):
            for r in _load_slice(spark, parts, queue.schema, target, inbox, table_path, log_path):
                done[r["status"]] += r["count"]
    release(queue)
    return IngestResult(region, total, done["SUCCESS"], done["FAILED"], skipped)


def _load_slice(
    spark: SparkSession, parts: list[Row], schema: T.StructType, target: tuple[str, str], inbox: str, table_path, log_path: str
) -> list[Row]:
    """Load and commit ``parts`` of one table; how many succeeded and failed."""
    started = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    layout = LAYOUT_OF_TABLE.get(target[1])
    if layout is None:
        message = f"no column layout for table '{target[1]}'"
        outcomes = _outcomes(spark, None, [(r["output_file"], message) for r in parts])
    else:
        outcomes = load_layout(spark, parts, inbox, table_path(*target), layout, load_id(started))
    numbered = T.StructType([*schema.fields, T.StructField("_position", T.LongType())])
    attempts = spark.createDataFrame([(*r, n) for n, r in enumerate(parts)], numbered)
    rows = stage(log_rows(attempts, outcomes, started, load_id(started)), "log-rows")
    rows.coalesce(1).write.mode("append").parquet(log_path)  # one file: the commit
    counts = rows.groupBy("status").count().collect()
    release(rows)
    return counts


def uncommitted(spark: SparkSession, table_path: str, log: DataFrame) -> list[str]:
    """Folders of runs that the log does not know: what is left of runs that broke off, or is being written."""
    known = {r["_load"] for r in committed_loads(log).collect()}
    root = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [str(x.getPath().toString()) for x in store.listStatus(root)] if store.exists(root) else []
    loads = [p for p in found if p.rpartition("/")[2].startswith("_load=")]
    return [p for p in loads if int(p.rpartition("=")[2]) not in known]


def committed_loads(log: DataFrame) -> DataFrame:
    """(_load) of all runs in the log."""
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', started_at_utc)")
    return log.select(micros.alias("_load")).distinct()


def archive_loaded(spark: SparkSession, log: DataFrame, inbox: str, archive: str | None = None) -> int:
    """Move parts whose last attempt was a success from ``inbox`` to ``archive`` (None: delete them).

    It goes by the log, so it can be repeated after a crash: parts already moved are not there any more.
    """
    done = audit.latest_status(log).filter(F.col("status") == "SUCCESS").select("output_file")
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    store, moved = path(inbox).getFileSystem(conf), 0
    for (name,) in done.toLocalIterator():
        part = path(f"{inbox}/{name}")
        if not store.exists(part):
            continue
        if archive is None:
            moved += bool(store.delete(part, False))
            continue
        to = path(f"{archive}/{name}")
        store.mkdirs(to.getParent())
        moved += bool(store.rename(part, to))
    return moved
