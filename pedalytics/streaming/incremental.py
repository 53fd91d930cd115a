"""Incremental ingest as a file stream: new parts in a folder become trips exactly once."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pedalytics.functions import text, time
from pedalytics.operators.joins import unseen_by_file
from pedalytics.operators.unify import to_unified
from pedalytics.schemas import LAYOUT_SCHEMA, TRIPS_ALL
from pedalytics.session import one_file_per_task, release, stage
from pedalytics.sources import csv_parts


def stream_parts(spark: SparkSession, folder: str, layout: str, archive: str | None = None) -> DataFrame:
    """Parts arriving in ``folder`` as a stream of text rows with their path.

    With ``archive``, parts are moved there once they are loaded.
    """
    names = LAYOUT_SCHEMA[layout].fieldNames()
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = (
        one_file_per_task(spark)
        .readStream.schema(schema)
        .options(header=True, enforceSchema=True, multiLine=True, quote='"', escape='"')
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.csv*")
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.csv(folder).select("*", F.col("_metadata.file_path").alias("_path"))


def load_batch(
    layout: str, target: str, rejected: str, log: str, stream: str = "0"
) -> Callable[[DataFrame, int], None]:
    """Batch function: number, type and unify the rows, then append those the target lacks.

    The files of a batch are parsed once, to a stored table that is gone when the batch is done. Rows
    with fields that do not read go to ``rejected``, with the names of these fields in ``_error``. A batch
    that is repeated after a failure, or a whole stream restarted without its checkpoint, adds nothing
    twice: the anti-join on lineage decides, not the stream's own progress. Last, one row a file goes to
    ``log``, in a folder named by stream and batch, so a repeat replaces it.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        position = F.monotonically_increasing_id().bitwiseAND((1 << csv_parts.ROW_BITS) - 1) + 1
        raw = batch.select(
            *[text.null_if_token(F.col(n)).alias(n) for n in LAYOUT_SCHEMA[layout].fieldNames()],
            csv_parts.source_label(F.col("_path")).alias("_source_file"),
            position.alias("_source_row_number"),
        )
        typed = stage(csv_parts.typed_parts(raw, layout), "stream-batch")
        bad = typed.filter(F.col("_error").isNotNull())
        known = spark.read.schema(typed.schema).option("ignoreMissingFiles", True).parquet(rejected)
        unseen_by_file(bad, known).write.mode("append").parquet(rejected)
        trips = to_unified(csv_parts.good_rows(typed), layout)
        existing = spark.read.schema(TRIPS_ALL).option("ignoreMissingFiles", True).parquet(target)
        unseen_by_file(trips, existing).write.mode("append").parquet(target)
        nothing = (F.col("rows_loaded") == 0) & (F.col("errors_seen") > 0)
        files = csv_parts.load_counts(typed).select(
            "_source_file", F.when(nothing, "FAILED").otherwise("SUCCESS").alias("status"), "rows_loaded", "errors_seen",
            time.now().alias("ended_at_utc"))
        files.coalesce(1).write.mode("overwrite").parquet(f"{log}/_stream={stream}/_batch={batch_id}")
        release(typed)

    return load


def start_incremental_load(
    spark: SparkSession,
    folder: str,
    layout: str,
    target: str,
    checkpoint: str,
    archive: str | None = None,
    rejected: str | None = None,
    log: str | None = None,
) -> StreamingQuery:
    """Load whatever is new in ``folder`` into ``target`` and stop; run it again for the next files.

    Rejected rows are kept in ``rejected``, by default the folder ``<target>_rejected``, and one row a
    file and batch in ``log``, by default ``<target>_log``.
    """
    rejected = rejected or f"{target.rstrip('/')}_rejected"
    log = log or f"{target.rstrip('/')}_log"
    none = csv_parts.typed_parts(spark.createDataFrame([], csv_parts.raw_schema(layout)), layout)
    none.write.mode("append").parquet(rejected)
    spark.createDataFrame([], TRIPS_ALL).write.mode("append").parquet(target)
    stream = hashlib.md5(checkpoint.encode()).hexdigest()[:16]
    return (
        stream_parts(spark, folder, layout, archive)
        .writeStream.foreachBatch(load_batch(layout, target, rejected, log, stream))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
