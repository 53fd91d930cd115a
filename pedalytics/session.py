"""Session helpers: recommended settings, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings the jobs are designed for; all of them may be overridden by the caller.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes of bytecode; wide rows run faster unfused.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Exact percentiles over pre-counted values keep many small groups per task.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "100000",
}

_STAGED: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Folder for staged tables: the cluster's checkpoint folder; a local one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/") + "/pedalytics"
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="pedalytics-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Staging cuts the lineage at a point that survives the loss of executors, and gives the planner
    the true size of the table: a later join broadcasts it only when it is under
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles (with skew handling) when it is not.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STAGED.append(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def release(*frames: DataFrame) -> None:
    """Delete tables that ``stage`` returned, after their last reader; other frames are left alone."""
    for df in frames:
        path = getattr(df, "staged_at", None)
        if path in _STAGED:
            _STAGED.remove(path)
            delete(df.sparkSession, path)


def drop_staged(spark: SparkSession) -> None:
    """Delete the tables staged by this process; frames built on them can no longer be read."""
    while _STAGED:
        delete(spark, _STAGED.pop())


def one_file_per_task(spark: SparkSession) -> SparkSession:
    """A sibling session whose file scans give each file a task of its own.

    Needed where the position of a row inside its file matters. Only scans created from the
    returned session are affected; their frames join freely with frames of ``spark``.
    """
    sibling = unsorted_writes(spark)
    for key, value in (
        ("spark.sql.files.maxPartitionBytes", str(1 << 40)),
        ("spark.sql.files.openCostInBytes", str(1 << 40)),
        ("spark.sql.files.maxPartitionNum", str((1 << 31) - 1)),
    ):
        sibling.conf.set(key, value)
    return sibling


def unsorted_writes(spark: SparkSession) -> SparkSession:
    """A sibling session whose writes into folders keep a file open for each of a few folders.

    Rows then need no sort by folder. A task that meets more folders sorts the rest of its rows.
    """
    sibling = spark.newSession()
    for key, value in (
        ("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone")),
        ("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions")),
        ("spark.sql.codegen.hugeMethodLimit", RECOMMENDED["spark.sql.codegen.hugeMethodLimit"]),
        ("spark.sql.maxConcurrentOutputFileWriters", "8"),
    ):
        sibling.conf.set(key, value)
    return sibling


def short_shuffles(session: SparkSession) -> SparkSession:
    """``session``, whose shuffle files from now on go when the query that made them ends.

    Otherwise they stay until the driver collects garbage, so several large writes add up on the executors' disks.
    For a session of which each frame is run once: a second run would have to shuffle again.
    """
    session.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    return session
