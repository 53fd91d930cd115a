"""Table writers: append, replace, the date-clustered fact, bucketed tables."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pedalytics.session import release, stage
from pedalytics.sources.files import list_files

FILE_ROWS = 1_000_000  # rows that a task of a compaction sorts and writes


@dataclass(frozen=True)
class Written:
    """What a write did: rows written and the message that reports it."""

    table: str
    rows: int

    def __str__(self) -> str:
        return f"inserted {self.rows} rows into {self.table}"


def write(df: DataFrame, path: str, table: str, mode: str, partition_by: tuple[str, ...] = ()) -> Written:
    """Write and count in the same job."""
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode(mode).partitionBy(*partition_by).parquet(path)
    return Written(table, seen.get["rows"])


def append(df: DataFrame, path: str, table: str) -> Written:
    return write(df, path, table, "append")


def replace(df: DataFrame, path: str, table: str) -> Written:
    return write(df, path, table, "overwrite")


def clustered_by_start(fact: DataFrame) -> DataFrame:
    """Fact rows laid out by start month, sorted by start day inside each file.

    The rebalance lets adaptive execution split a month too large for one task and merge small ones,
    so neither a hot month nor many thin ones decide the file sizes.
    """
    month = {
        "start_year": F.floor(F.col("start_date_sk") / 10_000).cast("int"),
        "start_month": F.floor(F.col("start_date_sk") / 100 % 100).cast("int"),
    }
    return (
        fact.withColumns(month)
        .hint("rebalance", "start_year", "start_month")
        .sortWithinPartitions("start_year", "start_month", "start_date_sk")
    )


def write_fact(fact: DataFrame, path: str, table: str, full_reload: bool = False) -> Written:
    mode = "overwrite" if full_reload else "append"
    return write(clustered_by_start(fact), path, table, mode, ("start_year", "start_month"))


def crowded_months(spark: SparkSession, path: str, most_files: int) -> DataFrame:
    """(start_year, start_month, files) of the fact's months that lie in more than ``most_files`` files."""
    place = [F.regexp_extract("path", rf"/{c}=(\d+)/", 1).cast("int").alias(c) for c in ("start_year", "start_month")]
    files = list_files(spark, path, "*.parquet").select(*place)
    return files.groupBy("start_year", "start_month").agg(F.count(F.lit(1)).alias("files")).filter(F.col("files") > most_files)


def compact_fact(spark: SparkSession, path: str, most_files: int = 4) -> int:
    """Write the crowded months of a fact anew, clustered; other months are not read. How many there were.

    Appends leave a file or more a month each, and days overlap between them. The months are copied to a
    stored table first; then each month's folder is replaced, by tasks of a bounded number of rows. Run it while nothing else writes to the fact.
    """
    months = crowded_months(spark, path, most_files).collect()  # months of the calendar at most
    if not months:
        return 0
    inside = F.struct("start_year", "start_month").isin([F.struct(F.lit(r[0]), F.lit(r[1])) for r in months])
    years = F.col("start_year").isin(sorted({r[0] for r in months}))  # prunes folders on its own
    rows = stage(spark.read.parquet(path).filter(years & inside), "crowded-months")
    writer = dealt_by_day(rows, most_files, FILE_ROWS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("start_year", "start_month").parquet(path)
    release(rows)
    return len(months)


def dealt_by_day(rows: DataFrame, most_files: int, file_rows: int) -> DataFrame:
    """Rows of a stored table dealt to tasks by month and day, by exact counts; sorted by start day in each task.

    A task sorts what it writes, so it gets about ``file_rows`` rows: months in a row up to that many, or a piece of
    a larger month, of which there are at most ``most_files``; of a month above eight times ``file_rows`` a file there
    are more. Pieces are runs of days, and a day that goes beyond one is dealt over several.
    """
    month, day = ["start_year", "start_month"], "start_date_sk"
    counts = rows.groupBy(*month, day).agg(F.count(F.lit(1)).alias("n"))
    days = sorted(tuple(r) for r in counts.toLocalIterator())  # days of the calendar at most
    placed, task, filled = [], 0, 0
    for _, same in itertools.groupby(days, key=lambda r: r[:2]):
        same = list(same)
        total = sum(r[3] for r in same)
        pieces = max(min(-(-total // file_rows), most_files), -(-total // (8 * file_rows)))
        if filled and (pieces > 1 or filled + total > file_rows):
            task, filled = task + 1, 0
        before = 0
        for r in same:
            placed.append((*r[:3], task, pieces, before / total, r[3] / total))
            before += r[3]
        task, filled = (task + pieces, 0) if pieces > 1 else (task, filled + total)
    table = rows.sparkSession.createDataFrame(
        placed, f"{', '.join(f'{c} long' for c in [*month, day])}, _task long, _pieces long, _before double, _share double")
    piece = F.floor((F.col("_before") + F.col("_share") * F.rand(0)) * F.col("_pieces"))
    place = F.col("_task") + F.least(piece, F.col("_pieces") - 1)
    dealt = rows.join(F.broadcast(table), [*month, day], "left").withColumn("_place", place.cast("int"))
    return dealt.repartitionById(task + 1, "_place").select(*rows.columns).sortWithinPartitions(*month, day)


def append_bucketed(df: DataFrame, table: str, buckets: int, *keys: str) -> None:
    """Append to a catalog table bucketed by ``keys``: anti-joins on them then need no shuffle."""
    df.write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Store a query under a name in the catalog; every reader plans it anew."""
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS {query}")
