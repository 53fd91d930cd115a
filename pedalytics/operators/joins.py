"""Anti-join for idempotent loads and dimension lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pedalytics.schemas import LINEAGE
from pedalytics.session import stage

MOST_PIECES = 8_192  # bitmaps of 4 KB to broadcast: 32 MB


def unseen(source: DataFrame, target: DataFrame | None, keys: Sequence[str] = LINEAGE) -> DataFrame:
    """Rows of ``source`` whose keys are not in ``target``.

    Only keys are read from the target. Duplicates inside the batch all stay, and a row with a null
    key never matches, so it stays too. Keys are (file, row), which hash evenly even when one file
    holds a third of all rows. Over tables bucketed by the keys no side is shuffled.
    """
    if target is None:
        return source
    return source.join(target.select(*keys), list(keys), "left_anti").select(*source.columns)


def open_files(source: DataFrame, target: DataFrame, file: str, row: str) -> DataFrame:
    """(file, partly, pieces): files whose rows are not the same in both; ``partly`` if the target has some of them.

    A file's rows are compared by their number and the exclusive or of their hashes, which both sides
    combine before the shuffle: of a target of any size one small row a file moves. ``pieces`` is the most
    bitmaps that ``row_bitmaps`` makes of the file's rows in the target.
    """
    def digest(df: DataFrame, *extra: Column) -> DataFrame:
        return df.filter(F.col(file).isNotNull()).groupBy(file).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(row)).alias("rows"), F.count_if(F.col(row).isNull()).alias("nulls"), *extra)

    buckets = (F.max(_bucket(row)) - F.min(_bucket(row)) + 1).alias("buckets")
    there = digest(target, buckets).select(
        F.col(file).alias("_file"), F.col("n").alias("_n"), F.col("rows").alias("_rows"), F.least("n", "buckets").alias("pieces"))
    both = digest(source).join(there, F.col(file) == F.col("_file"), "left")
    same = (F.col("n") == F.col("_n")) & (F.col("rows") == F.col("_rows")) & (F.col("nulls") == 0)
    return both.filter(~F.coalesce(same, F.lit(False))).select(
        file, F.col("_n").isNotNull().alias("partly"), F.coalesce("pieces", F.lit(0)).alias("pieces"))


def _bucket(row: str) -> Column:
    return F.bitmap_bucket_number(F.col(row).cast("long"))


def row_bitmaps(df: DataFrame, file: str, row: str) -> DataFrame:
    """(_bit_file, _bit_bucket, _bits): the rows of each file as bitmaps of 4 KB for 32,768 row numbers."""
    at = F.bitmap_bit_position(F.col(row).cast("long"))
    keys = [F.col(file).alias("_bit_file"), _bucket(row).alias("_bit_bucket")]
    return df.filter(F.col(row).isNotNull()).groupBy(*keys).agg(F.bitmap_construct_agg(at).alias("_bits"))


def without_rows(df: DataFrame, bitmaps: DataFrame, file: str, row: str) -> DataFrame:
    """Rows of ``df`` that are not in ``bitmaps``, which are broadcast; null keys are in none."""
    at = F.bitmap_bit_position(F.col(row).cast("long"))
    met = (F.col(file) == F.col("_bit_file")) & (_bucket(row) == F.col("_bit_bucket"))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    seen = F.getbit(byte, (at % 8).cast("int")) == 1
    return df.join(F.broadcast(bitmaps), met, "left").filter(~F.coalesce(seen, F.lit(False))).select(*df.columns)


def unseen_by_file(source: DataFrame, target: DataFrame | None, file: str = LINEAGE[0], row: str = LINEAGE[1]) -> DataFrame:
    """As ``unseen`` on (file, row), for loads that touch few of the target's files.

    Files the target holds already are left out as a whole, the rows of new files need no join with
    the target at all, and only of files that are partly there the target's keys are read. Those make
    bitmaps of row numbers, a bit a row, so neither the rows of the source nor the target's keys are
    shuffled; above ``MOST_PIECES`` bitmaps (row numbers in one file are dense, so some 10**8 rows) they are.
    The source is read once more after the comparison. The list of files is a stored table, so the planner
    broadcasts it by its true size.
    """
    if target is None:
        return source
    files = stage(open_files(source, target, file, row), "open-files")
    pieces = files.filter("partly").agg(F.sum("pieces")).first()[0]
    partly, new = files.filter("partly").select(file), files.filter("NOT partly").select(file)
    if pieces is None:
        rows = source.join(new, file, "left_semi").select(*source.columns)
        return rows.unionByName(source.filter(F.col(file).isNull()))
    known = target.select(file, row).join(partly, file, "left_semi")
    if pieces <= MOST_PIECES:
        opened = files.select(F.col(file).alias("_open"))
        rows = source.join(opened, F.col(file) == F.col("_open"), "left").filter(F.col("_open").isNotNull() | F.col(file).isNull())
        return without_rows(rows.select(*source.columns), row_bitmaps(known, file, row), file, row)
    some = source.join(partly, file, "left_semi").select(*source.columns)
    rows = source.join(new, file, "left_semi").select(*source.columns)
    return rows.unionByName(unseen(some, known, (file, row))).unionByName(source.filter(F.col(file).isNull()))


def attach_key(
    df: DataFrame, dim: DataFrame, name: Column, dim_name: str, dim_key: str, out: str
) -> DataFrame:
    """Left lookup of a dimension key. One dimension may be attached in several roles.

    No hint: give a staged or stored dimension, and the planner broadcasts it by its real size and
    falls back to a skew-aware shuffle join beyond the broadcast threshold.
    """
    role = dim.select(F.col(dim_name).alias(f"_{out}_name"), F.col(dim_key).alias(out))
    return df.join(role, name == F.col(f"_{out}_name"), "left").drop(f"_{out}_name")
