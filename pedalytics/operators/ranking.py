"""Dense ranks, ordinals and latest rows without pulling all rows into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pedalytics.operators.prefix import ordinals


def with_dense_ranks(df: DataFrame, **ranks: str) -> DataFrame:
    """Dense ranks over count columns, largest first, with no partition keys: ``rank=count, ...``.

    A dense rank depends on the distinct counts only. Counts of N rows summed over groups take at
    most about sqrt(2 N) different values, so just those are ranked in one task and joined back:
    1.4 million of them for 10**12 rows. So the ranks are always broadcast: a join by shuffle would send all
    rows of one count, often most of them, to one task. ``df`` is read once per rank and once more; stage
    it first where it is not a stored table.
    """
    out = df
    for rank, count in ranks.items():
        order = W.orderBy(F.desc(count))
        table = df.select(count).distinct().select(count, F.dense_rank().over(order).alias(rank))
        out = out.join(F.broadcast(table), count)
    return out


def with_position(df: DataFrame, count: str, tie: str, out: str) -> DataFrame:
    """Row number by a count column, largest first, ties by ``tie``; rows of one count may be in many tasks."""
    return ordinals(df, [F.desc(count), F.asc(tie)], out)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """The row with the greatest ``order`` columns per key; combines map-side; the plan sorts by key."""
    newest = F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select("_row.*")


def latest_by_number(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """The row with the greatest ``order``, a long such as a log id, per key; nothing is sorted.

    The greatest number is found by a hash aggregate and joined back by hash, so ``df`` is read twice:
    stage it where it is not a stored table. Of rows that tie one is taken by a hash of its columns, which
    stands behind the number in one decimal. Rows equal in every column are one; a null number is the least.
    """
    tie = F.pmod(F.xxhash64(*df.columns), F.lit(10**18)).cast("decimal(18,0)")
    number = F.coalesce(F.col(order).cast("decimal(19,0)"), F.lit("-9999999999999999999").cast("decimal(19,0)"))
    place = number * F.lit(10**18).cast("decimal(19,0)") + tie
    placed = df.withColumn("_place", place.cast("decimal(38,0)"))
    newest = placed.groupBy(*keys).agg(F.max("_place").alias("_newest"))
    newest = newest.select(*[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)], "_newest")
    met = F.col("_place") == F.col("_newest")
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"_key_{i}"))
    found = placed.join(newest.hint("shuffle_hash"), met).select(*df.columns, "_place")
    return found.distinct().select(*df.columns)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
