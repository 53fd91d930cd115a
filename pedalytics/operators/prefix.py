"""Running totals and ordinals over ordered rows, without one task for a group or a tie.

Rows are ranged over partitions by their order, so a group or a tie of any size is cut where the ranges
are. Each range adds up its own rows; what comes before a range is summed over one row for each range and
group, as many as there are tasks. The ranged rows are a stored table, as the ranges must not move.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pedalytics.session import stage


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str, tasks: int | None = None
) -> DataFrame:
    """``df`` with the total of ``value`` over the rows of its group that come before, 0 for the first.

    ``order`` should leave no ties: of rows that tie either may come first. Null values count as 0.
    """
    by = [*[F.col(k) for k in keys], *order]
    ranged = df.repartitionByRange(tasks, *by) if tasks else df.repartitionByRange(*by)
    worth = F.coalesce(value, F.lit(0))
    ranged = stage(ranged.withColumns({"_range": F.spark_partition_id(), "_value": worth}), "ranges")
    sums = ranged.groupBy("_range", *keys).agg(F.sum("_value").alias("_sum"))
    earlier = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(
        F.col("_range").alias("_of"), *[F.col(k).alias(f"_of_{i}") for i, k in enumerate(keys)],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    met = F.col("_range") == F.col("_of")
    for i, k in enumerate(keys):
        met = met & F.col(k).eqNullSafe(F.col(f"_of_{i}"))
    inside = W.partitionBy("_range", *keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    total = F.col("_offset") + F.coalesce(F.sum("_value").over(inside), F.lit(0))
    return ranged.join(offsets, met).withColumn(out, total).select(*df.columns, out)


def ordinals(df: DataFrame, order: Sequence[Column], out: str, tasks: int | None = None) -> DataFrame:
    """``df`` with row numbers from 1 over all of its rows."""
    numbered = running_total(df, [], order, F.lit(1), out, tasks)
    return numbered.withColumn(out, F.col(out) + 1)
