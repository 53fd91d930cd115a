"""Exact medians that hold when one group has a large share of all rows.

``median`` and ``percentile`` keep every distinct value of a group in one task. Here rows are first
counted per (group, value), which combines map-side and spreads a hot group over its values. Where
the number of distinct values has a fixed bound, a percentile weighted by those counts is enough.
Where it has none (coordinates), the search is narrowed: by brackets of a quantile sketch that comes
with another aggregate of the same scan (``median_in_brackets``), or by counting buckets
(``median_of_doubles``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from pedalytics.operators.prefix import running_total
from pedalytics.session import release, stage

BUCKETS = 1 << 16
SKETCH_K = 400  # ranks of a sketch are off by about 0.7 % of the rows (99 % of the time)
MARGIN = 0.02
COUNT = "_n"


def histogram(df: DataFrame, keys: Sequence[str], value: str, *extra: Column) -> DataFrame:
    """Rows per (keys, value): the skew-free first step of every exact quantile."""
    return df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias(COUNT), *extra)


def weighted_median(value: str, count: str = COUNT) -> Column:
    """Interpolated median over counted values; for groups of bounded distinct values."""
    return F.expr(f"percentile({value}, 0.5, {count})")


def _bucket(value: str, low: Column, width: Column) -> Column:
    """Number of the bucket a value lies in; values folded to one side come before or after all."""
    v = F.col(value)
    return (
        F.when(v == float("-inf"), F.lit(-1))
        .when(F.isnan(v) | (v == float("inf")), F.lit(1 << 62))
        .otherwise(F.floor((v - low) / width))
    )


def middle_buckets(df: DataFrame, keys: Sequence[str], bucket: Column) -> DataFrame:
    """First and last bucket holding one of the two middle ranks, one row per group; staged.

    Only bucket counts are shuffled, and they combine map-side.
    """
    per_group = W.partitionBy(*keys)
    up_to = per_group.orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    lower_rank = F.floor((F.col("_total") - 1) / 2)
    upper_rank = F.floor(F.col("_total") / 2)
    middle = (
        df.groupBy(*keys, bucket.alias("_bucket"))
        .agg(F.count(F.lit(1)).alias("_m"))
        .withColumn("_total", F.sum("_m").over(per_group))
        .withColumn("_cum", F.sum("_m").over(up_to))
        .filter((F.col("_cum") > lower_rank) & (F.col("_cum") - F.col("_m") <= upper_rank))
        .groupBy(*keys)
        .agg(F.min("_bucket").alias("_first"), F.max("_bucket").alias("_last"))
    )
    return stage(middle, "middle-buckets")


def fold_outside(
    df: DataFrame, keys: Sequence[str], value: str, bucket: Column, middle: DataFrame
) -> DataFrame:
    """Values below or above the middle buckets become minus or plus infinity.

    Each keeps its place in the order, so ranks and the median do not change, but all of them count
    as one value on either side. ``middle`` is stored, so the planner knows its size: it broadcasts it
    or joins by shuffle, where a hot group is split.
    """
    joined = df.join(middle, list(keys))
    folded = (
        F.when(bucket < F.col("_first"), float("-inf"))
        .when(bucket > F.col("_last"), float("inf"))
        .otherwise(F.col(value))
    )
    return joined.select(*keys, folded.alias(value))


def median_of_doubles(
    df: DataFrame, keys: Sequence[str], value: str, low: Column, high: Column, out: str
) -> DataFrame:
    """Exact interpolated median of doubles in ``[low, high]``, one row per group of non-null keys.

    Null values are left out, as other aggregates do; NaN is greater than every number.

    ``low`` and ``high`` are literals or functions of the keys. The first pass counts ``BUCKETS``
    coarse buckets per group, the second as many fine ones inside the middle, the third the values
    of the fine middle: an interval ``(high - low) / 2**32`` wide, in which only a bounded number of
    different doubles exist (some 10**5 for coordinates). The rows are read in each pass, and what
    is shuffled are counts, never the rows.
    """
    df = df.filter(F.col(value).isNotNull())
    coarse = (high - low) / F.lit(float(BUCKETS))
    fine = coarse / F.lit(float(BUCKETS))
    in_coarse, in_fine = _bucket(value, low, coarse), _bucket(value, low, fine)
    around = fold_outside(df, keys, value, in_coarse, middle_buckets(df, keys, in_coarse))
    closer = fold_outside(df, keys, value, in_fine, middle_buckets(around, keys, in_fine))
    hist = histogram(closer, keys, value)
    return hist.groupBy(*keys).agg(weighted_median(value).alias(out))


def sketch(value: str) -> Column:
    """Aggregate: a mergeable quantile sketch of a few KB; nulls and NaN are left out."""
    return F.kll_sketch_agg_double(value, SKETCH_K)


def bracket(sketched: str) -> Column:
    """(lo, hi) around the median by a sketch; null where it has seen no value."""

    def at(rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(sketched, F.lit(rank))

    both = F.struct(at(0.5 - MARGIN).alias("lo"), at(0.5 + MARGIN).alias("hi"))
    return F.when(F.kll_sketch_get_n_double(sketched) > 0, both)


def counts_in_brackets(df: DataFrame, keys: Sequence[str], value: str, brackets: DataFrame) -> DataFrame:
    """Rows per (keys, value), all values below or above the bracket of their group counted as one.

    ``brackets`` (keys, lo, hi) is stored, so it is joined as its size allows. What is shuffled are the
    counts of some ``2 * MARGIN`` of the values.
    """
    joined = df.filter(F.col(value).isNotNull()).join(brackets, list(keys))
    folded = (
        F.when(F.col(value) < F.col("lo"), float("-inf"))
        .when(F.col(value) > F.col("hi"), float("inf"))
        .otherwise(F.col(value))
    )
    return histogram(joined.select(*keys, folded.alias(value)), keys, value)


def median_of_counts(counts: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Interpolated median of counted values by running totals: no group is one task; staged."""
    before = running_total(counts, keys, [F.asc(value)], F.col(COUNT), "_before")
    total = counts.groupBy(*keys).agg(F.sum(COUNT).alias("_total"))
    lower, upper = F.floor((F.col("_total") - 1) / 2), F.floor(F.col("_total") / 2)
    middle = (
        before.join(total, list(keys))
        .filter((F.col("_before") <= upper) & (F.col("_before") + F.col(COUNT) > lower))
        .groupBy(*keys)
        .agg(((F.min(value) + F.max(value)) / 2).alias(out))
    )
    return stage(middle, "medians")


def median_in_brackets(
    df: DataFrame, keys: Sequence[str], value: str, brackets: DataFrame, out: str
) -> DataFrame:
    """Exact interpolated median of doubles, one row per group of non-null keys, by one scan of ``df``.

    A sketch may miss: where the middle ranks are not inside the bracket, the median comes out as
    infinite, and those groups are counted once more with all of their values. So the result is exact
    whatever ``brackets`` holds; infinite medians that are true come out of the second count, too.
    Null values are left out; NaN is greater than every number.
    """
    counts = stage(counts_in_brackets(df, keys, value, brackets), "bracket-counts")
    medians = median_of_counts(counts, keys, value, out)
    release(counts)
    missed = medians.filter(F.abs(out) == float("inf")).select(*keys)
    # Opposite infinities add up to NaN: the bracket lies between the two middle ranks.
    missed = missed.unionByName(medians.filter(F.isnan(out)).select(*keys))
    if missed.isEmpty():
        return medians
    again = df.filter(F.col(value).isNotNull()).join(missed, list(keys), "left_semi")
    counts = stage(histogram(again, keys, value), "missed-counts")
    return medians.join(missed, list(keys), "left_anti").unionByName(
        median_of_counts(counts, keys, value, out)
    )
