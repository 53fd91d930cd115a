"""Column expressions for ride measures and report labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound (exclusive) and label of each age band; older riders are '65+'.
AGE_BANDS = ((18, "<18"), (25, "18-24"), (35, "25-34"), (45, "35-44"), (55, "45-54"), (65, "55-64"))
OLDEST_BAND = "65+"
PLAUSIBLE_BIRTH_YEARS = (1900, 2010)


def age_at(started_at: Column, birth_year: Column) -> Column:
    return F.when(birth_year.between(*PLAUSIBLE_BIRTH_YEARS), F.year(started_at) - birth_year)


def age_band(started_at: Column, birth_year: Column) -> Column:
    """Age band; unlike the age itself it is given for every non-null birth year."""
    age = F.year(started_at) - birth_year
    band = F.when(birth_year.isNull(), F.lit(None).cast("string"))
    for limit, label in AGE_BANDS:
        band = band.when(age < limit, label)
    return band.otherwise(OLDEST_BAND)


def minutes(seconds: Column) -> Column:
    return F.round(seconds / F.lit(60.0).cast("decimal(3,1)"), 2).cast("decimal(10,2)")


def mean(total: Column, n: Column) -> Column:
    """Exact mean of a decimal total, rounded half up to two places; null for no rows."""
    quotient = total.cast("decimal(20,2)") / F.nullif(n.cast("decimal(18,0)"), F.lit(0))
    return F.round(quotient, 2).cast("decimal(18,2)")


def rounded_median(value: Column) -> Column:
    """A double median of two-place decimals, back in decimals before it is rounded."""
    return F.round(value.cast("decimal(18,4)"), 2).cast("decimal(18,2)")


def growth_pct(current: Column, previous: Column) -> Column:
    """Growth over the previous figure in percent; null when that is missing or zero."""
    change = (current - previous).cast("decimal(18,0)") * F.lit(100).cast("decimal(3,0)")
    return F.round(change / F.nullif(previous, F.lit(0)).cast("decimal(15,0)"), 2).cast("decimal(18,2)")


def availability(in_legacy: Column, in_modern: Column) -> Column:
    return (
        F.when(in_legacy & in_modern, "BOTH").when(in_legacy, "LEGACY_ONLY").otherwise("MODERN_ONLY")
    )


def flow_label(net_flow: Column) -> Column:
    return (
        F.when(net_flow > 0, "NET EXPORTER").when(net_flow < 0, "NET IMPORTER").otherwise("BALANCED")
    )
