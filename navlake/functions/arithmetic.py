"""Return and share arithmetic."""

from pyspark.sql import Column, functions as F


def point_to_point_return(start: Column, end: Column) -> Column:
    """Percent change rounded half-even to 4 places; null when the start is 0."""
    change = F.try_divide(end - start, start) * F.lit(100.0)
    return F.bround(change, 4)


def mean_of_rounded(value: Column) -> Column:
    """Mean of values that carry 4 decimals.

    The sum is taken in decimals, so the order in which partitions arrive does not
    change the last digit.
    """
    total = F.sum(value.cast("decimal(28,4)")).cast("double")
    return F.bround(F.try_divide(total, F.count(value)), 4)


def mean_price(value: Column) -> Column:
    """Mean of prices rounded to 4 places; summed in decimals, as ``mean_of_rounded``."""
    total = F.sum(value.cast("decimal(28,8)")).cast("double")
    return F.round(F.try_divide(total, F.count(value)), 4)


def percent(part: Column, whole: Column) -> Column:
    return F.bround(F.coalesce(F.try_divide(part, whole) * F.lit(100.0), F.lit(0.0)), 1)
