"""Aggregate expressions: conditional counts and sums, rounded sums, ratios of sums.

Sums of doubles depend on the order in which partitions arrive. Where a sum is divided and then
rounded to few places, it is first rounded to ``SUM_PLACES``, so that order cannot flip a tie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUM_PLACES = 6


def trip_count(fact: DataFrame) -> Column:
    """Counts the surrogate id where the fact has one, else rows."""
    return F.count("trip_id") if "trip_id" in fact.columns else F.count(F.lit(1))


def count_where(test: Column) -> Column:
    return F.count_if(test)


def trip_count_where(fact: DataFrame, test: Column) -> Column:
    if "trip_id" in fact.columns:
        return F.count(F.when(test, F.col("trip_id")))
    return F.count_if(test)


def sum_where(test: Column, value: str) -> Column:
    """Null, not 0, when no row passes the test."""
    return F.sum(F.when(test, F.col(value)))


def total_where(test: Column, count: str) -> Column:
    """Sum of counts; 0 when no row passes the test."""
    return F.coalesce(sum_where(test, count), F.lit(0).cast("long"))


def rounded_sum(value: str, places: int = 2) -> Column:
    return F.round(F.sum(value), places)


def ratio(numerator: Column, denominator: Column, places: int | None = None) -> Column:
    """Quotient of two aggregates, null when the denominator is 0."""
    quotient = numerator.cast("double") / F.nullif(denominator, F.lit(0))
    return quotient if places is None else F.round(quotient, places)


def ratio_of_sums(numerator: str, denominator: Column, places: int | None = None) -> Column:
    return ratio(F.round(F.sum(numerator), SUM_PLACES), denominator, places)


def mean(value: str, places: int | None = None) -> Column:
    """Average as the sum over the count of non-null values."""
    return ratio_of_sums(value, F.count(value), places)


def percent(part: Column, whole: Column, places: int | None = 2) -> Column:
    """Percentage in doubles throughout."""
    share = F.lit(100.0) * part.cast("double") / F.nullif(whole, F.lit(0))
    return share if places is None else F.round(share, places)


def tipped_positive() -> Column:
    return F.col("tip_amount") > 0


def tipped_nonzero() -> Column:
    """The other definition in use; differs from the first on negative tips."""
    return F.col("tip_amount") != 0


def whole_number(value: Column) -> Column:
    """Double to bigint, to the nearest; a bare cast would cut. NaN becomes null."""
    return F.round(F.nullif(value, F.lit(float("nan")))).cast("long")
