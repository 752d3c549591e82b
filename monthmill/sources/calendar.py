"""Generated calendars: one row per day of a range that is given, or taken from the data."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.fixed_values import TRIP_YEARS
from monthmill.functions.dates import date_key, date_key_from_text, is_weekend, iso_day_of_week


def _days(bounds: DataFrame) -> DataFrame:
    """full_date for each day from lo to hi of a one-row frame."""
    span = F.sequence("lo", "hi", F.expr("interval 1 day"))
    return bounds.filter(F.col("lo").isNotNull()).select(F.explode(span).alias("full_date"))


def date_bounds(*columns: DataFrame) -> DataFrame:
    """One row lo, hi over one-column frames; one pass over each, nothing comes to the driver."""
    ends = None
    for column in columns:
        name = F.to_date(F.col(column.columns[0]))
        part = column.agg(F.min(name).alias("lo"), F.max(name).alias("hi"))
        ends = part if ends is None else ends.unionByName(part)
    return ends.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def fixed_days(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    return _days(spark.range(0, 1, 1, 1).select(F.lit(first).alias("lo"), F.lit(last).alias("hi")))


def lakehouse_calendar(
    spark: SparkSession,
    first: dt.date | None = None,
    last: dt.date | None = None,
    covering: DataFrame | None = None,
) -> DataFrame:
    """Seven columns, fixed range; by default all days of the declared trip years.

    With ``covering``, a fact or rollup with a ``year`` of its files, also all days of its years, so
    that no join with the calendar drops a month that has landed after the declared ones.
    """
    first = first or dt.date(TRIP_YEARS[0], 1, 1)
    last = last or dt.date(TRIP_YEARS[1], 12, 31)
    day = F.col("full_date")
    days = fixed_days(spark, first, last)
    if covering is not None:
        year = covering.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
        bounds = year.select(
            F.least(F.lit(first), F.make_date("lo", F.lit(1), F.lit(1))).alias("lo"),
            F.greatest(F.lit(last), F.make_date("hi", F.lit(12), F.lit(31))).alias("hi"),
        )
        days = _days(bounds)
    return days.select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day_of_week(day).alias("dow"),
        is_weekend(day).alias("is_weekend"),
    )


def wide_calendar(*columns: DataFrame) -> DataFrame:
    """Eleven columns, every day from the first to the last date found in the given columns."""
    day = F.col("full_date")
    return _days(date_bounds(*columns)).select(
        date_key_from_text(day).alias("date_key"),
        day,
        F.dayofmonth(day).alias("day"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.quarter(day).alias("quarter"),
        F.year(day).alias("year"),
        iso_day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        F.weekofyear(day).alias("week_of_year"),
    )
