"""Date and time expressions. None depends on the session time zone for ``timestamp_ntz`` input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def date_key(when: Column) -> Column:
    """20250131 for 31 January 2025."""
    return (F.year(when) * 10000 + F.month(when) * 100 + F.dayofmonth(when)).cast("int")


def date_key_from_text(when: Column) -> Column:
    """The same key by way of its text form."""
    return F.date_format(when, "yyyyMMdd").cast("int")


def iso_day_of_week(when: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(when) + 1).cast("int")


def is_weekend(when: Column) -> Column:
    return F.weekday(when) >= 5


def seconds_of_day(when: Column) -> Column:
    return (F.hour(when) * 3600 + F.minute(when) * 60 + F.second(when).cast("int")).cast("int")


def hour_of_day(df: DataFrame, name: str) -> Column:
    """Hour 0-23 of a timestamp, or of whole seconds since midnight."""
    if isinstance(df.schema[name].dataType, (T.IntegerType, T.LongType)):
        return F.floor(F.col(name) / 3600).cast("int")
    return F.hour(name)


def hour_bucket(day: Column, hour: Column) -> Column:
    """Start of an hour as ``timestamp_ntz`` (``date_trunc`` would give a zoned timestamp)."""
    return F.make_timestamp_ntz(
        F.year(day), F.month(day), F.dayofmonth(day), hour, F.lit(0), F.lit(0)
    )


def first_of_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(1))
