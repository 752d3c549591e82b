"""Windows over results that are already aggregated to a bounded number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def z_score(df: DataFrame, value: str, by: list[str] | None = None) -> Column:
    """Distance of ``value`` from the mean of its group in sample standard deviations.

    Null where the deviation is 0 or there is one row. Without ``by`` the whole frame is the group
    and lands in one task: for frames of fixed size only, such as one row per hour of the day.
    """
    group = Window.partitionBy(*(by or []))
    deviation = F.nullif(F.stddev(value).over(group), F.lit(0.0))
    return (F.col(value) - F.avg(value).over(group)) / deviation


def rank_rows(df: DataFrame, value: str, tie: str, out: str) -> DataFrame:
    """Rank by descending value, ties by ``tie``. One task: for frames of fixed size only."""
    order = Window.orderBy(F.desc_nulls_last(value), F.asc_nulls_last(tie))
    return df.withColumn(out, F.row_number().over(order))


def rolling_mean(df: DataFrame, value: str, order: str, rows: int, out: str) -> DataFrame:
    """Mean of this row and those before it, ``rows`` in all. One task: fixed-size frames only."""
    frame = Window.orderBy(F.asc_nulls_last(order)).rowsBetween(1 - rows, Window.currentRow)
    return df.withColumn(out, F.avg(value).over(frame))
