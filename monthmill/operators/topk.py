"""Sorts and top-k with explicit null order and a tie key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: str | Column, k: int, *ties: str) -> DataFrame:
    """The k rows with the largest ``by``; equal ones in ascending order of ``ties``.

    Sort and limit plan as one top-k per partition and a merge of k rows each.
    """
    value = F.col(by) if isinstance(by, str) else by
    return df.orderBy(value.desc_nulls_last(), *[F.asc_nulls_last(t) for t in ties]).limit(k)


def sort_up(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.asc_nulls_last(name) for name in columns])
