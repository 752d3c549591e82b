"""Names: columns, monthly files and partition folders."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tidy_name(name: str) -> str:
    return re.sub(r"[^a-zA-Z0-9_]", "", name.strip().lower().replace(" ", "_"))


def tidy_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[tidy_name(name) for name in df.columns])


def first_column(df: DataFrame, names: list[str]) -> str:
    """The first of the names that is a column, by exact case."""
    found = existing_columns(df, names)
    if not found:
        raise KeyError(f"no column is named any of {names}")
    return found[0]


def existing_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Those of the names that are columns, by exact case (Spark itself would ignore case)."""
    return [name for name in names if name in df.columns]


def month_folder(year: Column, month: Column) -> Column:
    """``year=2025/month=03``, month padded."""
    return F.format_string("year=%d/month=%02d", year, month)


def month_file(prefix: str, year: Column, month: Column) -> Column:
    """``<prefix>_2025-03.parquet``, month padded."""
    return F.format_string(f"{prefix}_%d-%02d.parquet", year, month)


def year_range(spec: str) -> tuple[int, int]:
    """``"2021-2025"`` or ``"2025"`` as first and last year."""
    first, _, last = spec.partition("-")
    return int(first), int(last or first)
