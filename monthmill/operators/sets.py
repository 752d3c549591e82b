"""Unions and de-duplication."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def first_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first by ``order`` (ascending, nulls first), null keys included.

    An aggregate, not a ranked window: rows of a key are reduced before the shuffle, so a key that
    holds a large part of the table costs no more than any other. Give an order that ends in a
    unique column or names every column, as ties are otherwise broken by the remaining columns.
    """
    rest = [name for name in df.columns if name not in keys and name not in order]
    row = F.struct(*order, *rest)
    return (
        df.groupBy(*keys)
        .agg(F.min(row).alias("first"))
        .select(*[name if name in keys else F.col(f"first.{name}").alias(name) for name in df.columns])
    )


def first_per_key_by_place(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The rows of `first_per_key`, of a frame that reads files, without sorting whole rows.

    Only keys, order columns and each row's place (file and row number, which Parquet scans know) are reduced, within tasks first; rows that
    tie go by their place. The winners' places are one row per key; whole rows meet them once, in a join that hashes the places, or
    broadcasts them where Spark finds them small.
    """
    keys, order = list(keys), list(order)
    place = [F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")]
    narrow = df.select(*dict.fromkeys([*keys, *order]), *place)
    first = F.min(F.struct(*order, "__file", "__row")).alias("__first")
    winners = narrow.groupBy(*keys).agg(first).select("__first.__file", "__first.__row")
    return df.select(*df.columns, *place).join(winners.hint("shuffle_hash"), ["__file", "__row"], "left_semi").select(*df.columns)
