"""Equality joins of facts with lookups.

No broadcast hints: dimensions of the star are small enough for Spark's own size check to broadcast
them, and when one is not, the join falls back to a shuffle whose hot keys adaptive execution
splits. A hint would take that second way out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_lookup(
    left: DataFrame, lookup: DataFrame, key: str, lookup_key: str, how: str = "left"
) -> DataFrame:
    """Joins and drops the lookup's key, which repeats the left one or is null.

    ``left`` keeps unmatched rows with nulls, ``inner`` drops them.
    """
    to = lookup.withColumnRenamed(lookup_key, "__lookup_key")
    return left.join(to, left[key] == to["__lookup_key"], how).drop("__lookup_key")


def known_key(lookup: DataFrame, key: str, flag: str) -> DataFrame:
    """The lookup's distinct keys with a true flag, for a left join that tests membership."""
    return (
        lookup.filter(F.col(key).isNotNull())
        .select(F.col(key).alias(f"{flag}_key"))
        .distinct()
        .withColumn(flag, F.lit(True))
    )


def with_membership(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str, flag: str):
    """Adds a boolean: is the key in the lookup? A null key is not."""
    known = known_key(lookup, lookup_key, flag)
    return (
        df.join(known, df[key] == known[f"{flag}_key"], "left")
        .drop(f"{flag}_key")
        .withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    )


def with_both_unknown(
    df: DataFrame, lookup: DataFrame, lookup_key: str, first: str, second: str, out: str
) -> DataFrame:
    """Adds a boolean: are both keys absent from the lookup?"""
    df = with_membership(df, first, lookup, lookup_key, "__first_known")
    df = with_membership(df, second, lookup, lookup_key, "__second_known")
    both: Column = ~F.col("__first_known") & ~F.col("__second_known")
    return df.withColumn(out, both).drop("__first_known", "__second_known")


def count_both_unknown(
    df: DataFrame, lookup: DataFrame, lookup_key: str, first: str, second: str
) -> DataFrame:
    """both_unknown, trips. Trips are counted per pair of keys before they meet the lookup."""
    pairs = df.groupBy(first, second).agg(F.count("*").alias("n"))
    flagged = with_both_unknown(pairs, lookup, lookup_key, first, second, "both_unknown")
    return flagged.groupBy("both_unknown").agg(F.sum("n").alias("trips"))


def absent_from(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    return left.join(right, keys, "left_anti")
