"""Checks between tables: coverage of months, and whether the rollup adds up to the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.sources.lookups import inline_relation


def month_grid(
    spark: SparkSession, years: tuple[int, int], months: tuple[int, int] = (1, 12)
) -> DataFrame:
    """year, month for every month of the range."""
    span = lambda ends: F.sequence(F.lit(ends[0]), F.lit(ends[1]))
    if years[0] > years[1]:
        return inline_relation(spark, [], "year int, month int")
    year = spark.range(0, 1, 1, 1).select(F.explode(span(years)).alias("year"))
    return year.select("year", F.explode(span(months)).alias("month"))


def month_status(grid: DataFrame, published: DataFrame, present: DataFrame) -> DataFrame:
    """year, month, status: skipped (already there), uploaded (to be landed) or unpublished."""
    keys = ["year", "month"]
    there = present.select(*keys).distinct().withColumn("__there", F.lit(True))
    out = published.select(*keys).distinct().withColumn("__out", F.lit(True))
    status = (
        F.when(F.col("__there"), "skipped").when(F.col("__out"), "uploaded").otherwise("unpublished")
    )
    joined = grid.join(there, keys, "left").join(out, keys, "left")
    return joined.select(*keys, status.alias("status"))


def months_outside(grid: DataFrame, published: DataFrame, present: DataFrame) -> DataFrame:
    """year, month, status ``out_of_range``: months published or present that the grid does not ask for."""
    keys = ["year", "month"]
    known = published.select(*keys).unionByName(present.select(*keys)).distinct()
    return known.join(grid.select(*keys), keys, "left_anti").withColumn("status", F.lit("out_of_range"))


def reconcile(fact: DataFrame, rollup: DataFrame) -> DataFrame:
    """year, fact_trips, rollup_trips, difference; the row with null year is the whole table.

    Both sides are counted per year first, so what is compared has one row per year.
    """
    ours = fact.groupBy("year").agg(F.count("*").alias("fact_trips"))
    theirs = rollup.groupBy("year").agg(F.sum("trips").alias("rollup_trips"))
    sides = ours.withColumn("rollup_trips", F.lit(0).cast("long")).unionByName(
        theirs.withColumn("fact_trips", F.lit(0).cast("long"))
    )
    return (
        sides.rollup("year")
        .agg(F.sum("fact_trips").alias("fact_trips"), F.sum("rollup_trips").alias("rollup_trips"))
        .withColumn("difference", F.col("fact_trips") - F.col("rollup_trips"))
    )
