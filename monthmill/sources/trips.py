"""Scans of the partitioned trip files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.schemas import NARROW_DDL, Era
from monthmill.sources.eras import FoundEra
from monthmill.sources.files import month_list, months_of, partition_files


def narrow_trips(
    spark: SparkSession,
    base: str,
    years: tuple[int, int] | None = None,
    months: tuple[int, int] | None = None,
) -> DataFrame:
    """Columns of one type in every month: the cheapest scan, and one that drift cannot break.

    All months that are there, or those within the given ranges; the filters act on partitions.
    """
    trips = spark.read.schema(NARROW_DDL).parquet(base)
    for name, ends in (("year", years), ("month", months)):
        if ends is not None:
            trips = trips.filter(F.col(name).between(*ends))
    return trips


def one_file(spark: SparkSession, path: str) -> DataFrame:
    """A single month at full width, with its own types."""
    return spark.read.parquet(path)


def era_trips(
    spark: SparkSession, base: str, era: Era | FoundEra, present: list[tuple[int, int]] | None = None
) -> DataFrame:
    """The months of one era that are there, with that era's type for the drift columns.

    ``present`` saves a listing per era when several are read.
    """
    if present is None:
        present = month_list(months_of(partition_files(spark, base)))
    folders = [
        f"{base.rstrip('/')}/year={year}/month={month:02d}"
        for year, month in present
        if era.covers(year, month)
    ]
    if not folders:
        return spark.createDataFrame([], era.ddl).limit(0)
    return spark.read.schema(era.ddl).option("basePath", base).parquet(*folders)
