"""The fact in its two shapes: the view over all months, and the 22-column fact of a cleaned month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.fixed_values import WIDE_COLUMNS
from monthmill.functions.dates import date_key, date_key_from_text
from monthmill.functions.measures import whole_number
from monthmill.functions.names import first_column
from monthmill.operators.sets import union_all
from monthmill.schemas import TRIP_ERAS, Era
from monthmill.sources.eras import FoundEra
from monthmill.sources.files import month_list, months_of, partition_files
from monthmill.sources.trips import era_trips, narrow_trips

def fact_shape(trips: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """Raw trip columns renamed into the fact; drift columns become bigint where they are present. Columns named in ``also`` follow.

    The partition columns pass straight through, so a filter on year or month still prunes files.
    """
    drift = {"rate_code_id": "ratecodeid", "passenger_count": "passenger_count"}
    kinds = dict(trips.dtypes)
    codes = [
        (whole_number(F.col(raw)) if kinds[raw] == "double" else F.col(raw).cast("long")).alias(name)
        for name, raw in drift.items()
        if raw in kinds
    ]
    return trips.select(
        F.col("tpep_pickup_datetime").alias("pickup_time"),
        F.col("tpep_dropoff_datetime").alias("dropoff_time"),
        date_key(F.col("tpep_pickup_datetime")).alias("pickup_date_key"),
        F.col("pulocationid").alias("pickup_location_id"),
        F.col("dolocationid").alias("dropoff_location_id"),
        "payment_type",
        *codes,
        "trip_distance",
        "fare_amount",
        "tip_amount",
        "total_amount",
        "year",
        "month",
        *also,
    )


def fact_trips(spark: SparkSession, base: str, eras: list[Era] | list[FoundEra] = TRIP_ERAS) -> DataFrame:
    """All eras as one lazy fact. An era whose months miss the filter reads nothing.

    The eras are the declared ones, or those that `found_eras` reads from the footers. A month that is there and belongs to no era, or to two, raises: it would be missing, or count twice.
    """
    present = month_list(months_of(partition_files(spark, base)))
    for year, month in present:
        covering = [era.name for era in eras if era.covers(year, month)]
        if len(covering) != 1:
            raise ValueError(f"month {year}-{month:02d} belongs to {covering or 'no era'}")
    used = [era for era in eras if any(era.covers(*month) for month in present)]
    if not present:
        used = eras[:1]  # an empty table still has the fact's columns
    return union_all([fact_shape(era_trips(spark, base, era, present)) for era in used])


def narrow_fact(spark: SparkSession, base: str, **ranges: tuple[int, int]) -> DataFrame:
    """The fact without the drift columns: one scan, enough for the rollup and all but one question."""
    return fact_shape(narrow_trips(spark, base, **ranges))


def wide_fact(cleaned: DataFrame) -> DataFrame:
    """A cleaned month as the 22-column fact, keys pinned to 32-bit integers."""

    def column(kind: str | None, source: str) -> Column:
        if kind == "date":
            return date_key_from_text(F.col(source))
        return F.col(source) if kind is None else F.col(source).cast(kind)

    return cleaned.select(
        *[
            column(kind, first_column(cleaned, names)).alias(name)
            for name, kind, names in WIDE_COLUMNS
        ]
    )


def with_trip_id(fact: DataFrame) -> DataFrame:
    """A surrogate id: unique, not dense, and stable only once it has been written with the fact."""
    return fact.withColumn("trip_id", F.monotonically_increasing_id())
