"""Questions asked of the lakehouse fact or its rollup.

Left joins keep trips of unknown zones or dates, inner joins drop them; each question keeps its own.
Trips are counted per id before they meet a lookup, so that lookups join groups and not trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.fixed_values import CARD
from monthmill.functions.dates import hour_bucket
from monthmill.functions.measures import (
    count_where,
    percent,
    ratio_of_sums,
    rounded_sum,
    tipped_nonzero,
    total_where,
    trip_count,
)
from monthmill.operators.joins import join_lookup
from monthmill.operators.topk import top_k
from monthmill.operators.windows import z_score


def in_year(df: DataFrame, year: int | None) -> DataFrame:
    """A filter on the partition column, so it prunes files."""
    return df if year is None else df.filter(F.col("year") == year)


def top_zones_from_fact(
    fact: DataFrame, dim_location: DataFrame, year: int | None = None, k: int = 10
) -> DataFrame:
    places = in_year(fact, year).groupBy("pickup_location_id").agg(trip_count(fact).alias("trips"))
    return top_zones_from_rollup(places, dim_location, None, k)


def top_zones_from_rollup(
    rollup: DataFrame, dim_location: DataFrame, year: int | None = None, k: int = 10
) -> DataFrame:
    """The same answer: a rollup row stands for many trips, so they are summed."""
    zones = join_lookup(in_year(rollup, year), dim_location, "pickup_location_id", "location_id")
    return top_k(zones.groupBy("zone").agg(F.sum("trips").alias("trips")), "trips", k, "zone")


def borough_months(
    rollup: DataFrame, dim_date: DataFrame, dim_location: DataFrame, year: int | None = None
) -> DataFrame:
    """Trips, revenue, average tip and tipped share per month and borough.

    The filter is on the file's year, the grouping on the calendar's.
    """
    facts = in_year(rollup, year).drop("year", "month")
    joined = join_lookup(facts, dim_date, "pickup_date_key", "date_key", "inner")
    joined = join_lookup(joined, dim_location, "pickup_location_id", "location_id", "inner")
    return (
        joined.groupBy("year", "month", "borough")
        .agg(
            F.sum("trips").alias("trips"),
            rounded_sum("total_revenue").alias("revenue"),
            ratio_of_sums("total_tip", F.sum("trips"), 2).alias("avg_tip_per_trip"),
            percent(F.sum("tipped_trips"), F.sum("trips")).alias("pct_tipped"),
        )
        .orderBy(
            F.asc_nulls_last("month"), F.desc_nulls_last("revenue"), F.asc_nulls_last("borough")
        )
    )


def card_tip_share(fact: DataFrame, year: int | None = None, card=CARD) -> DataFrame:
    """Of the trips whose tip would be on record, the share that has one."""
    cards = in_year(fact, year).filter(F.col("payment_type") == card)
    return cards.agg(percent(count_where(tipped_nonzero()), F.count("*")).alias("pct_tipped"))


def week_parts_with_unmatched(
    fact: DataFrame, dim_date: DataFrame, year: int | None = None
) -> DataFrame:
    """Weekday and weekend trips, and those whose date the calendar does not have."""
    counts = in_year(fact, year).groupBy("pickup_date_key").agg(F.count("*").alias("trips"))
    days = dim_date.select("date_key", "is_weekend")
    joined = join_lookup(counts, days, "pickup_date_key", "date_key")
    weekend = F.col("is_weekend")
    return joined.agg(
        total_where(~weekend, "trips").alias("weekday_trips"),
        total_where(weekend, "trips").alias("weekend_trips"),
        total_where(weekend.isNull(), "trips").alias("unmatched_dates"),
    )


def star_report(
    fact: DataFrame,
    dim_payment: DataFrame,
    dim_rate_code: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    year: int | None = None,
    month: int | None = None,
    k: int = 20,
) -> DataFrame:
    """Trips and average tip by payment, rate code, borough and weekend; the k largest groups."""
    trips = in_year(fact, year)
    if month is not None:
        trips = trips.filter(F.col("month") == month)
    keys = ["payment_desc", "rate_code_desc", "borough", "is_weekend"]
    counts = trips.groupBy(
        "payment_type", "rate_code_id", "pickup_location_id", "pickup_date_key"
    ).agg(
        F.count("*").alias("trips"),
        F.sum("tip_amount").alias("tips"),
        F.count("tip_amount").alias("tip_count"),
    )
    joined = join_lookup(counts, dim_payment, "payment_type", "payment_type")
    joined = join_lookup(joined, dim_rate_code, "rate_code_id", "rate_code_id")
    boroughs = dim_location.select("location_id", "borough")
    joined = join_lookup(joined, boroughs, "pickup_location_id", "location_id")
    weekends = dim_date.select("date_key", "is_weekend")
    joined = join_lookup(joined, weekends, "pickup_date_key", "date_key")
    groups = joined.groupBy(*keys).agg(
        F.sum("trips").alias("trips"), ratio_of_sums("tips", F.sum("tip_count"), 2).alias("avg_tip")
    )
    return top_k(groups, "trips", k, *keys)


def hourly_trips(fact: DataFrame) -> DataFrame:
    """hour_bucket, hour_of_day, trips; grouped by day and hour, the bucket made afterwards."""
    day, hour = F.to_date("pickup_time").alias("day"), F.hour("pickup_time").alias("hour_of_day")
    counts = fact.groupBy(day, hour).agg(F.count("*").alias("trips"))
    bucket = hour_bucket(F.col("day"), F.col("hour_of_day"))
    return counts.select(bucket.alias("hour_bucket"), "hour_of_day", "trips")


def hourly_anomalies(
    fact: DataFrame, years: tuple[int, int] | None = None, k: int = 20
) -> DataFrame:
    """The hours furthest from the history of the same hour of the day.

    The window runs over one row per hour, 24 groups with one row per day each.
    """
    if years is not None:
        fact = fact.filter(F.col("year").between(*years))
    hours = hourly_trips(fact)
    scored = hours.withColumn("z", z_score(hours, "trips", ["hour_of_day"]))
    return top_k(scored, F.abs("z"), k, "hour_bucket")
