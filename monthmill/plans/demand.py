"""Questions asked of one cleaned month: demand by hour, day and zone, fares and tips.

Trips are counted per id before they meet a lookup, so that lookups join groups and not trips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.functions.dates import hour_of_day
from monthmill.functions.measures import (
    count_where,
    percent,
    ratio_of_sums,
    tipped_nonzero,
    total_where,
    trip_count,
)
from monthmill.operators.joins import join_lookup
from monthmill.operators.topk import sort_up, top_k
from monthmill.operators.windows import rank_rows, rolling_mean, z_score


def _with_zone(fact: DataFrame, dim_location: DataFrame, attribute: str) -> DataFrame:
    lookup = dim_location.select("location_id", attribute)
    return join_lookup(fact, lookup, "pickup_location_id", "location_id")


def _with_day(fact: DataFrame, dim_date: DataFrame, attribute: str) -> DataFrame:
    lookup = dim_date.select("date_key", attribute)
    return join_lookup(fact, lookup, "pickup_date_key", "date_key")


def busiest_hours(fact: DataFrame, k: int = 10) -> DataFrame:
    hours = fact.groupBy(hour_of_day(fact, "pickup_time").alias("pickup_hour"))
    return top_k(hours.agg(F.count("*").alias("trips")), "trips", k, "pickup_hour")


def average_fare_by_borough(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    fares = fact.groupBy("pickup_location_id").agg(
        F.sum("fare_amount").alias("fares"), F.count("fare_amount").alias("fare_count")
    )
    groups = _with_zone(fares, dim_location, "borough").groupBy("borough")
    average = groups.agg(ratio_of_sums("fares", F.sum("fare_count")).alias("average_fare"))
    return sort_up(average, "average_fare", "borough")


def tipped_share_by_borough(fact: DataFrame, dim_location: DataFrame) -> DataFrame:
    """All payment types, so it also measures how many pay in cash."""
    counts = fact.groupBy("pickup_location_id").agg(
        count_where(tipped_nonzero()).alias("tipped"), F.count("*").alias("trips")
    )
    groups = _with_zone(counts, dim_location, "borough").groupBy("borough")
    return groups.agg(percent(F.sum("tipped"), F.sum("trips")).alias("pct_tipped"))


def tipped_share(fact: DataFrame) -> DataFrame:
    return fact.agg(percent(count_where(tipped_nonzero()), F.count("*")).alias("pct_tipped"))


def payment_with_most_tips(fact: DataFrame, dim_payment: DataFrame, text: str, k: int = 1):
    """``text`` is the dimension's description column, which differs between its variants."""
    tips = fact.groupBy("payment_type").agg(F.sum("tip_amount").alias("total_tip"))
    groups = join_lookup(tips, dim_payment, "payment_type", "payment_type").groupBy(text)
    return top_k(groups.agg(F.sum("total_tip").alias("total_tip")), "total_tip", k, text)


def _counts(fact: DataFrame, *by) -> DataFrame:
    return fact.groupBy(*by).agg(trip_count(fact).alias("trips"))


def _week_parts() -> list:
    weekend = F.col("is_weekend")
    return [
        total_where(~weekend, "trips").alias("weekday_trips"),
        total_where(weekend, "trips").alias("weekend_trips"),
    ]


def week_parts(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return _with_day(_counts(fact, "pickup_date_key"), dim_date, "is_weekend").agg(*_week_parts())


def week_parts_by_hour(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    hour = hour_of_day(fact, "pickup_time").alias("time_of_day")
    joined = _with_day(_counts(fact, "pickup_date_key", hour), dim_date, "is_weekend")
    return sort_up(joined.groupBy("time_of_day").agg(*_week_parts()), "time_of_day")


def week_parts_by_place(
    fact: DataFrame, dim_date: DataFrame, dim_location: DataFrame, attribute: str = "zone"
) -> DataFrame:
    """By zone, or by borough."""
    counts = _counts(fact, "pickup_location_id", "pickup_date_key")
    joined = _with_day(_with_zone(counts, dim_location, attribute), dim_date, "is_weekend")
    return joined.groupBy(attribute).agg(*_week_parts())


def trips_by_day_of_month(fact: DataFrame, dim_date: DataFrame, day: str = "day") -> DataFrame:
    """One row per day 1 to 31, and one with null for dates the calendar does not have."""
    joined = _with_day(_counts(fact, "pickup_date_key"), dim_date, day)
    return joined.groupBy(F.col(day).alias("day_of_month")).agg(F.sum("trips").alias("total_count"))


def ranked_days(fact: DataFrame, dim_date: DataFrame, k: int = 10, day: str = "day") -> DataFrame:
    ranked = rank_rows(
        trips_by_day_of_month(fact, dim_date, day), "total_count", "day_of_month", "rank_day"
    )
    return ranked.filter(F.col("rank_day") <= k).select("rank_day", "day_of_month", "total_count")


def rolling_three_days(fact: DataFrame, dim_date: DataFrame, day: str = "day") -> DataFrame:
    """Over days of the month, so it means three days in a row for a single month only."""
    days = trips_by_day_of_month(fact, dim_date, day)
    rolled = rolling_mean(days, "total_count", "day_of_month", 3, "rolling_avg")
    return rolled.select("rolling_avg", "day_of_month", "total_count")


def unusual_hours(fact: DataFrame) -> DataFrame:
    """One z-score over the 24 hourly totals."""
    groups = fact.groupBy(hour_of_day(fact, "pickup_time").alias("pickup_hour"))
    hours = groups.agg(trip_count(fact).alias("number_of_trip"))
    scored = hours.withColumn("z_score", z_score(hours, "number_of_trip"))
    return scored.orderBy(F.abs("z_score").desc_nulls_last(), F.asc_nulls_last("pickup_hour"))
