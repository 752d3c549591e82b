"""Dashboard frames, all from the rollup, and the figures derived from them for picked years.

A filter on the calendar year given to a frame's result reaches the calendar below its aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.fixed_values import CARD, NO_BOROUGH
from monthmill.functions.dates import first_of_month
from monthmill.functions.measures import percent, ratio, ratio_of_sums, sum_where
from monthmill.operators.joins import join_lookup
from monthmill.operators.topk import sort_up


def _by_calendar(rollup: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The rollup with the calendar's yr and mo in place of the file's year."""
    days = dim_date.select("date_key", F.col("year").alias("yr"), F.col("month").alias("mo"))
    return join_lookup(rollup, days, "pickup_date_key", "date_key", "inner")


def month_totals(rollup: DataFrame, dim_date: DataFrame, card=CARD) -> DataFrame:
    """Measures by calendar month, in no order: what further aggregates start from."""
    by_card = F.col("payment_type") == card
    return (
        _by_calendar(rollup, dim_date)
        .groupBy("yr", "mo")
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("total_revenue").alias("revenue"),
            F.sum("total_fare").alias("fare"),
            sum_where(by_card, "trips").alias("card_trips"),
            sum_where(by_card, "tipped_trips").alias("card_tipped"),
        )
    )


def monthly_series(rollup: DataFrame, dim_date: DataFrame, card=CARD) -> DataFrame:
    """The same in order of time."""
    return sort_up(month_totals(rollup, dim_date, card), "yr", "mo")


def zone_years(rollup: DataFrame, dim_location: DataFrame, dim_date: DataFrame) -> DataFrame:
    places = dim_location.select("location_id", "zone", "borough")
    joined = join_lookup(rollup, places, "pickup_location_id", "location_id", "inner")
    groups = _by_calendar(joined, dim_date).groupBy("zone", "borough", "yr")
    return groups.agg(F.sum("trips").alias("trips"))


def payment_years(rollup: DataFrame, dim_payment: DataFrame, dim_date: DataFrame) -> DataFrame:
    joined = join_lookup(rollup, dim_payment, "payment_type", "payment_type", "inner")
    return (
        _by_calendar(joined, dim_date)
        .groupBy("payment_desc", "yr")
        .agg(
            F.sum("trips").alias("trips"),
            F.sum("tipped_trips").alias("tipped"),
            F.sum("total_tip").alias("tip_total"),
        )
    )


def borough_years(
    rollup: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    card=CARD,
    left_out: list[str] = NO_BOROUGH,
) -> DataFrame:
    """Card measures by borough and year; places without a borough are left out."""
    by_card = F.col("payment_type") == card
    places = dim_location.select("location_id", "borough")
    places = places.filter(~F.col("borough").isin(left_out))
    joined = join_lookup(rollup, places, "pickup_location_id", "location_id", "inner")
    return (
        _by_calendar(joined, dim_date)
        .groupBy("borough", "yr")
        .agg(
            F.sum("trips").alias("trips"),
            sum_where(by_card, "trips").alias("card_trips"),
            sum_where(by_card, "tipped_trips").alias("card_tipped"),
            sum_where(by_card, "total_tip").alias("card_tip_total"),
        )
    )


def years_of(series: DataFrame) -> DataFrame:
    return sort_up(series.select("yr").distinct(), "yr")


def picked_years(df: DataFrame, years: list[int]) -> DataFrame:
    if not years:
        raise ValueError("pick at least one year")
    return df.filter(F.col("yr").isin(years))


def headline(series: DataFrame, years: list[int]) -> DataFrame:
    """Trips, revenue, average fare and the tipped share of card trips over the picked years."""
    return picked_years(series, years).agg(
        F.sum("trips").alias("trips"),
        F.sum("revenue").alias("revenue"),
        ratio_of_sums("fare", F.sum("trips")).alias("avg_fare"),
        percent(F.sum("card_tipped"), F.sum("card_trips"), None).alias("pct_card_tipped"),
    )


def monthly_trend(series: DataFrame, years: list[int]) -> DataFrame:
    period = first_of_month(F.col("yr"), F.col("mo")).alias("period")
    trend = picked_years(series, years).select(period, "yr", "mo", "trips", "revenue")
    return sort_up(trend, "period")


def top_zones(zones: DataFrame, years: list[int], k: int = 10) -> DataFrame:
    """The k zones with most trips over the picked years, smallest first as bars are drawn."""
    totals = picked_years(zones, years).filter(F.col("zone").isNotNull())
    totals = totals.groupBy("zone").agg(F.sum("trips").alias("trips"))
    best = totals.orderBy(F.desc_nulls_last("trips"), F.asc_nulls_last("zone")).limit(k)
    return sort_up(best, "trips", "zone")


def tip_visibility(payments: DataFrame, years: list[int], min_trips: int = 10_000) -> DataFrame:
    """Tipped share by payment type, for those with more than ``min_trips``."""
    totals = (
        picked_years(payments, years)
        .filter(F.col("payment_desc").isNotNull())
        .groupBy("payment_desc")
        .agg(F.sum("trips").alias("trips"), F.sum("tipped").alias("tipped"))
        .filter(F.col("trips") > min_trips)
    )
    shares = totals.withColumn("pct", ratio(F.lit(100.0) * F.col("tipped"), F.col("trips")))
    return sort_up(shares, "trips", "payment_desc")


def card_rate_by_borough(
    boroughs: DataFrame, years: list[int], min_card_trips: int = 100_000
) -> DataFrame:
    """Tipped share of card trips by borough, for those with more than ``min_card_trips``."""
    totals = (
        picked_years(boroughs, years)
        .filter(F.col("borough").isNotNull())
        .groupBy("borough")
        .agg(F.sum("card_trips").alias("card_trips"), F.sum("card_tipped").alias("card_tipped"))
        .filter(F.col("card_trips") > min_card_trips)
    )
    share = ratio(F.lit(100.0) * F.col("card_tipped"), F.col("card_trips"))
    return sort_up(totals.withColumn("pct", share), "pct", "borough")
