from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthmill.functions import dates, measures, names


def test_date_keys_agree(spark, listed):
    df = spark.createDataFrame([(dt.datetime(2025, 3, 9, 23, 59, 58),), (None,)], "t timestamp_ntz")
    got = df.select(
        dates.date_key(F.col("t")),
        dates.date_key_from_text(F.col("t")),
        dates.seconds_of_day(F.col("t")),
    )
    assert listed(got) == [(20250309, 20250309, 86398), (None, None, None)]


def test_week_days(spark, listed):
    days = [dt.date(2025, 1, d) for d in (3, 4, 5, 6)]  # Friday .. Monday
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(dates.iso_day_of_week(F.col("d")), dates.is_weekend(F.col("d")))
    assert listed(got) == [(5, False), (6, True), (7, True), (1, False)]


def test_hour_of_timestamp_and_of_seconds(spark, listed):
    df = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 13, 59), 13 * 3600 + 3599)], "t timestamp_ntz, s int"
    )
    assert listed(df.select(dates.hour_of_day(df, "t"), dates.hour_of_day(df, "s"))) == [(13, 13)]


def test_hour_bucket_has_no_zone(spark):
    """2025-03-09 02:30 does not exist in New York; a zoned truncation would move it."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(dt.datetime(2025, 3, 9, 2, 30),)], "t timestamp_ntz")
        bucket = dates.hour_bucket(F.to_date("t"), F.hour("t")).alias("b")
        got = df.select(bucket)
        assert got.dtypes == [("b", "timestamp_ntz")]
        assert got.first().b == dt.datetime(2025, 3, 9, 2)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_first_of_month(spark):
    df = spark.createDataFrame([(2025, 3)], "y int, m int")
    assert df.select(dates.first_of_month(F.col("y"), F.col("m"))).first()[0] == dt.date(2025, 3, 1)


def test_conditional_sum_is_null_without_a_match(spark, listed):
    df = spark.createDataFrame([(1, 5.0), (2, 7.0)], "k int, x double")
    got = df.agg(
        measures.sum_where(F.col("k") == 3, "x"),
        measures.sum_where(F.col("k") == 2, "x"),
        measures.count_where(F.col("k") == 3),
    )
    assert listed(got) == [(None, 7.0, 0)]


def test_ratios_of_nothing_are_null(spark, listed):
    df = spark.createDataFrame([], "tip_amount double")
    got = df.agg(
        measures.mean("tip_amount", 2),
        measures.percent(measures.count_where(measures.tipped_nonzero()), F.count("*")),
    )
    assert listed(got) == [(None, None)]


def test_tipped_definitions_differ_on_negative_tips(spark, listed):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "tip_amount double")
    got = df.agg(
        measures.count_where(measures.tipped_positive()),
        measures.count_where(measures.tipped_nonzero()),
    )
    assert listed(got) == [(1, 2)]


def test_rounding_is_half_up_on_digits(spark, listed):
    df = spark.createDataFrame([(1.005,), (0.0,)], "x double")
    assert listed(df.agg(measures.rounded_sum("x"))) == [(1.01,)]


def test_whole_number_rounds(spark, listed):
    df = spark.createDataFrame([(2.5,), (1.5,), (99.0,), (None,)], "x double")
    assert listed(df.select(measures.whole_number(F.col("x")))) == [(3,), (2,), (99,), (None,)]


def test_trip_count_uses_the_id_where_there_is_one(spark, listed):
    with_id = spark.createDataFrame([(1, 5), (None, 5)], "trip_id bigint, k int")
    assert listed(with_id.agg(measures.trip_count(with_id))) == [(1,)]
    assert listed(with_id.agg(measures.trip_count_where(with_id, F.col("k") == 5))) == [(1,)]
    without = with_id.drop("trip_id")
    assert listed(without.agg(measures.trip_count(without))) == [(2,)]


def test_tidy_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "` VendorID ` int, `Trip Distance (mi)` int, ok_1 int")
    assert names.tidy_columns(df).columns == ["vendorid", "trip_distance_mi", "ok_1"]


def test_first_column_goes_by_case(spark):
    df = spark.createDataFrame([(1, 2)], "Pickup_date int, x int")
    assert names.first_column(df, ["pickup_date", "Pickup_date"]) == "Pickup_date"
    with pytest.raises(KeyError):
        names.first_column(df, ["pickup_date"])
    assert names.existing_columns(df, ["pickup_date", "x"]) == ["x"]


def test_month_names_are_padded(spark, listed):
    df = spark.createDataFrame([(2025, 3)], "y int, m int")
    folder = names.month_folder(F.col("y"), F.col("m"))
    file = names.month_file("trips", F.col("y"), F.col("m"))
    assert listed(df.select(folder, file)) == [("year=2025/month=03", "trips_2025-03.parquet")]


def test_year_range():
    assert names.year_range("2021-2025") == (2021, 2025)
    assert names.year_range("2025") == (2025, 2025)
