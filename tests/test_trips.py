"""Sources, dimensions, the fact, the rollup and its refresh on hand-made monthly files."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthmill.operators.quality import reconcile
from monthmill.plans import dashboard, demand, dims, lakehouse
from monthmill.plans.fact import fact_trips, narrow_fact
from monthmill.plans.rollup import build_rollup, rebuild_rollup, refresh_rollup, write_rollup
from monthmill.schemas import TRIP_ERAS
from monthmill.sources import calendar, files, lookups, trips
from monthmill.streaming.refresh import run_rollup_refresh
from tests.trip_frames import MONTHS, ZONES_CSV, month_frame, write_layout

ALL_TRIPS = sum(count for _, count, _, _ in MONTHS)


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "trips")
    write_layout(spark, path)
    return path


@pytest.fixture(scope="module")
def zones(tmp_path_factory):
    path = tmp_path_factory.mktemp("zones") / "zones.csv"
    path.write_text(ZONES_CSV)
    return str(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- scans ---


def test_narrow_scan_reads_all_months_or_a_range(spark, base, rows):
    every = [(2022, 12, 5), (2023, 1, 6), (2023, 2, 7), (2024, 3, 8), (2027, 1, 9)]
    got = trips.narrow_trips(spark, base).groupBy("year", "month").count()
    assert rows(got) == every
    got = trips.narrow_trips(spark, base, (2021, 2026)).groupBy("year", "month").count()
    assert rows(got) == every[:-1]
    assert dict(trips.narrow_trips(spark, base).dtypes)["pulocationid"] == "bigint"


def test_months_are_found_without_padding(spark, base):
    assert trips.narrow_trips(spark, base).filter("year = 2024 AND month = 3").count() == 8


def test_year_filter_prunes_files(spark, base):
    fact = narrow_fact(spark, base).filter("year = 2024").select("fare_amount")
    plan = fact._jdf.queryExecution().explainString(
        fact.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    (filters,) = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert "year" in filters and "= 2024)" in filters
    assert "ReadSchema: struct<fare_amount:double>" in plan


def test_mixed_types_fail_without_eras(spark, base):
    with pytest.raises(Exception):
        spark.read.schema(TRIP_ERAS[0].ddl).parquet(base).select("ratecodeid").collect()


def test_era_union(spark, base, rows):
    fact = fact_trips(spark, base)
    assert fact.count() == ALL_TRIPS
    kinds = dict(fact.dtypes)
    assert kinds["rate_code_id"] == kinds["passenger_count"] == "bigint"
    assert fact.filter("year = 2027").count() == 9
    assert rows(fact.filter("year < 2027").groupBy("year").agg(F.sum("passenger_count"))) == [
        (2022, 11), (2023, 29), (2024, 20),
    ]


def test_filter_on_the_union_reaches_every_era(spark, base):
    plan = plan_of(fact_trips(spark, base).filter("year = 2023 AND month = 2").select("fare_amount"))
    assert plan.count("PartitionFilters: [isnotnull(year") == plan.count("Scan parquet")


def test_era_without_files_is_empty(spark, base):
    era = TRIP_ERAS[0]
    got = trips.era_trips(spark, base, era, [(2024, 3)])
    assert got.count() == 0 and "passenger_count" in got.columns


def test_one_file_keeps_its_types(spark, base):
    df = trips.one_file(spark, f"{base}/year=2022/month=12")
    assert dict(df.dtypes)["ratecodeid"] == "double"


def test_signatures(spark, base, rows):
    found = files.signature_summary(
        files.partition_files(spark, base), ["RatecodeID", "passenger_count"]
    )
    assert rows(found) == [
        ("ratecodeid double, passenger_count double", 2, 202212, 202301),
        ("ratecodeid int64, passenger_count int64", 3, 202302, 202701),
    ]
    assert files.file_signatures(files.list_files(spark, base)).count() == len(MONTHS)


def test_listing_of_an_absent_folder_is_empty(spark, tmp_path):
    assert files.list_files(spark, str(tmp_path / "nothing")).count() == 0
    assert files.months_of(files.partition_files(spark, str(tmp_path / "nothing"))).count() == 0


# --- dimensions ---


def test_lakehouse_zones_keep_na(spark, zones, rows):
    dim = dims.location_lakehouse(lookups.zones_as_text(spark, zones))
    assert dim.dtypes[0] == ("location_id", "bigint")
    assert (264, "Unknown", "N/A", "N/A") in rows(dim)
    assert (2, "Eastside", " Mill Pond ", "Outer") in rows(dim)


def test_notebook_zones_fill_and_trim(spark, zones, rows):
    text = lookups.zones_as_text(spark, zones).withColumn("line", F.monotonically_increasing_id())
    again = text.union(text.filter("locationid = '2'").withColumns(
        {"zone": F.lit("Copy"), "line": F.lit(1000).cast("bigint")}
    ))
    dim = dims.location_notebook(again, ["line"])
    assert (264, "Unknown", "Unknown", "Unknown") in rows(dim)
    assert (265, "Unknown", "Outside", "Unknown") in rows(dim)
    assert (2, "Eastside", "Mill Pond", "Outer") in rows(dim)
    assert dim.count() == 7


def test_texts_that_mean_missing(spark):
    texts = spark.createDataFrame([(t,) for t in ("NULL", "nan", "<NA>", "None", "", None, "Nan", "none")], "t string")
    kept = lookups.text_as_missing(texts, ["t"]).filter("t is not null")
    assert sorted(row.t for row in kept.collect()) == ["Nan", "none"]


def test_zone_list_with_nulls(spark, zones):
    got = lookups.zones_with_nulls(spark, zones).filter("locationid = 264").first()
    assert (got.zone, got.borough) == (None, "Unknown")


def test_code_lists(spark, listed):
    lake, note = dims.rate_code(spark), dims.rate_code(spark, "notebook")
    assert lake.columns == ["rate_code_id", "rate_code_desc"]
    assert note.columns == ["rate_code_id", "rate_code_description"]
    assert listed(lake)[-1] == (99, "Null/unknown") and listed(note)[-1] == (99, "Unknown")
    assert dims.payment(spark).count() == 7
    assert dims.payment(spark).dtypes[0] == ("payment_type", "bigint")


def test_inline_text_is_quoted(spark, listed):
    got = lookups.inline_relation(spark, [(1, "it's \\ fine"), (2, None)], "k int, t string")
    assert listed(got) == [(1, "it's \\ fine"), (2, None)]


def test_fixed_calendar(spark, listed):
    days = calendar.lakehouse_calendar(spark)
    assert days.count() == 2191
    new_year = days.filter("date_key = 20220101").first()
    assert (new_year.dow, new_year.is_weekend, new_year.day_of_month) == (6, True, 1)


def test_calendar_from_data(spark):
    a = spark.createDataFrame([(dt.date(2024, 2, 28),), (None,)], "d date")
    b = spark.createDataFrame([(dt.datetime(2024, 3, 1, 5),)], "t timestamp_ntz")
    days = calendar.wide_calendar(a, b).orderBy("date_key")
    assert [r.date_key for r in days.collect()] == [20240228, 20240229, 20240301]
    first = days.first()
    assert (first.month_name, first.day_name, first.quarter, first.week_of_year) == (
        "February", "Wednesday", 1, 9,
    )
    assert len(days.columns) == 11


def test_calendar_of_no_dates_is_empty(spark):
    assert calendar.wide_calendar(spark.createDataFrame([], "d date")).count() == 0


# --- rollup ---


def test_rollup_adds_up(spark, base, tmp_path, rows):
    fact, path = narrow_fact(spark, base), str(tmp_path / "rollup")
    rebuild_rollup(fact, path)
    rollup = spark.read.parquet(path)
    assert all(row[3] == 0 for row in rows(reconcile(fact, rollup)))
    assert rollup.agg(F.sum("trips")).first()[0] == ALL_TRIPS
    assert rollup.agg(F.sum("tipped_trips")).first()[0] == fact.filter("tip_amount > 0").count()


def test_same_answer_from_fact_and_rollup(spark, base, zones, listed):
    fact = narrow_fact(spark, base)
    zone = dims.location_lakehouse(lookups.zones_as_text(spark, zones))
    one = lakehouse.top_zones_from_fact(fact, zone, 2024)
    assert listed(one) == listed(lakehouse.top_zones_from_rollup(build_rollup(fact), zone, 2024))
    assert listed(one)[0] == ("Twin Hill", 4)  # two ids, one name


def test_stray_date_stays_in_its_files_year(spark, tmp_path, rows):
    base = str(tmp_path / "stray")
    write_layout(spark, base, [((2025, 6), 4, "bigint", "int")], dt.datetime(2001, 1, 1))
    fact = narrow_fact(spark, base)
    rollup = build_rollup(fact)
    assert rows(rollup.filter("pickup_date_key = 20010101").select("year", "trips")) == [(2025, 1)]
    days = calendar.lakehouse_calendar(spark)
    got = lakehouse.week_parts_with_unmatched(fact, days, 2025).first()
    assert got.unmatched_dates == 1 and sum(got) == 4
    # left joins keep it, inner joins drop it
    assert dashboard.monthly_series(rollup, days).agg(F.sum("trips")).first()[0] == 3
    assert demand.week_parts(fact, days).first().weekday_trips + demand.week_parts(
        fact, days
    ).first().weekend_trips == 3


def test_write_replaces_only_the_years_given(spark, base, tmp_path, rows):
    path = str(tmp_path / "rollup")
    rollup = build_rollup(narrow_fact(spark, base))
    write_rollup(rollup, path)
    write_rollup(rollup.filter("year = 2023").withColumn("trips", F.lit(100).cast("bigint")), path)
    per_year = spark.read.parquet(path).groupBy("year").agg(F.max("trips") >= 100)
    assert rows(per_year) == [(2022, False), (2023, True), (2024, False), (2027, False)]


def test_write_spreads_a_large_partition(spark, base):
    hinted = build_rollup(narrow_fact(spark, base)).hint("rebalance", F.col("year"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(hinted)


@pytest.mark.parametrize("by", [("year",), ("year", "month")])
def test_refresh_is_idempotent(spark, tmp_path, rows, by):
    base, path = str(tmp_path / "trips"), str(tmp_path / "rollup")
    write_layout(spark, base, MONTHS[:2])
    rebuild_rollup(narrow_fact(spark, base), path, by)
    write_layout(spark, base, MONTHS[2:3])
    landed = spark.createDataFrame([(2023, 2)], "year int, month int")
    for _ in range(2):
        refresh_rollup(spark, base, path, landed, by)
        assert rows(spark.read.parquet(path).groupBy("year").agg(F.sum("trips"))) == [
            (2022, 5), (2023, 13),
        ]


def test_stream_refresh(spark, tmp_path, rows):
    base, path, progress = (str(tmp_path / name) for name in ("trips", "rollup", "progress"))
    totals = lambda: rows(spark.read.parquet(path).groupBy("year").agg(F.sum("trips")))
    write_layout(spark, base, MONTHS[:2])
    run_rollup_refresh(spark, base, path, progress)
    assert totals() == [(2022, 5), (2023, 6)]
    write_layout(spark, base, MONTHS[2:])
    run_rollup_refresh(spark, base, path, progress, files_per_batch=1)
    assert totals() == [(2022, 5), (2023, 13), (2024, 8), (2027, 9)]
    run_rollup_refresh(spark, base, path, progress)
    assert totals() == [(2022, 5), (2023, 13), (2024, 8), (2027, 9)]


def test_refresh_does_not_pass_files_outside_its_range(spark, tmp_path):
    base, path, progress = (str(tmp_path / name) for name in ("trips", "rollup", "progress"))
    write_layout(spark, base)
    with pytest.raises(Exception, match="outside"):
        run_rollup_refresh(spark, base, path, progress, years=(2021, 2026))
    run_rollup_refresh(spark, base, path, progress)
    assert spark.read.parquet(path).agg(F.sum("trips")).first()[0] == narrow_fact(spark, base).count()


def test_months_of_no_era_or_two_raise(spark, base):
    with pytest.raises(ValueError, match="no era"):
        fact_trips(spark, base, TRIP_ERAS[:-1])
    with pytest.raises(ValueError, match="2022-12"):
        fact_trips(spark, base, [*TRIP_ERAS, TRIP_ERAS[0]])


def test_calendar_covers_the_years_of_a_fact(spark, base):
    days = calendar.lakehouse_calendar(spark, covering=narrow_fact(spark, base))
    series = dashboard.monthly_series(build_rollup(narrow_fact(spark, base)), days)
    assert series.agg(F.sum("trips")).first()[0] == ALL_TRIPS


def test_nan_code_is_null(spark):
    from monthmill.functions.measures import whole_number

    df = spark.createDataFrame([(float("nan"),), (1.5,), (2.4,), (None,)], "code double")
    assert [r[0] for r in df.select(whole_number(F.col("code"))).collect()] == [None, 2, 2, None]


def test_stream_replays_without_counting_twice(spark, tmp_path, rows):
    """Losing the progress replays every file."""
    base, path = str(tmp_path / "trips"), str(tmp_path / "rollup")
    write_layout(spark, base, MONTHS[:3])
    for attempt in ("first", "second"):
        run_rollup_refresh(spark, base, path, str(tmp_path / attempt))
    assert rows(spark.read.parquet(path).groupBy("year").agg(F.sum("trips"))) == [(2022, 5), (2023, 13)]


# --- questions ---


def test_hour_anomaly_is_found(spark):
    usual = [(dt.datetime(2024, 1, d, h, m),) for d in range(1, 15) for h in (3, 9) for m in range(5)]
    rush = [(dt.datetime(2024, 1, 20, 3, m),) for m in range(50)]
    quiet = [(dt.datetime(2024, 1, 20, 9, m),) for m in range(5)]
    fact = spark.createDataFrame(usual + rush + quiet, "pickup_time timestamp_ntz")
    worst = lakehouse.hourly_anomalies(fact, k=1).first()
    assert (worst.hour_bucket, worst.trips) == (dt.datetime(2024, 1, 20, 3), 50)
    assert worst.z > 3


def test_questions_accept_seconds_of_day(spark, listed):
    fact = spark.createDataFrame([(3600,), (3700,), (7200,)], "pickup_time int")
    assert listed(demand.busiest_hours(fact)) == [(1, 2), (2, 1)]


def test_pick_of_no_years_is_an_error(spark):
    series = spark.createDataFrame([], "yr int, mo int")
    with pytest.raises(ValueError):
        dashboard.picked_years(series, [])


def test_thresholds_are_strict(spark, listed):
    pay = spark.createDataFrame(
        [("Cash", 2024, 10, 0), ("Card", 2024, 11, 10), (None, 2024, 50, 1)],
        "payment_desc string, yr int, trips bigint, tipped bigint",
    )
    got = dashboard.tip_visibility(pay, [2024], 10)
    assert [(r.payment_desc, round(r.pct, 2)) for r in got.collect()] == [("Card", 90.91)]


def test_card_measures_are_null_without_cards(spark, zones, listed):
    rollup = build_rollup(
        month_frame(spark, 2024, 3, 1)
        .selectExpr(
            "20240301 AS pickup_date_key", "1L AS pickup_location_id", "2L AS payment_type",
            "fare_amount", "tip_amount", "total_amount", "trip_distance", "2024 AS year",
        )
    )
    zone = dims.location_lakehouse(lookups.zones_as_text(spark, zones))
    got = dashboard.borough_years(rollup, zone, calendar.lakehouse_calendar(spark))
    assert listed(got) == [("Harbour", 2024, 1, None, None, None)]


def test_places_without_a_borough_are_left_out(spark, zones):
    rollup = build_rollup(
        spark.createDataFrame([(264,), (265,), (1,)], "pickup_location_id bigint").selectExpr(
            "20240301 AS pickup_date_key", "pickup_location_id", "1L AS payment_type",
            "1.0D AS fare_amount", "1.0D AS tip_amount", "1.0D AS total_amount",
            "1.0D AS trip_distance", "2024 AS year",
        )
    )
    zone = dims.location_lakehouse(lookups.zones_as_text(spark, zones))
    got = dashboard.borough_years(rollup, zone, calendar.lakehouse_calendar(spark))
    assert [row.borough for row in got.collect()] == ["Harbour"]
