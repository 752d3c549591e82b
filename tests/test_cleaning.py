from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthmill.fixed_values import WIDE_COLUMNS
from monthmill.operators import cleaning
from monthmill.operators.joins import count_both_unknown, with_both_unknown
from monthmill.plans.fact import wide_fact, with_trip_id
from tests.trip_frames import ABSENT, CASES, raw_month


def survives(spark, rule, name):
    return rule(raw_month(spark, CASES[name])).count() == 1


@pytest.mark.parametrize(
    "rule, name, kept",
    [
        (cleaning.drop_all_missing, "all five missing", False),
        (cleaning.drop_all_missing, "one of five missing", True),
        (cleaning.drop_reversed, "reversed", False),
        (cleaning.drop_reversed, "dropoff missing", True),
        (cleaning.drop_reversed, "card with tip", True),
        (cleaning.drop_refunds, "refund", False),
        (cleaning.drop_refunds, "refund without distance", True),
        (cleaning.drop_refunds, "airport fee negative", True),
        (cleaning.drop_refunds, "negative tip", True),
    ],
)
def test_rule(spark, rule, name, kept):
    assert survives(spark, rule, name) is kept


def test_refund_goes_by_exact_case(spark):
    lower = raw_month(spark, CASES["airport fee negative"]).withColumnRenamed(
        "Airport_fee", "airport_fee"
    )
    assert cleaning.drop_refunds(lower).count() == 0


def test_refund_without_any_amount_keeps_all(spark):
    df = raw_month(spark, CASES["refund"]).select("trip_distance")
    assert cleaning.drop_refunds(df).count() == 1


def test_missing_distance_is_no_refund(spark):
    df = raw_month(spark, {"fare_amount": -1.0, "trip_distance": None})
    assert cleaning.drop_refunds(df).count() == 1


def test_any_missing_counts_partial_rows(spark):
    df = raw_month(spark, {}, ABSENT, CASES["one of five missing"])
    assert cleaning.count_any_missing(df).first()[0] == 2


def test_nan_is_missing(spark):
    df = raw_month(spark, {**ABSENT, "Airport_fee": float("nan")})
    assert cleaning.drop_all_missing(df).count() == 0


def test_split_times(spark, listed):
    got = cleaning.split_times(raw_month(spark, {}))
    picked = got.select(
        F.col("Pickup_date").cast("string"), "Pickup_time", F.col("Dropoff_date").cast("string"),
        "Dropoff_time",
    )
    assert listed(picked) == [("2025-01-06", 30615, "2025-01-06", 31500)]
    assert len(got.columns) == 24


def test_clean_month_has_22_columns(spark):
    cleaned = cleaning.clean_month(raw_month(spark, *CASES.values()))
    assert len(cleaned.columns) == 22
    assert cleaned.count() == len(CASES) - 3  # all missing, reversed, refund


def test_clean_month_is_one_stage(spark):
    plan = cleaning.clean_month(raw_month(spark, {}))._jdf.queryExecution().toString()
    assert "Exchange" not in plan


def test_wide_fact(spark):
    fact = wide_fact(cleaning.clean_month(raw_month(spark, {})))
    assert fact.columns == [name for name, _, _ in WIDE_COLUMNS] and len(fact.columns) == 22
    row = fact.first()
    assert (row.pickup_date_key, row.dropoff_date_key) == (20250106, 20250106)
    assert (row.pickup_time, row.rate_code_id, row.airport_fee) == (30615, 1, 0.0)
    assert dict(fact.dtypes)["passenger_count"] == "int"


def test_trip_ids_are_unique(spark):
    fact = with_trip_id(wide_fact(cleaning.clean_month(raw_month(spark, {}, {}, {}))))
    assert fact.select("trip_id").distinct().count() == 3


def test_both_unknown(spark):
    zones = spark.createDataFrame([(1,), (2,), (2,), (None,)], "location_id bigint")
    names = ["card with tip", "both locations unknown", "one location unknown", "location missing"]
    df = raw_month(spark, *[{**CASES[name], "VendorID": i} for i, name in enumerate(names)])
    got = with_both_unknown(df, zones, "location_id", "PULocationID", "DOLocationID", "lost")
    assert {row.VendorID: row.lost for row in got.collect()} == {
        0: False, 1: True, 2: False, 3: True,
    }
    assert got.count() == 4
    counts = count_both_unknown(df, zones, "location_id", "PULocationID", "DOLocationID")
    assert {row.both_unknown: row.trips for row in counts.collect()} == {True: 2, False: 2}


def test_audit_adds_up(spark, listed):
    zones = spark.createDataFrame([(1,), (2,)], "location_id bigint")
    n = len(CASES)
    got = listed(cleaning.audit_month(raw_month(spark, *CASES.values()), zones))
    assert got == [
        (1, "drop_all_missing", n, 1, n - 1, 2),
        (2, "drop_reversed", n - 1, 1, n - 2, 0),
        (3, "drop_refunds", n - 2, 1, n - 3, 0),
        (4, "report_unknown_locations", n - 3, 0, n - 3, 2),
    ]


def test_audit_of_nothing(spark, listed):
    zones = spark.createDataFrame([(1,)], "location_id bigint")
    got = listed(cleaning.audit_month(raw_month(spark, {}).limit(0), zones))
    assert [row[2:] for row in got] == [(0, 0, 0, 0)] * 4


def test_negative_distance(spark):
    df = raw_month(spark, {"trip_distance": -1.0}, {"trip_distance": None}, {})
    assert cleaning.count_negative_distance(df).first()[0] == 1


def test_written_and_audited_in_one_job(spark, rows, tmp_path):
    """The same rows and counts as cleaning and auditing one after the other."""
    df = raw_month(spark, *CASES.values()).repartition(3)
    zones = spark.createDataFrame([(1,), (2,)], "location_id int")
    path = str(tmp_path / "month")
    audit = cleaning.write_cleaned(df, zones, path)
    want = cleaning.audit_month(df, zones)
    assert audit.schema == want.schema and rows(audit) == rows(want)
    clean = cleaning.clean_month(df)
    written = spark.read.parquet(path)
    assert written.columns == clean.columns and rows(written) == rows(clean)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        cleaning.write_cleaned(df, zones, path)


def test_an_empty_month_is_written_and_audited(spark, rows, tmp_path):
    df = raw_month(spark, {}).limit(0)
    zones = spark.createDataFrame([(1,)], "location_id int")
    audit = cleaning.write_cleaned(df, zones, str(tmp_path / "month"))
    assert rows(audit) == rows(cleaning.audit_month(df, zones)) and rows(audit, "rows_before", "flagged") == [(0, 0)] * 4
