"""Small hand-made trips, zones and monthly files."""

from __future__ import annotations

import datetime as dt

RAW_DDL = """
    VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
    passenger_count double, trip_distance double, RatecodeID double, store_and_fwd_flag string,
    PULocationID int, DOLocationID int, payment_type bigint, fare_amount double, extra double,
    mta_tax double, tip_amount double, tolls_amount double, improvement_surcharge double,
    total_amount double, congestion_surcharge double, Airport_fee double, cbd_congestion_fee double
"""
RAW_NAMES = [part.split()[0] for part in RAW_DDL.split(",")]

PLAIN = {
    "VendorID": 1,
    "tpep_pickup_datetime": dt.datetime(2025, 1, 6, 8, 30, 15),
    "tpep_dropoff_datetime": dt.datetime(2025, 1, 6, 8, 45, 0),
    "passenger_count": 1.0,
    "trip_distance": 2.5,
    "RatecodeID": 1.0,
    "store_and_fwd_flag": "N",
    "PULocationID": 1,
    "DOLocationID": 2,
    "payment_type": 1,
    "fare_amount": 10.0,
    "extra": 1.0,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 1.0,
    "total_amount": 14.5,
    "congestion_surcharge": 2.5,
    "Airport_fee": 0.0,
    "cbd_congestion_fee": 0.75,
}
ABSENT = dict.fromkeys(
    ["passenger_count", "RatecodeID", "store_and_fwd_flag", "congestion_surcharge", "Airport_fee"]
)


def raw_month(spark, *changes):
    """One trip per argument: the plain trip with the given changes."""
    trips = [tuple({**PLAIN, **change}[name] for name in RAW_NAMES) for change in changes]
    return spark.createDataFrame(trips, RAW_DDL)


# name -> change; what becomes of each is written in the tests
CASES = {
    "card with tip": {},
    "cash without tip": {"payment_type": 2, "tip_amount": 0.0},
    "negative tip": {"tip_amount": -1.0},
    "all five missing": ABSENT,
    "one of five missing": {"Airport_fee": None},
    "reversed": {"tpep_dropoff_datetime": dt.datetime(2025, 1, 6, 8, 0)},
    "dropoff missing": {"tpep_dropoff_datetime": None},
    "refund": {"fare_amount": -10.0},
    "refund without distance": {"fare_amount": -10.0, "trip_distance": 0.0},
    "airport fee negative": {"Airport_fee": -1.25},
    "both locations unknown": {"PULocationID": 900, "DOLocationID": 901},
    "one location unknown": {"PULocationID": 900},
    "location missing": {"PULocationID": None, "DOLocationID": 901},
}

ZONES_CSV = '''"LocationID","Borough","Zone","service_zone"
1,"Harbour","North Pier","Port"
2,"Eastside"," Mill Pond ","Outer"
4,"Centre","Clock Square","Inner"
56,"Eastside","Twin Hill","Outer"
57,"Eastside","Twin Hill","Outer"
264,"Unknown","N/A","N/A"
265,"N/A","Outside","N/A"
'''


def month_frame(spark, year, month, count, drift="bigint", ids="bigint", stray=None):
    """``count`` trips of a month at the width of the monthly files; ``stray`` dates the first."""
    rows = []
    for i in range(count):
        start = dt.datetime(year, month, 1 + i % 28, i % 24, 5)
        if i == 0 and stray is not None:
            start = stray
        rows.append(
            (
                start,
                start + dt.timedelta(minutes=10),
                1.5,
                [1, 4, 56, 57][i % 4],
                2,
                [1, 2, 1][i % 3],
                10.0 + i,
                [2.0, 0.0, -1.0][i % 3],
                12.0 + i,
                [1, 2, 99][i % 3],
                1 + i % 4,
            )
        )
    ddl = """tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz,
        trip_distance double, pulocationid bigint, dolocationid bigint, payment_type bigint,
        fare_amount double, tip_amount double, total_amount double, ratecodeid bigint,
        passenger_count bigint"""
    df = spark.createDataFrame(rows, ddl)
    for name in ("ratecodeid", "passenger_count"):
        df = df.withColumn(name, df[name].cast(drift))
    for name in ("pulocationid", "dolocationid"):
        df = df.withColumn(name, df[name].cast(ids))
    return df


# (year, month), trips, drift type, location id type: the months on either side of each change
MONTHS = [
    ((2022, 12), 5, "double", "bigint"),
    ((2023, 1), 6, "double", "bigint"),
    ((2023, 2), 7, "bigint", "int"),
    ((2024, 3), 8, "bigint", "int"),
    ((2027, 1), 9, "bigint", "int"),  # outside the declared range
]


def write_layout(spark, base, months=MONTHS, stray=None):
    for (year, month), count, drift, ids in months:
        folder = f"{base}/year={year}/month={month:02d}"
        month_frame(spark, year, month, count, drift, ids, stray).coalesce(1).write.parquet(folder)


def write_published(spark, base, months=MONTHS):
    """Monthly files with the month at the end of their name."""
    for (year, month), count, drift, ids in months:
        month_frame(spark, year, month, count, drift, ids).coalesce(1).write.parquet(
            f"{base}/trips_{year}-{month:02d}.parquet"
        )
