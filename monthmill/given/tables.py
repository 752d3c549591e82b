"""The given tables seen as trips, zones, calendars and monthly files.

A line item is a trip: shipped is picked up, price is fare, discount is tip, return flag is payment
type, line status is rate code. Its zone is the supplier's nation, its borough the region. Suppliers
and orders grow with the line items, so their joins are left to Spark, which broadcasts below its
size threshold and otherwise shuffles, splitting hot keys at run time. Events stand in where the
hour of the day matters.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.functions.dates import date_key
from monthmill.operators.joins import join_lookup
from monthmill.plans.rollup import rebuild_rollup
from monthmill.schemas import Era
from monthmill.session import scratch_path
from monthmill.sources.calendar import lakehouse_calendar, wide_calendar
from monthmill.sources.files import is_written
from monthmill.sources.lookups import inline_relation

CARD = "R"
CARD_CODE = 82  # the same flag as a number, for layouts whose payment type is bigint
YEARS = (1995, 2001)
CALENDAR = (dt.date(1995, 1, 1), dt.date(2000, 12, 31))  # ends before the data does

ERAS = [
    Era("1995_1996", (1995, 1996), (1, 12), "double"),
    Era("1997_jan", (1997, 1997), (1, 1), "double"),
    Era("1997_rest", (1997, 1997), (2, 12), "bigint"),
    Era("1998_onward", (1998, 2001), (1, 12), "bigint"),
]


# Declared, so that no query starts with a job that reads a footer to infer them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,
        l_quantity double, l_extendedprice double, l_discount double, l_tax double,
        l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _shipped_in(
    items: DataFrame, years: tuple[int, int] | None, month: int | None = None
) -> DataFrame:
    """A range on the timestamp itself reaches the parquet scan; one on its year would not.

    ``month`` narrows a range of one year.
    """
    if years is None:
        return items
    first, end = dt.datetime(years[0], 1, 1), dt.datetime(years[1] + 1, 1, 1)
    if month is not None and years[0] == years[1]:
        first = first.replace(month=month)
        end = end if month == 12 else first.replace(month=month + 1)
    lower, upper = (F.lit(day).cast("timestamp_ntz") for day in (first, end))
    return items.filter((F.col("l_shipdate") >= lower) & (F.col("l_shipdate") < upper))


def trips(
    spark: SparkSession,
    sf_dir: str,
    years: tuple[int, int] | None = None,
    located: bool = False,
    month: int | None = None,
) -> DataFrame:
    """Line items as the fact; ``located`` adds the zone, which costs a join."""
    items = _shipped_in(table(spark, sf_dir, "lineitem"), years, month)
    place = []
    if located:
        suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        items = join_lookup(items, suppliers, "l_suppkey", "s_suppkey")
        place = [F.col("s_nationkey").cast("long").alias("pickup_location_id")]
    when = F.col("l_shipdate")
    return items.select(
        when.alias("pickup_time"),
        date_key(when).alias("pickup_date_key"),
        *place,
        F.col("l_returnflag").alias("payment_type"),
        F.col("l_linestatus").alias("rate_code_id"),
        F.col("l_linenumber").cast("long").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        (F.col("l_extendedprice") + F.col("l_discount") + F.col("l_tax")).alias("total_amount"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
    )


_WRITTEN: dict[tuple[str, str, str], str] = {}
_WRITING = threading.Lock()


def _written_once(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]
) -> str:
    """Path of a table in the shared folder that an application writes when it is first wanted."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    with _WRITING:
        path = _WRITTEN.get(key)
        if path is None or not is_written(spark, path):
            path = scratch_path(spark, label)
            write(path)
            _WRITTEN[key] = path
    return path


ROLLUP_DDL = """
    pickup_date_key int, pickup_location_id bigint, payment_type string, trips bigint,
    tipped_trips bigint, total_fare double, total_tip double, total_revenue double,
    total_distance double, year int
"""


def daily_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rollup as a table by year, written once; a filter on year reads that year's files."""

    def write(path: str) -> None:
        rebuild_rollup(trips(spark, sf_dir, located=True), path)

    path = _written_once(spark, sf_dir, "daily", write)
    return spark.read.schema(ROLLUP_DDL).parquet(path)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips with a time of day."""
    when = F.col("ts")
    return table(spark, sf_dir, "events").select(
        when.alias("pickup_time"),
        date_key(when).alias("pickup_date_key"),
        F.col("event_type").alias("payment_type"),
        F.col("value").alias("fare_amount"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
    )


def dim_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    named = join_lookup(nations, regions, "n_regionkey", "r_regionkey", "inner")
    return named.select(
        F.col("n_nationkey").cast("long").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
    )


def dim_payment(spark: SparkSession, text: str = "payment_desc") -> DataFrame:
    rows = [("A", "Cash"), ("N", "No charge"), ("R", "Credit card")]
    return inline_relation(spark, rows, f"payment_type string, {text} string")


def dim_rate_code(spark: SparkSession) -> DataFrame:
    """Leaves out one of the two codes in use, so that left joins have something to keep."""
    return inline_relation(
        spark, [("F", "Standard rate")], "rate_code_id string, rate_code_desc string"
    )


def dim_date(spark: SparkSession) -> DataFrame:
    return lakehouse_calendar(spark, *CALENDAR)


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_calendar(table(spark, sf_dir, "events").select("ts"))


def zone_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as an all-text zone list: repeated ids, outer spaces, a text that means missing."""
    service = F.when(F.col("p_type") == "SMALL", "N/A").otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select(
        F.col("p_size").cast("string").alias("locationid"),
        F.col("p_brand").alias("borough"),
        F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("zone"),
        service.alias("service_zone"),
        F.col("p_partkey").alias("line"),
    )


def _with_ends(spark: SparkSession, sf_dir: str, labelled: bool = False) -> DataFrame:
    """Line items with their order, customer and supplier, and the order's label if wanted.

    Orders are completed with their customers first, so that line items are shuffled once on the order
    key and meet one side that has everything.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus"
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    if labelled:
        labels = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
        orders = join_lookup(orders, labels, "o_orderkey", "doc_id")
    orders = join_lookup(orders, customers, "o_custkey", "c_custkey")
    items = table(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey"), "left"
    )
    return join_lookup(items, suppliers, "l_suppkey", "s_suppkey")


def raw_ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations, distance and fare of an incoming month; a customer in debt makes a refund."""
    sign = F.when(F.col("c_acctbal") < 0, -1.0).otherwise(1.0)
    return _with_ends(spark, sf_dir).select(
        F.col("l_linenumber").alias("VendorID"),
        (F.col("l_quantity") - 3.0).alias("trip_distance"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        (F.col("l_extendedprice") * sign).alias("fare_amount"),
        F.col("l_extendedprice").alias("total_amount"),
    )


def raw_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items at the full width of an incoming month.

    Labels, found for some orders only, supply the columns that are missing together; a trip starts
    at the order and ends at the shipment.
    """
    items = _with_ends(spark, sf_dir, labelled=True)
    labelled = F.col("quality").isNotNull()
    sign = F.when(F.col("c_acctbal") < 0, -1.0).otherwise(1.0)
    return items.select(
        F.col("l_linenumber").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        F.col("quality").cast("double").alias("passenger_count"),
        (F.col("l_quantity") - 3.0).alias("trip_distance"),
        F.col("toxic").cast("double").alias("RatecodeID"),
        F.when(labelled, F.col("o_orderstatus")).alias("store_and_fwd_flag"),
        F.col("s_nationkey").alias("PULocationID"),
        F.col("c_nationkey").alias("DOLocationID"),
        F.ascii("l_returnflag").cast("long").alias("payment_type"),
        (F.col("l_extendedprice") * sign).alias("fare_amount"),
        F.lit(0.5).alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.lit(0.0).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"),
        F.when(labelled & (F.col("toxic") == 0), F.col("l_tax")).alias("congestion_surcharge"),
        F.when(labelled, F.col("l_linenumber") - 2.0).alias("Airport_fee"),
        F.col("l_discount").alias("cbd_congestion_fee"),
    )


def monthly_trips(spark: SparkSession, sf_dir: str, era: Era) -> DataFrame:
    """Line items with the columns of the monthly files of one era."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    items = _shipped_in(table(spark, sf_dir, "lineitem"), era.years)
    items = items.filter(F.month("l_shipdate").between(*era.months))
    items = join_lookup(items, suppliers, "l_suppkey", "s_suppkey")
    when = F.col("l_shipdate")
    hours = F.make_dt_interval(F.lit(0), F.col("l_quantity").cast("int"))
    return items.select(
        when.alias("tpep_pickup_datetime"),
        (when + hours).alias("tpep_dropoff_datetime"),
        F.col("l_quantity").alias("trip_distance"),
        F.col("s_nationkey").cast("long").alias("pulocationid"),
        F.col("l_suppkey").alias("dolocationid"),
        F.ascii("l_returnflag").cast("long").alias("payment_type"),
        F.ascii("l_linestatus").cast(era.drift_type).alias("ratecodeid"),
        F.col("l_linenumber").cast(era.drift_type).alias("passenger_count"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.col("l_discount").alias("tip_amount"),
        (F.col("l_extendedprice") + F.col("l_discount") + F.col("l_tax")).alias("total_amount"),
        F.year(when).alias("year"),
        F.month(when).alias("month"),
    )


def month_layout(spark: SparkSession, sf_dir: str) -> str:
    """Path of the monthly files as a partitioned table whose drift columns change type by era."""

    def write(path: str) -> None:
        for era in ERAS:
            padded = F.format_string("%02d", "month")
            months = monthly_trips(spark, sf_dir, era).withColumn("month", padded)
            _write_by(months, path, ["year", "month"])

    return _written_once(spark, sf_dir, "months", write)


def published_months(spark: SparkSession, sf_dir: str) -> str:
    """Path of the monthly files as published: one name per month, types changing by era."""

    def write(path: str) -> None:
        for era in ERAS:
            name = F.format_string("%d-%02d.parquet", "year", "month")
            months = monthly_trips(spark, sf_dir, era).withColumn("published", name)
            _write_by(months.drop("year", "month"), path, ["published"])

    return _written_once(spark, sf_dir, "published", write)


def _write_by(months: DataFrame, path: str, partitions: list[str]) -> None:
    rows = months.hint("rebalance", *[F.col(name) for name in partitions])
    rows.write.mode("append").partitionBy(*partitions).parquet(path)
