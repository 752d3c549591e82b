"""Queries that write and read back: CSV lookups, code lists, staging, the star by name, views, reports, ids, files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.fixed_values import PAYMENT_TYPES
from monthmill.given import tables as given
from monthmill.operators.joins import join_lookup
from monthmill.operators.quality import month_grid, months_outside
from monthmill.plans import landing, warehouse
from monthmill.plans.fact import with_trip_id
from monthmill.session import scratch_path
from monthmill.sources import lookups, trips


def _zone_csv(spark, sf_dir) -> str:
    """Parts as a zone list in CSV, some texts of which stand for missing values."""
    part, path = given.table(spark, sf_dir, "part"), scratch_path(spark, "zones")
    text = F.when(F.col("p_size") % 5 == 0, "N/A").when(F.col("p_size") % 7 == 0, "NA").otherwise(F.col("p_type"))
    part.select(
        F.col("p_partkey").alias("locationid"), F.col("p_brand").alias("borough"), F.col("p_name").alias("zone"), text.alias("service_zone")
    ).write.option("header", "true").csv(path)
    return path


def zones_csv_text(spark, sf_dir) -> DataFrame:
    return lookups.zones_as_text(spark, _zone_csv(spark, sf_dir))


def zones_csv_nulls(spark, sf_dir) -> DataFrame:
    return lookups.zones_with_nulls(spark, _zone_csv(spark, sf_dir))


def payment_codes(spark, sf_dir) -> DataFrame:
    """Line numbers as payment codes, described by the code list."""
    codes = lookups.code_list(spark, PAYMENT_TYPES, "payment_type int, payment_desc string")
    items = given.table(spark, sf_dir, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("trips"))
    return join_lookup(items, codes, "l_linenumber", "payment_type").select("l_linenumber", "payment_desc", "trips")


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def kept(rows: DataFrame, drop: str) -> DataFrame:
    """Rows written aside, before a statement drops what they were read from."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "kept")
    rows.write.parquet(path)
    spark.sql(drop)
    return spark.read.schema(rows.schema).parquet(path)


def staging_table(spark, sf_dir) -> DataFrame:
    """Line items with untidy names, staged and read back by the tidied ones."""
    items = given.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias(" Order Key"), F.col("l_quantity").alias("Trip Distance (mi)"), F.col("l_returnflag").alias("Payment-Type")
    )
    name = _name("staging")
    warehouse.load_staging(items, name)
    staged = warehouse.read_table(spark, name)
    found = staged.groupBy("paymenttype").agg(F.count("order_key").alias("n_rows"), F.sum("trip_distance_mi").alias("distance"))
    return kept(found, f"DROP TABLE IF EXISTS {name}")


def star_by_name(spark, sf_dir) -> DataFrame:
    """The star loaded as tables and asked by name."""
    fact = given.trips(spark, sf_dir, located=True).select("pickup_location_id", "fare_amount")
    places, loaded = given.dim_location(spark, sf_dir), _name("dim_location")
    warehouse.create_namespace(spark, space := _name("star"))
    warehouse.drop_star(spark, [f"{space}.{loaded}"], f"{space}.fact_trips")
    warehouse.load_dimensions({f"{space}.{loaded}": places})
    warehouse.load_fact(fact, f"{space}.fact_trips")
    found = warehouse.run_sql(
        spark,
        f"""SELECT borough, COUNT(*) AS trips FROM {space}.fact_trips JOIN {space}.{loaded}
            ON location_id = pickup_location_id GROUP BY borough""",
    )
    return kept(found, f"DROP DATABASE IF EXISTS {space} CASCADE")


def view_by_name(spark, sf_dir) -> DataFrame:
    name = _name("trips")
    warehouse.create_view(given.trips(spark, sf_dir), name)
    return warehouse.run_sql(spark, f"SELECT year, COUNT(*) AS trips FROM {name} WHERE trip_distance > 25 GROUP BY year")


def report_csv(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "report")
    flags = given.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count("*").alias("trips"))
    warehouse.write_report(flags, path)
    return spark.read.schema("l_returnflag string, trips bigint").option("header", "true").csv(path)


def trip_ids(spark, sf_dir) -> DataFrame:
    """Ids written with the fact: as many as trips, all different, per year."""
    path = scratch_path(spark, "ids")
    warehouse.write_partitioned(with_trip_id(given.trips(spark, sf_dir)).select("trip_id", "year"), path, ["year"])
    written = spark.read.schema("trip_id bigint, year int").parquet(path)
    return written.groupBy("year").agg(F.count("trip_id").alias("trips"), F.countDistinct("trip_id").alias("ids"))


def whole_file(spark, sf_dir) -> DataFrame:
    """A copy of a table, written as a new one and read as a single file's folder with its own types."""
    path = scratch_path(spark, "orders")
    warehouse.write_table(given.table(spark, sf_dir, "orders"), path)
    return trips.one_file(spark, path)


def _months(df: DataFrame, when: str) -> DataFrame:
    return df.select(F.year(when).alias("year"), F.month(when).alias("month")).distinct()


def _published_and_present(spark, sf_dir):
    return _months(given.table(spark, sf_dir, "lineitem"), "l_shipdate"), _months(given.table(spark, sf_dir, "orders"), "o_orderdate")


def landing_plan_all(spark, sf_dir) -> DataFrame:
    """All months of seven years, without a cap."""
    import datetime as dt

    months = landing.months_before(spark, dt.date(2002, 1, 15), 84)
    return landing.catch_up_plan(months, *_published_and_present(spark, sf_dir))


def coverage_out_of_range(spark, sf_dir) -> DataFrame:
    """Months that are published or present and that a plan of three years doesn't ask for."""
    return months_outside(month_grid(spark, (1996, 1998)), *_published_and_present(spark, sf_dir))


LOADS = {
    "zones_csv_text": zones_csv_text,
    "zones_csv_nulls": zones_csv_nulls,
    "payment_codes": payment_codes,
    "staging_table": staging_table,
    "star_by_name": star_by_name,
    "view_by_name": view_by_name,
    "report_csv": report_csv,
    "trip_ids": trip_ids,
    "whole_file": whole_file,
    "landing_plan_all": landing_plan_all,
    "coverage_out_of_range": coverage_out_of_range,
}

_SERVICE = "CASE WHEN p_size % 5 = 0 THEN {0} WHEN p_size % 7 = 0 THEN {1} ELSE p_type END"
_BOTH = """WITH shipped AS (SELECT DISTINCT year(l_shipdate)::INTEGER AS year, month(l_shipdate)::INTEGER AS month FROM lineitem),
    ordered AS (SELECT DISTINCT year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month FROM orders)"""

LOADS_ORACLE = {
    "zones_csv_text": f"""SELECT p_partkey::VARCHAR AS locationid, p_brand AS borough, p_name AS zone,
        {_SERVICE.format("'N/A'", "'NA'")} AS service_zone FROM part""",
    "zones_csv_nulls": f"""SELECT p_partkey AS locationid, p_brand AS borough, p_name AS zone,
        {_SERVICE.format("NULL", "NULL")} AS service_zone FROM part""",
    "payment_codes": """WITH codes(code, payment_desc) AS (VALUES (0, 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'),
        (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip'))
        SELECT l_linenumber, payment_desc, COUNT(*) AS trips FROM lineitem LEFT JOIN codes ON code = l_linenumber GROUP BY ALL""",
    "staging_table": """SELECT l_returnflag AS paymenttype, COUNT(l_orderkey) AS n_rows, SUM(l_quantity) AS distance
        FROM lineitem GROUP BY 1""",
    "star_by_name": """SELECT r_name AS borough, COUNT(*) AS trips FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1""",
    "view_by_name": "SELECT year(l_shipdate)::INTEGER AS year, COUNT(*) AS trips FROM lineitem WHERE l_quantity > 25 GROUP BY 1",
    "report_csv": "SELECT l_returnflag, COUNT(*) AS trips FROM lineitem GROUP BY 1",
    "trip_ids": "SELECT year(l_shipdate)::INTEGER AS year, COUNT(*) AS trips, COUNT(*) AS ids FROM lineitem GROUP BY 1",
    "whole_file": "SELECT * FROM orders",
    "landing_plan_all": f"""{_BOTH}, grid AS (SELECT y::INTEGER AS year, m::INTEGER AS month FROM range(1995, 2002) a(y), range(1, 13) b(m))
        SELECT year, month, CASE WHEN (year, month) IN (SELECT (year, month) FROM ordered) THEN 'skipped'
            WHEN (year, month) IN (SELECT (year, month) FROM shipped) THEN 'uploaded' ELSE 'unpublished' END AS status FROM grid""",
    "coverage_out_of_range": f"""{_BOTH} SELECT *, 'out_of_range' AS status FROM (SELECT * FROM shipped UNION SELECT * FROM ordered)
        WHERE year NOT BETWEEN 1996 AND 1998""",
}
