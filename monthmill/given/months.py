"""Queries over months that land, change and drift: found eras, the ledger, the manifest, the star's versions, the stored view."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.fixed_values import RATE_CODES
from monthmill.functions.dates import date_key, seconds_of_day
from monthmill.given import tables as given
from monthmill.given.loads import kept
from monthmill.operators.brackets import describe_bracketed
from monthmill.operators.cleaning import write_cleaned
from monthmill.operators.keys import foreign_keys_at_once
from monthmill.operators.profile import profile
from monthmill.operators.sets import first_per_key_by_place
from monthmill.plans import landing
from monthmill.plans.fact import fact_trips, narrow_fact
from monthmill.plans.ledger import refresh_by_ledger
from monthmill.plans.manifest import read_manifest
from monthmill.plans.profiles import range_profile, store_profiles, stored_profiles
from monthmill.plans.rollup import rebuild_rollup
from monthmill.plans.star import Link, StarError, reload_star
from monthmill.plans.stored import store_fact_view
from monthmill.plans.warehouse import load_staging, read_table
from monthmill.schemas import Era
from monthmill.session import scratch_path
from monthmill.sources.calendar import wide_calendar
from monthmill.sources.eras import found_eras, schema_islands
from monthmill.sources.files import partition_files
from monthmill.sources.lookups import code_list, inline_relation

ALL_YEARS = Era("all", given.YEARS, (1, 12), "double")

#: First month and types of the two drift columns from then on; the first pair returns.
RETURNING = [(199501, "double", "double"), (199607, "bigint", "double"), (199801, "double", "double"), (199804, "bigint", "bigint")]
ARROW = {"double": "double", "bigint": "int64"}

REPLACED_YEAR = 1997
LAST_LANDED_FIRST = 1998


# --- eras ------------------------------------------------------------------------------------


def land_months(months: DataFrame, base: str) -> None:
    """Months become partitions, in place of those of the same name."""
    padded = months.withColumn("month", F.format_string("%02d", "month"))
    rows = padded.hint("rebalance", F.col("year"), F.col("month"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").parquet(base)


def returning_months(spark: SparkSession, sf_dir: str) -> str:
    """Path of monthly files in which a type comes back after months of another."""
    base, months = scratch_path(spark, "returning"), given.monthly_trips(spark, sf_dir, ALL_YEARS)
    at = F.col("year") * 100 + F.col("month")
    ends = [first for first, *_ in RETURNING[1:]] + [999999]
    for (first, rate, count), end in zip(RETURNING, ends):
        span = months.filter((at >= first) & (at < end))
        land_months(span.withColumns({"ratecodeid": F.col("ratecodeid").cast(rate), "passenger_count": F.col("passenger_count").cast(count)}), base)
    return base


def islands(spark, sf_dir) -> DataFrame:
    return schema_islands(partition_files(spark, returning_months(spark, sf_dir))).drop("files")


def found_era_fact(spark, sf_dir) -> DataFrame:
    """The fact through eras that nobody declared."""
    base = returning_months(spark, sf_dir)
    fact = fact_trips(spark, base, found_eras(spark, base))
    return fact.groupBy("year", "month", "rate_code_id").agg(F.count("*").alias("trips"), F.sum("passenger_count").alias("passengers"))


# --- ledger ----------------------------------------------------------------------------------


def _ledger_runs(spark: SparkSession, sf_dir: str) -> tuple[str, list[tuple]]:
    """Path of a rollup after four runs, and what each found: months land, with a year that is not whole; that year is
    replaced; the other months land; nothing happens."""
    base, rollup, ledger = (scratch_path(spark, name) for name in ("landed", "rollup", "ledger"))
    months = given.monthly_trips(spark, sf_dir, ALL_YEARS)
    early = months.filter(F.col("year") <= LAST_LANDED_FIRST)
    steps = [
        early.filter((F.col("year") != REPLACED_YEAR) | (F.col("passenger_count") < 4)),
        months.filter(F.col("year") == REPLACED_YEAR),
        months.filter(F.col("year") > LAST_LANDED_FIRST),
        None,
    ]
    runs = []
    for run, landed in enumerate(steps, 1):
        if landed is not None:
            land_months(landed, base)
        found = {row.status: row for row in refresh_by_ledger(spark, base, rollup, ledger).collect()}
        trips = found["added"].trips + found["replaced"].trips
        runs.append((run, found["added"].months, found["removed"].months, trips))
    return rollup, runs


def ledger_rollup(spark, sf_dir) -> DataFrame:
    """The rollup that files have contributed to one by one, some of them replaced."""
    rollup, _ = _ledger_runs(spark, sf_dir)
    return spark.read.schema(given.ROLLUP_DDL.replace("payment_type string", "payment_type bigint")).parquet(rollup)


def ledger_runs(spark, sf_dir) -> DataFrame:
    """run, added_months, removed_months, trips_read: each run reads the trips of the months that changed."""
    _, runs = _ledger_runs(spark, sf_dir)
    return inline_relation(spark, runs, "run int, added_months bigint, removed_months bigint, trips_read bigint")


def rollup_rebuilt_over(spark, sf_dir) -> DataFrame:
    """A rollup built over an existing one that has another year: what was there before is gone."""
    path, trips = scratch_path(spark, "rollup"), given.trips(spark, sf_dir, located=True)
    rebuild_rollup(trips.withColumn("year", F.col("year") + 10), path)
    rebuild_rollup(trips, path)
    return spark.read.schema(given.ROLLUP_DDL).parquet(path)


# --- landing with a manifest, one product of two -----------------------------------------------


def _products(spark: SparkSession, sf_dir: str) -> str:
    """Path of published months of two products: all trips, and those of one passenger. Their folders are named
    ``published=<product>_1995-01.parquet``."""
    path, months = scratch_path(spark, "products"), given.monthly_trips(spark, sf_dir, ALL_YEARS)
    for product, rows in (("trips", months), ("single", months.filter(F.col("passenger_count") == 1))):
        name = F.format_string(f"{product}_%d-%02d.parquet", "year", "month")
        named = rows.withColumn("published", name).drop("year", "month")
        named.hint("rebalance", F.col("published")).write.mode("append").partitionBy("published").parquet(path)
    return path


def landing_by_manifest(spark, sf_dir) -> DataFrame:
    """What the manifest holds of each month after two runs over one product, and how the second run found it."""
    source, target, manifest = _products(spark, sf_dir), scratch_path(spark, "landed"), scratch_path(spark, "manifest")
    landing.backfill(spark, source, target, "1995-2001", prefix="published=trips", manifest=manifest)
    again = landing.backfill(spark, source, target, "1995-2001", prefix="published=trips", manifest=manifest)
    held = read_manifest(spark, manifest).select("year", "month", "source_trips", "trips")
    return again.join(held, ["year", "month"], "left")


def landed_product(spark, sf_dir) -> DataFrame:
    """Trips per month of the product that was picked by its name."""
    source, target = _products(spark, sf_dir), scratch_path(spark, "landed")
    landing.catch_up(spark, source, target, dt.date(2002, 1, 15), lookback=84, prefix="published=single")
    return narrow_fact(spark, target).groupBy("year", "month").agg(F.count("*").alias("trips"), F.sum("fare_amount").cast("decimal(20,2)").cast("double").alias("fares"))


# --- star and stored view --------------------------------------------------------------------


def _star(spark: SparkSession, sf_dir: str, events: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Events as a fact with two times of day, and its four dimensions."""
    after = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("event_id") % 90_000).cast("decimal(18,6)"))
    events = events.withColumn("ended", F.col("ts") + after)
    fact = events.select(
        date_key(F.col("ts")).alias("pickup_date_key"),
        seconds_of_day(F.col("ts")).alias("pickup_time"),
        date_key(F.col("ended")).alias("dropoff_date_key"),
        seconds_of_day(F.col("ended")).alias("dropoff_time"),
        (F.col("user_id") % 25).cast("long").alias("pickup_location_id"),
        (F.col("event_id") % 25).cast("long").alias("dropoff_location_id"),
        F.col("event_type").alias("payment_type"),
        (F.col("user_id") % 6 + 1).cast("int").alias("rate_code_id"),
        F.col("value").alias("fare_amount"),
    )
    kinds = given.table(spark, sf_dir, "events").select(F.col("event_type").alias("payment_type")).distinct()
    return fact, {
        "dim_date": wide_calendar(events.select("ts"), events.select("ended")),
        "dim_location": given.dim_location(spark, sf_dir),
        "dim_payment": kinds.withColumn("payment_description", F.upper("payment_type")),
        "dim_rate_code": code_list(spark, RATE_CODES, "rate_code_id int, rate_code_description string"),
    }


STAR_KEYS = {"dim_date": "date_key", "dim_location": "location_id", "dim_payment": "payment_type", "dim_rate_code": "rate_code_id"}
STAR_LINKS = [
    Link("pickup_date_key", "dim_date", "date_key"), Link("dropoff_date_key", "dim_date", "date_key"),
    Link("pickup_location_id", "dim_location", "location_id"), Link("dropoff_location_id", "dim_location", "location_id"),
    Link("payment_type", "dim_payment", "payment_type"), Link("rate_code_id", "dim_rate_code", "rate_code_id"),
]


def star_reload(spark, sf_dir) -> DataFrame:
    """A star of four dimensions, loaded with half a month, reloaded whole, then left alone by a load whose keys repeat."""
    space, events = f"star_{uuid.uuid4().hex}", given.table(spark, sf_dir, "events")
    early = events.filter(F.col("ts") < F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz"))
    for some in (early, events):
        reload_star(spark, space, *_star(spark, sf_dir, some), STAR_KEYS, STAR_LINKS)
    fact, dimensions = _star(spark, sf_dir, early)
    try:
        reload_star(spark, space, fact, dimensions | {"dim_payment": dimensions["dim_payment"].union(dimensions["dim_payment"])}, STAR_KEYS, STAR_LINKS)
    except StarError as error:
        refused = len(error.violations)
    return kept(
        spark.sql(
            f"""SELECT borough, payment_description, rate_code_description, is_weekend, COUNT(*) AS trips, SUM(pickup_time) AS began,
                SUM(dropoff_time) AS ended, {refused} AS refused
            FROM {space}.fact_trips LEFT JOIN {space}.dim_date ON date_key = pickup_date_key
                LEFT JOIN {space}.dim_location ON location_id = pickup_location_id LEFT JOIN {space}.dim_payment USING (payment_type)
                LEFT JOIN {space}.dim_rate_code USING (rate_code_id)
            GROUP BY borough, payment_description, rate_code_description, is_weekend"""
        ),
        f"DROP DATABASE IF EXISTS {space} CASCADE",
    )


def stored_view(spark, sf_dir) -> DataFrame:
    """The fact of all eras by its name, asked in another session than the one that stored it."""
    space = f"view_{uuid.uuid4().hex}"
    view = store_fact_view(spark, space, given.month_layout(spark, sf_dir), given.ERAS)
    rows = spark.newSession().sql(
        f"""SELECT year, month, rate_code_id, COUNT(*) AS trips, SUM(passenger_count) AS passengers, MAX(pickup_date_key) AS last_day
        FROM {view} GROUP BY year, month, rate_code_id"""
    )
    return kept(rows, f"DROP DATABASE IF EXISTS {space} CASCADE")


# --- profiles of months ----------------------------------------------------------------------

PROFILED = (199607, 199903)


def profile_range(spark, sf_dir) -> DataFrame:
    """The profile of some months from the stored sketches, and whether each distinct count is within its bounds of the exact one."""
    fact = fact_trips(spark, given.month_layout(spark, sf_dir), given.ERAS)
    fact = fact.withColumn("rate_code_id", F.when(F.col("passenger_count") != 3, F.col("rate_code_id"))).drop("pickup_time", "dropoff_time")
    path, ym = scratch_path(spark, "profiles"), F.col("year") * 100 + F.col("month")
    store_profiles(fact, path)
    some = range_profile(stored_profiles(spark, path).filter(ym.between(*PROFILED)))
    exact = profile(fact.filter(ym.between(*PROFILED)).drop("year", "month")).select("column", F.col("unique_count").alias("exact"))
    return some.join(exact, "column").select(
        "column", "n_rows", "missing_count", "missing_pct", "negative_count", "least", "greatest",
        F.col("exact").between(F.col("unique_low"), F.col("unique_high")).alias("within_bounds"),
    )


def fk_check_at_once(spark, sf_dir) -> DataFrame:
    """All constraints of a schema with each table scanned once, children that are parents of others among them."""
    read = {name: given.table(spark, sf_dir, name) for name in ("lineitem", "orders", "supplier", "part", "customer", "labels", "nation")}
    asia = given.dim_location(spark, sf_dir).filter(F.col("borough") == "ASIA")
    return foreign_keys_at_once(
        [
            ("item_order", read["lineitem"], "l_orderkey", read["orders"], "o_orderkey"),
            ("item_part", read["lineitem"], "l_partkey", read["part"], "p_partkey"),
            ("item_supplier", read["lineitem"], "l_suppkey", read["supplier"], "s_suppkey"),
            ("order_customer", read["orders"], "o_custkey", read["customer"], "c_custkey"),
            ("order_label", read["orders"], "o_orderkey", read["labels"], "doc_id"),
            ("supplier_nation", read["supplier"], "s_nationkey", read["nation"], "n_nationkey"),
            ("supplier_asia", read["supplier"], "s_nationkey", asia, "location_id"),
        ]
    )


def cleaned_and_audited(spark, sf_dir) -> DataFrame:
    """A month written clean, with the counts of its steps from the same job, next to the rows that are in the files."""
    zones = given.dim_location(spark, sf_dir).filter(F.col("borough").isin("ASIA", "EUROPE"))
    path = scratch_path(spark, "cleaned")
    audit = write_cleaned(given.raw_month(spark, sf_dir), zones, path)
    return audit.crossJoin(F.broadcast(spark.read.parquet(path).agg(F.count("*").alias("rows_written"), F.sum("Dropoff_time").alias("seconds"))))


def staging_whole(spark, sf_dir) -> DataFrame:
    """Every column of the line items, staged under a tidied name and read back whole."""
    items = given.table(spark, sf_dir, "lineitem")
    name = f"staging_{uuid.uuid4().hex}"
    load_staging(items.toDF(*[f" {column.upper().replace('_', ' ')}? " for column in items.columns]), name)
    return kept(read_table(spark, name), f"DROP TABLE IF EXISTS {name}")


def describe_in_two_scans(spark, sf_dir) -> DataFrame:
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax".split()
    report = describe_bracketed(given.table(spark, sf_dir, "lineitem"), names)
    return report.withColumns({name: F.round(F.col(name), places) for name, places in (("mean", 9), ("std", 6), ("q25", 6), ("q50", 6), ("q75", 6))})


def dedupe_by_place(spark, sf_dir) -> DataFrame:
    """The first shipment of each order line, whole, found by key, order and place."""
    items = given.table(spark, sf_dir, "lineitem")
    return first_per_key_by_place(items, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


MONTHS = {
    "dedupe_by_place": dedupe_by_place,
    "describe_in_two_scans": describe_in_two_scans,
    "cleaned_and_audited": cleaned_and_audited,
    "staging_whole": staging_whole,
    "fk_check_at_once": fk_check_at_once,
    "profile_range": profile_range,
    "schema_islands": islands,
    "found_era_fact": found_era_fact,
    "ledger_rollup": ledger_rollup,
    "ledger_runs": ledger_runs,
    "rollup_rebuilt_over": rollup_rebuilt_over,
    "landing_by_manifest": landing_by_manifest,
    "landed_product": landed_product,
    "star_reload": star_reload,
    "stored_view": stored_view,
}

_YM = "CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER)"
_TYPED = "\n".join(
    f"WHEN ym >= {first} THEN 'ratecodeid {ARROW[rate]}, passenger_count {ARROW[count]}'" for first, rate, count in reversed(RETURNING)
)
_MONTH = "CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month"
_RATES = ", ".join(f"({code}, '{text}')" for code, text in RATE_CODES)
_SECONDS = "CAST(hour({0}) * 3600 + minute({0}) * 60 + second({0}) AS BIGINT)"
_BY_RATE = f"""SELECT {_MONTH}, CAST(ascii(l_linestatus) AS BIGINT) AS rate_code_id, COUNT(*) AS trips,
    CAST(SUM(l_linenumber) AS BIGINT) AS passengers"""

_FACT_COLUMNS = {
    "pickup_date_key": "CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)", "pickup_location_id": "s_nationkey", "dropoff_location_id": "l_suppkey",
    "payment_type": "ascii(l_returnflag)", "rate_code_id": "CASE WHEN l_linenumber <> 3 THEN ascii(l_linestatus) END",
    "passenger_count": "l_linenumber", "trip_distance": "l_quantity", "fare_amount": "l_extendedprice", "tip_amount": "l_discount",
    "total_amount": "l_extendedprice + l_discount + l_tax",
}

_CONSTRAINTS = [
    ("item_order", "lineitem", "l_orderkey", "SELECT o_orderkey FROM orders"), ("item_part", "lineitem", "l_partkey", "SELECT p_partkey FROM part"),
    ("item_supplier", "lineitem", "l_suppkey", "SELECT s_suppkey FROM supplier"), ("order_customer", "orders", "o_custkey", "SELECT c_custkey FROM customer"),
    ("order_label", "orders", "o_orderkey", "SELECT doc_id FROM labels"), ("supplier_nation", "supplier", "s_nationkey", "SELECT n_nationkey FROM nation"),
    ("supplier_asia", "supplier", "s_nationkey", "SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'"),
]

MONTHS_ORACLE = {
    "dedupe_by_place": """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) = 1""",
    "staging_whole": "SELECT * FROM lineitem",
    "fk_check_at_once": " UNION ALL ".join(
        f"""SELECT '{name}' AS constraint_name, COUNT(DISTINCT {key}) AS orphan_keys, COUNT(*) AS orphan_rows FROM {table}
        WHERE {key} IS NOT NULL AND {key} NOT IN ({parent})"""
        for name, table, key, parent in _CONSTRAINTS
    ),
    "profile_range": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", COUNT(*) AS n_rows, COUNT(*) - COUNT({value}) AS missing_count,
            ROUND(100.0::DOUBLE * (COUNT(*) - COUNT({value})) / COUNT(*), 2) AS missing_pct, COUNT(*) FILTER ({value} < 0) AS negative_count,
            CAST(MIN({value}) AS DOUBLE) AS least, CAST(MAX({value}) AS DOUBLE) AS greatest, TRUE AS within_bounds
        FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey WHERE {_YM} BETWEEN {PROFILED[0]} AND {PROFILED[1]}"""
        for name, value in _FACT_COLUMNS.items()
    ),
    "schema_islands": f"""WITH months AS (SELECT DISTINCT {_YM} AS ym FROM lineitem),
        typed AS (SELECT ym, CASE {_TYPED} END AS signature FROM months),
        marked AS (SELECT *, CASE WHEN lag(signature) OVER (ORDER BY ym) = signature THEN 0 ELSE 1 END AS starts FROM typed),
        numbered AS (SELECT *, CAST(SUM(starts) OVER (ORDER BY ym) AS BIGINT) AS island FROM marked)
        SELECT island, signature, MIN(ym) AS first_month, MAX(ym) AS last_month, COUNT(*) AS months FROM numbered GROUP BY 1, 2""",
    "found_era_fact": f"{_BY_RATE} FROM lineitem GROUP BY 1, 2, 3",
    "ledger_runs": f"""WITH m AS (SELECT {_MONTH}, l_linenumber FROM lineitem),
        runs AS (SELECT 1 AS run, year, month, COUNT(*) AS trips FROM m
            WHERE year <= {LAST_LANDED_FIRST} AND (year <> {REPLACED_YEAR} OR l_linenumber < 4) GROUP BY ALL
          UNION ALL SELECT 2, year, month, COUNT(*) FROM m WHERE year = {REPLACED_YEAR} GROUP BY ALL
          UNION ALL SELECT 3, year, month, COUNT(*) FROM m WHERE year > {LAST_LANDED_FIRST} GROUP BY ALL)
        SELECT r.run, COUNT(year) AS added_months, CASE WHEN r.run = 2 THEN (SELECT COUNT(*) FROM runs b WHERE b.run = 1 AND year = {REPLACED_YEAR})
            ELSE 0 END AS removed_months, CAST(COALESCE(SUM(trips), 0) AS BIGINT) AS trips_read
        FROM (SELECT CAST(x AS INTEGER) AS run FROM range(1, 5) t(x)) r LEFT JOIN runs USING (run) GROUP BY r.run""",
    "landing_by_manifest": f"""WITH shipped AS (SELECT {_MONTH}, COUNT(*) AS n FROM lineitem GROUP BY ALL),
        grid AS (SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM range(1995, 2002) a(y), range(1, 13) b(m))
        SELECT year, month, CASE WHEN n IS NULL THEN 'unpublished' ELSE 'skipped' END AS status, n AS source_trips, n AS trips
        FROM grid LEFT JOIN shipped USING (year, month)""",
    "landed_product": f"""SELECT {_MONTH}, COUNT(*) AS trips, CAST(CAST(SUM(l_extendedprice) AS DECIMAL(20, 2)) AS DOUBLE) AS fares
        FROM lineitem WHERE l_linenumber = 1 GROUP BY 1, 2""",
    "star_reload": f"""WITH rates(rate_code_id, rate_code_description) AS (VALUES {_RATES}),
        places AS (SELECT n_nationkey AS id, r_name AS borough FROM nation JOIN region ON r_regionkey = n_regionkey),
        trips AS (SELECT *, ts + to_seconds(event_id % 90000) AS ended FROM events)
        SELECT borough, upper(event_type) AS payment_description, rate_code_description, isodow(ts) > 5 AS is_weekend, COUNT(*) AS trips,
            CAST(SUM({_SECONDS.format("ts")}) AS BIGINT) AS began, CAST(SUM({_SECONDS.format("ended")}) AS BIGINT) AS ended, 1 AS refused
        FROM trips LEFT JOIN places ON id = user_id % 25 LEFT JOIN rates ON rate_code_id = user_id % 6 + 1 GROUP BY 1, 2, 3, 4""",
    "stored_view": f"""{_BY_RATE}, MAX(CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER)) AS last_day
        FROM lineitem GROUP BY 1, 2, 3""",
}
