"""The rollup kept by a ledger: what each file of the trips has contributed, so that a refresh reads only what changed.

The ledger has two tables below its path, both partitioned by year and month of the file: ``sums``, the additive measures of each file by
rollup keys, and ``files``, name, length, modification time and trips of each file that is counted. A run lists
the files and compares them with ``files``. New and rewritten ones are read, their sums take the place of what the same file
contributed before, those of files that are gone leave, and the partitions of the rollup that this touches are summed up from
``sums`` again, which holds a row per file and group and not per trip.

A run writes sums, then rollup, then files. One that fails in between leaves its files unlisted: the next run sees them as
changed and replaces their sums, so nothing counts twice. Two runs at a time are not provided for.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.functions.measures import count_where, rounded_sum, tipped_positive
from monthmill.plans.fact import fact_shape
from monthmill.plans.rollup import write_rollup
from monthmill.schemas import NARROW_DDL, ROLLUP_KEYS, ROLLUP_MEASURES
from monthmill.session import scratch_path
from monthmill.sources.files import partition_files
from monthmill.sources.lookups import inline_relation

MONTH = ["year", "month"]
FILE = [*MONTH, "file"]

FILES_DDL = "file string, length bigint, modified bigint, trips bigint, year int, month int"
SUMS_DDL = """file string, pickup_date_key int, pickup_location_id bigint, payment_type bigint, trips bigint,
    tipped_trips bigint, total_fare double, total_tip double, total_revenue double, total_distance double, year int, month int"""
RUN_DDL = "status string, files bigint, months bigint, trips bigint"


def _held(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    try:
        return spark.read.schema(ddl).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ddl)


def contributions(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    """Unrounded sums by file, rollup keys, year and month. A group within a file is reduced before it is shuffled."""
    trips = spark.read.schema(NARROW_DDL).option("basePath", base).parquet(*paths)
    return fact_shape(trips.withColumn("file", F.col("_metadata.file_name")), also=("file",)).groupBy("file", *ROLLUP_KEYS, *MONTH).agg(
        F.count("*").alias("trips"),
        count_where(tipped_positive()).alias("tipped_trips"),
        F.sum("fare_amount").alias("total_fare"),
        F.sum("tip_amount").alias("total_tip"),
        F.sum("total_amount").alias("total_revenue"),
        F.sum("trip_distance").alias("total_distance"),
    )


def rollup_of_sums(sums: DataFrame, partitions: tuple[str, ...] = ("year",)) -> DataFrame:
    """The rollup that the files' contributions add up to: the same rows as from the trips themselves."""
    counts = [F.sum(name).alias(name) for name in ROLLUP_MEASURES[:2]]
    amounts = [rounded_sum(name).alias(name) for name in ROLLUP_MEASURES[2:]]
    return sums.groupBy(*ROLLUP_KEYS, *partitions).agg(*counts, *amounts).select(*ROLLUP_KEYS, *ROLLUP_MEASURES, *partitions)


def file_changes(spark: SparkSession, base: str, ledger: str) -> DataFrame:
    """year, month, file, path, length, modified, status of every file listed or counted: added, replaced, removed or kept."""
    name, written = F.element_at(F.split("path", "/"), -1), F.unix_micros("modified")
    there = partition_files(spark, base, times=True).withColumn("file", name).withColumn("modified", written)
    known = _held(spark, f"{ledger}/files", FILES_DDL).select(*FILE, F.col("length").alias("__length"), F.col("modified").alias("__modified"))
    same = (F.col("length") == F.col("__length")) & (F.col("modified") == F.col("__modified"))
    status = F.when(F.col("__length").isNull(), "added").when(F.col("length").isNull(), "removed").when(same, "kept").otherwise("replaced")
    return there.join(known, FILE, "full").select(*FILE, "path", "length", "modified", status.alias("status"))


def _in_months(months: list[tuple[int, int]]):
    """A filter of literals, so that partitions are pruned when the scan is planned."""
    hit = F.lit(False)
    for year in sorted({year for year, _ in months}):
        hit = hit | ((F.col("year") == year) & F.col("month").isin([m for y, m in months if y == year]))
    return hit


def _replace_partitions(rows: DataFrame, path: str, partitions: list[str], touched: list[tuple]) -> None:
    """Partitions that `touched` names become those of `rows`; those that have no rows are deleted."""
    left = {tuple(row) for row in rows.select(*partitions).distinct().collect()}
    spread = rows.hint("rebalance", *[F.col(name) for name in partitions])
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    writer.parquet(path)
    _delete_partitions(rows.sparkSession, path, partitions, [values for values in touched if values not in left])


def _delete_partitions(spark: SparkSession, path: str, partitions: list[str], values: list[tuple]) -> None:
    context = spark.sparkContext
    for row in values:
        folder = "/".join(f"{name}={value}" for name, value in zip(partitions, row))
        place = context._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


def refresh_by_ledger(spark: SparkSession, base: str, rollup: str, ledger: str, partitions: tuple[str, ...] = ("year",)) -> DataFrame:
    """Brings the rollup up to date with the files below `base`; returns what the run found.

    status, files, months, trips: how many files were added, replaced, removed and kept, in how many months, and the trips of those
    that were read. A run that finds no change writes nothing.
    """
    ledger = ledger.rstrip("/")
    # Paths and months of changed files come to the driver, which lists all files for a scan anyway.
    found = [row.asDict() for row in file_changes(spark, base, ledger).collect()]
    changed = [row for row in found if row["status"] != "kept"]
    trips: dict[tuple, int] = {}
    if changed:
        trips = _apply(spark, base, rollup, ledger, partitions, found, changed)
    rows = []
    for status in ("added", "replaced", "removed", "kept"):
        of_status = [row for row in found if row["status"] == status]
        counted = sum(trips.get(tuple(row[name] for name in FILE), 0) for row in of_status)
        rows.append((status, len(of_status), len({(row["year"], row["month"]) for row in of_status}), counted))
    return inline_relation(spark, rows, RUN_DDL)


def _apply(spark, base, rollup, ledger, partitions, found, changed) -> dict[tuple, int]:
    months = sorted({(row["year"], row["month"]) for row in changed})
    changes = spark.createDataFrame([tuple(row[name] for name in FILE) for row in changed], "year int, month int, file string")
    held = _held(spark, f"{ledger}/sums", SUMS_DDL).filter(_in_months(months)).join(changes, FILE, "left_anti")
    paths = sorted(row["path"] for row in changed if row["path"] is not None)
    sums = held.unionByName(contributions(spark, base, paths)) if paths else held
    # Written aside first: a table cannot be read and replaced at once, and the trips are read only once.
    aside = scratch_path(spark, "ledger")
    sums.write.parquet(aside)
    sums = spark.read.schema(sums.schema).parquet(aside)
    _replace_partitions(sums, f"{ledger}/sums", MONTH, months)

    touched = sorted({tuple(dict(zip(MONTH, month))[name] for name in partitions) for month in months})
    hit = _in_months(months) if "month" in partitions else F.col("year").isin(sorted({year for year, _ in months}))
    fresh = rollup_of_sums(_held(spark, f"{ledger}/sums", SUMS_DDL).filter(hit), partitions)
    write_rollup(fresh, rollup, partitions)
    still = {tuple(row) for row in fresh.select(*partitions).distinct().collect()}
    _delete_partitions(spark, rollup, list(partitions), [values for values in touched if values not in still])

    counted = {tuple(row[name] for name in FILE): row["n"] for row in sums.groupBy(*FILE).agg(F.sum("trips").alias("n")).collect()}
    listed = [
        (row["file"], row["length"], row["modified"], counted.get(tuple(row[name] for name in FILE), 0), row["year"], row["month"])
        for row in found
        if (row["year"], row["month"]) in set(months) and row["status"] != "removed"
    ]
    _replace_partitions(spark.createDataFrame(listed, FILES_DDL), f"{ledger}/files", MONTH, months)
    read = {tuple(row[name] for name in FILE) for row in changed if row["status"] != "removed"}
    return {file: n for file, n in counted.items() if file in read}
