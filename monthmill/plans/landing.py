"""Landing of monthly files under ``year=YYYY/month=MM/``.

Which months to land is a join of three small sets: the months asked for, those published, those
present. Landing the same months again changes nothing, except that a month with fewer rows than its
published file, which an interrupted run has left, is landed whole.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthmill.functions.names import year_range
from monthmill.operators.joins import absent_from
from monthmill.operators.quality import month_grid, month_status, months_outside
from monthmill.plans.manifest import known_months, listed_months, read_manifest, record_months
from monthmill.sources.lookups import inline_relation
from monthmill.sources.files import (
    MONTH_IN_NAME,
    PUBLISHED,
    file_signatures,
    months_of,
    partition_files,
    rows_per_month,
    source_files,
)

LOOKBACK_MONTHS = 12


def months_before(spark: SparkSession, today: dt.date, lookback: int = LOOKBACK_MONTHS) -> DataFrame:
    """The last ``lookback`` months before the current one, which is never published."""
    first = F.trunc(F.lit(today), "month")
    back = F.explode(F.sequence(F.lit(1), F.lit(lookback))).alias("back")
    months = spark.range(0, 1 if lookback > 0 else 0, 1, 1).select(first.alias("first"), back)
    day = F.add_months("first", -F.col("back"))
    return months.select(F.year(day).alias("year"), F.month(day).alias("month"))


def one_month(spark: SparkSession, year: int, month: int) -> DataFrame:
    return inline_relation(spark, [(year, month)], "year int, month int")


def backfill_plan(
    spark: SparkSession, years: str, published: DataFrame, present: DataFrame
) -> DataFrame:
    """Status of every month of ``"2021-2025"`` or ``"2025"``."""
    return month_status(month_grid(spark, year_range(years)), published, present)


def catch_up_plan(
    months: DataFrame, published: DataFrame, present: DataFrame, cap: int | None = None
) -> DataFrame:
    """Status of the given months; with a cap on uploads, newest first until it is reached.

    Months after the last allowed upload are not looked at in this run: ``not_reached``. The window
    is over the months asked for, twelve by default.
    """
    if cap is None:
        return month_status(months, published, present)
    newest = Window.orderBy(F.desc("year"), F.desc("month"))
    before = newest.rowsBetween(Window.unboundedPreceding, -1)
    upload = (F.col("status") == "uploaded").cast("int")
    done = F.coalesce(F.sum(upload).over(before), F.lit(0))
    status = F.when(done >= cap, "not_reached").otherwise(F.col("status"))
    return month_status(months, published, present).withColumn("status", status)


def status_totals(plan: DataFrame) -> DataFrame:
    return plan.agg(
        *[
            F.count_if(F.col("status") == name).alias(name)
            for name in ("uploaded", "skipped", "unpublished")
        ]
    )


def land(
    spark: SparkSession, source: str, target: str, plan: DataFrame, prefix: str | None = None
) -> None:
    """Writes the files of the months marked uploaded, every column with the type it came with.

    ``prefix`` picks one product of several in the folder; a month with two candidates raises.

    Files are grouped by the column types in their footers, as one scan cannot mix them, and each
    group is one job that splits large files over many tasks without a shuffle. Where folders are not
    renamed in one step, an interrupted run may leave part of a month, which counts as missing.
    """
    wanted = plan.filter(F.col("status") == "uploaded").select("year", "month")
    files = source_files(spark, source, prefix).join(wanted, ["year", "month"], "left_semi")
    published = F.regexp_extract("path", PUBLISHED, 1).alias("published")
    months = (
        files.join(file_signatures(files), "path")
        .groupBy("year", "month")
        .agg(F.collect_set("signature").alias("signatures"), F.collect_set(published).alias("paths"))
    )
    groups: dict[str, list[str]] = {}
    for row in months.collect():  # one row per month, however many files it has
        if len(row.paths) > 1:
            raise ValueError(f"{row.year}-{row.month:02d} is published as {sorted(row.paths)}")
        if len(row.signatures) > 1:
            raise ValueError(f"files of {row.year}-{row.month:02d} differ in their column types")
        groups.setdefault(row.signatures[0], []).extend(row.paths)
    path = F.col("_metadata.file_path")
    for paths in groups.values():
        (
            spark.read.parquet(*sorted(paths))
            .withColumn("year", F.regexp_extract(path, MONTH_IN_NAME, 1))
            .withColumn("month", F.regexp_extract(path, MONTH_IN_NAME, 2))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("year", "month")
            .parquet(target)
        )


def present_months(asked: DataFrame, published: DataFrame, landed: DataFrame) -> DataFrame:
    """Months of the landed files, less those asked for that hold fewer rows than their published files."""
    keys = ["year", "month"]
    wanted = rows_per_month(published.join(asked, keys, "left_semi"))
    there = rows_per_month(landed.join(asked, keys, "left_semi")).withColumnRenamed("n_rows", "n_landed")
    short = there.join(wanted, keys).filter(F.col("n_landed") < F.col("n_rows"))
    return absent_from(months_of(landed), short.select(*keys), keys)


def present_by_manifest(spark: SparkSession, asked: DataFrame, published: DataFrame, landed: DataFrame, manifest: str) -> DataFrame:
    """The same months as `present_months` finds, with footers read only where the manifest doesn't tell."""
    months = listed_months(published, landed).join(asked, ["year", "month"], "left_semi")
    known = known_months(months, read_manifest(spark, manifest))
    open_ = absent_from(asked, known, ["year", "month"])
    # One row per month; a join of small listings, so that no job over footers is planned where nothing is open.
    both = months.filter("source_files is not null and landed_files is not null")
    rows = [tuple(row) for row in open_.join(both, ["year", "month"], "left_semi").select("year", "month").collect()]
    if not rows:
        return months_of(landed)
    return present_months(inline_relation(spark, rows, "year int, month int"), published, landed)


def backfill(
    spark: SparkSession,
    source: str,
    target: str,
    years: str,
    dry_run: bool = False,
    prefix: str | None = None,
    manifest: str | None = None,
) -> DataFrame:
    """Lands the missing months of the given years; returns what was done, or would be, and the months
    that are published or present outside these years. With a manifest, months that it knows are not looked into again."""
    files = source_files(spark, source, prefix)
    asked = month_grid(spark, year_range(years))
    published, present = months_of(files), _present(spark, asked, files, partition_files(spark, target), manifest)
    plan = month_status(asked, published, present)
    return _run(spark, source, target, plan, published, present, dry_run, prefix, manifest)


def catch_up(
    spark: SparkSession,
    source: str,
    target: str,
    today: dt.date,
    lookback: int = LOOKBACK_MONTHS,
    cap: int | None = None,
    month: tuple[int, int] | None = None,
    prefix: str | None = None,
    manifest: str | None = None,
) -> DataFrame:
    """Lands recent missing months, or just the one named; returns all months asked for, those that a
    cap left for the next run as ``not_reached``, and the months published or present beside them."""
    files = source_files(spark, source, prefix)
    months = one_month(spark, *month) if month else months_before(spark, today, lookback)
    published, present = months_of(files), _present(spark, months, files, partition_files(spark, target), manifest)
    plan = catch_up_plan(months, published, present, cap)
    return _run(spark, source, target, plan, published, present, False, prefix, manifest)


def _present(spark: SparkSession, asked: DataFrame, files: DataFrame, landed: DataFrame, manifest: str | None) -> DataFrame:
    if manifest is None:
        return present_months(asked, files, landed)
    return present_by_manifest(spark, asked, files, landed, manifest)


def _run(
    spark: SparkSession,
    source: str,
    target: str,
    plan: DataFrame,
    published: DataFrame,
    present: DataFrame,
    dry_run: bool,
    prefix: str | None,
    manifest: str | None = None,
) -> DataFrame:
    plan = plan.unionByName(months_outside(plan, published, present))
    # The plan is fixed before anything lands, or it would see its own results: one row per month.
    rows = [tuple(row) for row in plan.select("year", "month", "status").collect()]
    fixed = inline_relation(spark, rows, "year int, month int, status string")
    if not dry_run:
        land(spark, source, target, fixed, prefix)
        if manifest is not None:
            _record(spark, source, target, fixed, prefix, manifest)
    return fixed


def _record(spark: SparkSession, source: str, target: str, done: DataFrame, prefix: str | None, manifest: str) -> None:
    """Rows of the manifest for months just landed, and for those found present whose rows are missing or no longer agree."""
    files, landed = source_files(spark, source, prefix), partition_files(spark, target)
    there = done.filter(F.col("status").isin("uploaded", "skipped")).select("year", "month")
    listed = listed_months(files, landed).filter("source_files is not null and landed_files is not null")
    known = known_months(listed, read_manifest(spark, manifest))
    new = absent_from(there.join(listed, ["year", "month"], "left_semi"), known, ["year", "month"])
    rows = [tuple(row) for row in new.select("year", "month").collect()]
    if rows:
        record_months(spark, manifest, inline_relation(spark, rows, "year int, month int"), files, landed)
