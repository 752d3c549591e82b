"""Manifest of landed months: what was found in each when it was last landed or looked at.

One row per month and time: files and bytes of the published month and of the landed one, trips, column types, and when it was written. The
last row of a month counts. A month whose listing still agrees with its row is known to be there without any
footer being read; footers are read for the other months only. Rows are written after a month's commit, so that an
interrupted landing leaves no row.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthmill.sources.files import file_signatures, footer_columns

MONTH = ["year", "month"]
FOUND = ["source_files", "source_bytes", "landed_files", "landed_bytes"]
MANIFEST_DDL = """year int, month int, source_files bigint, source_bytes bigint, landed_files bigint, landed_bytes bigint,
    source_trips bigint, trips bigint, signature string, written timestamp, run string"""


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The last row of each month."""
    try:
        rows = spark.read.schema(MANIFEST_DDL).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_DDL)
    last = Window.partitionBy(*MONTH).orderBy(F.desc("written"), F.desc("run"))
    return rows.withColumn("__place", F.row_number().over(last)).filter("__place = 1").drop("__place")


def _listed(files: DataFrame, side: str) -> DataFrame:
    return files.groupBy(*MONTH).agg(F.count("*").alias(f"{side}_files"), F.sum("length").alias(f"{side}_bytes"))


def listed_months(published: DataFrame, landed: DataFrame) -> DataFrame:
    """year, month, files and bytes on both sides, from listings."""
    return _listed(published, "source").join(_listed(landed, "landed"), MONTH, "full")


def known_months(months: DataFrame, manifest: DataFrame) -> DataFrame:
    """Months landed whole, as their rows say, whose listings are still the same on both sides."""
    rows = manifest.filter(F.col("trips") >= F.col("source_trips")).select(*MONTH, *[F.col(name).alias(f"__{name}") for name in FOUND])
    same = F.lit(True)
    for name in FOUND:
        same = same & (F.col(name) == F.col(f"__{name}"))
    return months.join(rows, MONTH).filter(same).select(*MONTH)


def _rows_and_types(files: DataFrame, trips: str) -> DataFrame:
    counts = footer_columns(files).filter("position = 0").select("path", "n_rows")
    return files.join(counts, "path").groupBy(*MONTH).agg(F.sum("n_rows").alias(trips))


def record_months(spark: SparkSession, path: str, months: DataFrame, published: DataFrame, landed: DataFrame) -> None:
    """Appends a row for each of the given months that is on both sides, from its footers as they are now."""
    ours, theirs = (files.join(months.select(*MONTH), MONTH, "left_semi") for files in (landed, published))
    types = ours.join(file_signatures(ours), "path").groupBy(*MONTH).agg(F.concat_ws(" | ", F.sort_array(F.collect_set("signature"))).alias("signature"))
    rows = (
        listed_months(theirs, ours)
        .join(_rows_and_types(theirs, "source_trips"), MONTH)
        .join(_rows_and_types(ours, "trips"), MONTH)
        .join(types, MONTH)
        .withColumn("written", F.current_timestamp())
        .withColumn("run", F.lit(uuid.uuid4().hex))
    )
    names = [part.split()[0] for part in MANIFEST_DDL.split(",")]
    rows.select(*names).coalesce(1).write.mode("append").parquet(path)
