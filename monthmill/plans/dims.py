"""The dimensions, in the two variants in use (they differ in columns and in some values)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.fixed_values import FILL_TEXT, PAYMENT_TYPES, RATE_CODE_99, RATE_CODES
from monthmill.operators.sets import first_per_key
from monthmill.schemas import PAYMENT_TEXT, RATE_CODE_TEXT
from monthmill.sources.lookups import code_list, text_as_missing

LOCATION_TEXT = ["borough", "zone", "service_zone"]


def location_lakehouse(zones: DataFrame) -> DataFrame:
    """From the all-text zone list: numeric id, texts as they are, rows without id dropped."""
    return zones.filter(F.col("locationid").isNotNull()).select(
        F.col("locationid").cast("long").alias("location_id"), *LOCATION_TEXT
    )


def location_notebook(zones: DataFrame, order: list[str]) -> DataFrame:
    """Texts trimmed, missing ones filled, one row per id: the first in ``order``."""
    named = zones.withColumnsRenamed({"locationid": "location_id"})
    named = named.withColumn("location_id", F.col("location_id").cast("long"))
    tidy = text_as_missing(named, LOCATION_TEXT)
    for name in LOCATION_TEXT:
        tidy = tidy.withColumn(name, F.trim(name))
    tidy = tidy.fillna(FILL_TEXT, LOCATION_TEXT)
    kept = first_per_key(tidy, ["location_id"], order)
    return kept.select("location_id", *LOCATION_TEXT).orderBy(F.asc_nulls_last("location_id"))


def payment(spark: SparkSession, variant: str = "lakehouse") -> DataFrame:
    return code_list(spark, PAYMENT_TYPES, f"payment_type bigint, {PAYMENT_TEXT[variant]} string")


def rate_code(spark: SparkSession, variant: str = "lakehouse") -> DataFrame:
    rows = [*RATE_CODES, (99, RATE_CODE_99[variant])]
    return code_list(spark, rows, f"rate_code_id bigint, {RATE_CODE_TEXT[variant]} string")
