"""Namespaces, tables, views and reports: where results are put."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.functions.names import tidy_columns

FACT = "fact_trips"


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def write_table(df: DataFrame, path: str) -> None:
    """A new parquet table; fails when there is something at the path."""
    df.write.mode("errorifexists").parquet(path)


def write_partitioned(df: DataFrame, path: str, partitions: list[str]) -> None:
    """The same by partition; the columns are found by name, wherever they stand."""
    rows = df.hint("rebalance", *[F.col(name) for name in partitions])
    rows.write.mode("errorifexists").partitionBy(*partitions).parquet(path)


def create_view(df: DataFrame, name: str) -> None:
    """A view over a lazy frame: nothing is stored, and filters on it reach its scans."""
    df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """The result of a query as a frame that can be filtered and aggregated further."""
    return spark.sql(text)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def load_staging(df: DataFrame, table: str) -> None:
    """Replaces a staging table, column names tidied."""
    tidy_columns(df).write.mode("overwrite").saveAsTable(table)


def drop_star(spark: SparkSession, tables: list[str], fact: str = FACT) -> None:
    """Drops the fact, then the dimensions. The fact is that of the current database unless it is named."""
    for name in [fact, *[name for name in tables if name != fact]]:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_dimensions(dimensions: dict[str, DataFrame]) -> None:
    for name, dimension in dimensions.items():
        dimension.write.mode("overwrite").saveAsTable(name)


def load_fact(fact: DataFrame, table: str = FACT) -> None:
    """Replaces the fact; its times of day are whole seconds since midnight."""
    fact.write.mode("overwrite").saveAsTable(table)


def load_star(spark: SparkSession, fact: DataFrame, dimensions: dict[str, DataFrame]) -> None:
    """Drops the old star and loads the new one, dimensions first."""
    drop_star(spark, list(dimensions))
    load_dimensions(dimensions)
    load_fact(fact)


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one CSV file with a header; only the rows of the result meet in one task."""
    report.repartition(1).write.mode("overwrite").option("header", "true").csv(path)
