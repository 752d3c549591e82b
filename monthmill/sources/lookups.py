"""Small relations: the zone list and the code lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.fixed_values import MISSING_TEXT
from monthmill.schemas import ZONES_DDL


def zones_as_text(spark: SparkSession, path: str) -> DataFrame:
    """The zone list with every column a string; a literal ``N/A`` stays."""
    return spark.read.option("header", "true").schema(ZONES_DDL).csv(path)


def text_as_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null for the texts that stand for a missing value."""
    for name in columns:
        df = df.withColumn(name, F.when(~F.col(name).isin(MISSING_TEXT), F.col(name)))
    return df


def zones_with_nulls(spark: SparkSession, path: str) -> DataFrame:
    """The zone list with numeric id and nulls for the texts that mean missing."""
    zones = zones_as_text(spark, path)
    known = text_as_missing(zones, zones.columns)
    return known.withColumn("locationid", F.col("locationid").cast("long"))


def inline_relation(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few rows as a table, through SQL ``VALUES``.

    Spark knows the size of such a relation, and so broadcasts it; of one made from Python rows it
    does not, and would shuffle the fact to join it.
    """
    if not rows:
        return spark.createDataFrame([], ddl).limit(0)  # planned as an empty relation
    values = ", ".join(f"({', '.join(_literal(value) for value in row)})" for row in rows)
    columns = [column.split() for column in ddl.split(",")]
    casts = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    names = ", ".join(name for name, _ in columns)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS inline_rows({names})")


def _literal(value: int | str | None) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, int):
        return str(value)
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def code_list(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A mapping of codes to texts as a table, sorted by code."""
    return inline_relation(spark, sorted(rows), ddl)
