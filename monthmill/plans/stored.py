"""The fact as a stored view: in the catalog, for every session, over the files where they are.

Each era is a catalog table of its own over the one folder of trips, with the era's types and just the months that belong to it as
partitions. The view is SQL text that unites them, drift columns as bigint. Partition columns pass through, so a filter on
year or month reads only the folders it needs. Months that land later are added by storing the view again.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

from monthmill.plans.fact import fact_shape
from monthmill.plans.warehouse import FACT, create_namespace
from monthmill.schemas import PARTITIONS, TRIP_ERAS, Era
from monthmill.sources.eras import FoundEra
from monthmill.sources.files import MONTH_IN_FOLDER, list_files

RATE, COUNT = "rate_code_id", "passenger_count"


def _months(spark: SparkSession, base: str) -> dict[tuple[int, int], str]:
    """The folder of each month that is there, as it is spelled."""
    found: dict[tuple[int, int], str] = {}
    for row in list_files(spark, base).selectExpr("regexp_replace(path, '/[^/]*$', '') AS folder").distinct().collect():
        if match := re.search(MONTH_IN_FOLDER, f"{row.folder}/"):
            month = int(match[1]), int(match[2])
            if found.setdefault(month, row.folder) != row.folder:
                raise ValueError(f"month {month} has two folders: {found[month]} and {row.folder}")
    return found


def _whole(name: str, kind: str) -> str:
    """A drift column as bigint: doubles to the nearest, NaN as null."""
    return f"CAST(ROUND(NULLIF({name}, DOUBLE('NaN'))) AS BIGINT)" if kind == "double" else f"CAST({name} AS BIGINT)"


def _era_select(spark: SparkSession, table: str) -> str:
    """The fact's columns from an era's table, as SQL text."""
    kinds = dict(spark.table(table).dtypes)
    text = {
        "pickup_time": "tpep_pickup_datetime",
        "dropoff_time": "tpep_dropoff_datetime",
        "pickup_date_key": "CAST(YEAR(tpep_pickup_datetime) * 10000 + MONTH(tpep_pickup_datetime) * 100 + DAY(tpep_pickup_datetime) AS INT)",
        "pickup_location_id": "pulocationid",
        "dropoff_location_id": "dolocationid",
        RATE: _whole("ratecodeid", kinds["ratecodeid"]),
        COUNT: _whole("passenger_count", kinds["passenger_count"]),
    }
    names = fact_shape(spark.table(table)).columns
    return "SELECT " + ", ".join(f"{text.get(name, name)} AS {name}" for name in names) + f" FROM {table}"


def _text(value: str) -> str:
    """A text as an SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _store_era(spark: SparkSession, table: str, base: str, era: Era | FoundEra, folders: dict[tuple[int, int], str]) -> None:
    """A table of the era's columns and months; it only describes files."""
    spark.sql(f"CREATE TABLE {table} ({era.ddl}) USING parquet OPTIONS (path {_text(base)}) PARTITIONED BY ({', '.join(PARTITIONS)})")
    parts = [f"PARTITION (year={year}, month={month}) LOCATION {_text(folder)}" for (year, month), folder in sorted(folders.items())]
    if parts:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(parts)}")


def store_fact_view(spark: SparkSession, namespace: str, base: str, eras: list[Era] | list[FoundEra] = TRIP_ERAS, name: str = FACT) -> str:
    """Stores the fact over the months that are there now, replacing an earlier one; returns the view's full name.

    A month that belongs to no era, or to two, raises, and the earlier view stays.
    """
    base = base.rstrip("/")
    months = _months(spark, base)
    for month in sorted(months):
        covering = [era.name for era in eras if era.covers(*month)]
        if len(covering) != 1:
            raise ValueError(f"month {month[0]}-{month[1]:02d} belongs to {covering or 'no era'}")
    create_namespace(spark, namespace)
    view, version, texts = f"{namespace}.{name}", uuid.uuid4().hex[:12], []
    mine = re.compile(rf"{re.escape(name)}_\w+_[0-9a-f]{{12}}", re.IGNORECASE)
    before = [table.name for table in spark.catalog.listTables(namespace) if mine.fullmatch(table.name) and not table.isTemporary]
    for era in eras:
        folders = {month: folder for month, folder in months.items() if era.covers(*month)}
        table = f"{namespace}.{name}_{era.name}_{version}"
        _store_era(spark, table, base, era, folders)
        texts.append(_era_select(spark, table))
    # The earlier view reads its own tables until this one takes its place.
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS {' UNION ALL '.join(texts)}")
    for table in before:
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{table}")
    return view
