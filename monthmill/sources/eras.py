"""Eras found in the files: runs of months whose footers agree on the columns that change type.

A type may return after months of another one, so a signature is no range of months. Months in order are cut
into islands of one signature; each island becomes an era that `fact_trips` reads, whatever the declared ones say.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from monthmill.fixed_values import DRIFT_COLUMNS, STABLE_COLUMNS
from monthmill.schemas import PARTITION_DDL
from monthmill.sources.files import footer_columns, partition_files

#: Types of footers that Spark reads as each type that eras are declared with. Narrower ones widen on reading.
READ_AS = {
    "double": "double",
    "float": "double",
    "int64": "bigint",
    "int32": "bigint",
    "int16": "bigint",
    "int8": "bigint",
    "string": "string",
    "large_string": "string",
}
ABSENT = "absent"


@dataclass(frozen=True)
class FoundEra:
    """A run of months, both ends included, and the type of each column that drifts; a column that no file of the run has is
    read as nulls."""

    name: str
    first: tuple[int, int]
    last: tuple[int, int]
    types: tuple[tuple[str, str], ...]

    @property
    def ddl(self) -> str:
        drift = "".join(f", {name} {kind}" for name, kind in self.types)
        return f"{STABLE_COLUMNS}{drift}, {PARTITION_DDL}"

    def covers(self, year: int, month: int) -> bool:
        return self.first <= (year, month) <= self.last


def month_signatures(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """year, month, files, signatures: the distinct signatures of a month's files, of which there should be one.

    A signature names the given columns (all columns if none are given) in any case and their types, in the order given, so that
    files that only order or spell them otherwise agree; a column that is not there is ``absent``.
    """
    columns = [name.lower() for name in (DRIFT_COLUMNS if columns is None else columns)]
    found = footer_columns(files).withColumn("column", F.lower("column")).filter(F.col("column").isin(columns))
    types = [F.first(F.when(F.col("column") == name, F.col("type")), ignorenulls=True) for name in columns]
    texts = [F.concat(F.lit(f"{name} "), F.coalesce(kind, F.lit(ABSENT))) for name, kind in zip(columns, types)]
    per_file = found.groupBy("path").agg(F.concat_ws(", ", *texts).alias("signature"))
    none = ", ".join(f"{name} {ABSENT}" for name in columns)
    signature = F.coalesce("signature", F.lit(none))
    return (
        files.select("path", "year", "month")
        .join(per_file, "path", "left")
        .groupBy("year", "month")
        .agg(F.count("*").alias("files"), F.sort_array(F.collect_set(signature)).alias("signatures"))
    )


def schema_islands(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """island, signature, first_month, last_month, months, files: runs of months of one signature, in order.

    Months that are not there end no run. A month whose files differ is an island of its own, with all its signatures. The windows
    are over months, twelve a year.
    """
    month = F.col("year") * 100 + F.col("month")
    months = month_signatures(files, columns).select(month.alias("at"), "files", F.concat_ws(" | ", "signatures").alias("signature"), (F.size("signatures") > 1).alias("mixed"))
    order = Window.orderBy("at")
    before = F.lag("signature").over(order)
    starts = before.isNull() | (before != F.col("signature")) | F.col("mixed")
    numbered = months.withColumn("island", F.sum(starts.cast("int")).over(order))
    return numbered.groupBy("island", "signature").agg(
        F.min("at").alias("first_month"), F.max("at").alias("last_month"), F.count("*").alias("months"), F.sum("files").alias("files")
    )


def found_eras(spark: SparkSession, base: str, columns: list[str] | None = None) -> list[FoundEra]:
    """The islands of a partitioned table as eras, in order: a few rows, which plans need on the driver.

    Raises for a month whose files differ and for a type that no era can be declared with.
    """
    columns = [name.lower() for name in (DRIFT_COLUMNS if columns is None else columns)]
    rows = schema_islands(partition_files(spark, base), columns).orderBy("island").collect()
    found = [(row, [part.rsplit(" ", 1)[1] for part in row.signature.split(", ")]) for row in rows if " | " not in row.signature]
    if mixed := [row for row in rows if " | " in row.signature]:
        raise ValueError("months whose files differ: " + "; ".join(f"{row.first_month}: {row.signature}" for row in mixed))
    for row, kinds in found:
        if unknown := [kind for kind in kinds if kind not in READ_AS and kind != ABSENT]:
            raise ValueError(f"months from {row.first_month} have columns of type {unknown}")
    known = [next((READ_AS[kinds[i]] for _, kinds in found if kinds[i] != ABSENT), "double") for i in range(len(columns))]
    return [
        FoundEra(
            f"{row.first_month}_{row.last_month}",
            divmod(row.first_month, 100),
            divmod(row.last_month, 100),
            tuple((name, READ_AS.get(kind, other)) for name, kind, other in zip(columns, kinds, known)),
        )
        for row, kinds in found
    ]
