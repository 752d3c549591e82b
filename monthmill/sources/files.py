"""Parquet files as a table: which months are there, and with which column types.

Listing goes through the ``binaryFile`` source with its content column left out, so that files are
listed by Spark on any file system and none is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.functions.names import month_file
from monthmill.sources.lookups import inline_relation

# A published month: <prefix>2025-03.parquet, one file or a folder of part files. A landed one:
# year=2025/month=03/ and any file in it.
MONTH_IN_NAME = r"(\d{4})-(\d{2})\.parquet(?:/[^/]*)?$"
PUBLISHED = r"^(.*\d{4}-\d{2}\.parquet)(?:/[^/]*)?$"
MONTH_IN_FOLDER = r"/year=(\d{4})/month=(\d{1,2})/"

LISTING_DDL = "path string, length bigint"


def list_files(spark: SparkSession, base: str, times: bool = False) -> DataFrame:
    """path, length of every parquet file below ``base``; empty when the folder is not there yet.

    With ``times`` also modified, when the file was last written.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet")
            .load(base)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return inline_relation(spark, [], LISTING_DDL + (", modified timestamp" if times else ""))
    modified = [F.col("modificationTime").alias("modified")] if times else []
    return files.select("path", "length", *modified)


def is_written(spark: SparkSession, path: str) -> bool:
    """Are there files of a table? Committers need not leave a mark of their own, so none is looked for."""
    return not list_files(spark, path).isEmpty()


def _with_month(files: DataFrame, pattern: str) -> DataFrame:
    return (
        files.filter(F.col("path").rlike(pattern))
        .withColumn("year", F.regexp_extract("path", pattern, 1).cast("int"))
        .withColumn("month", F.regexp_extract("path", pattern, 2).cast("int"))
    )


def source_files(spark: SparkSession, base: str, prefix: str | None = None) -> DataFrame:
    """Published files with the month their name ends in; with a prefix, only ``<prefix>_2025-03.parquet``."""
    files = _with_month(list_files(spark, base), MONTH_IN_NAME)
    if prefix is None:
        return files
    name = F.element_at(F.split(F.regexp_extract("path", PUBLISHED, 1), "/"), -1)
    return files.filter(name == month_file(prefix, F.col("year"), F.col("month")))


def partition_files(spark: SparkSession, base: str, times: bool = False) -> DataFrame:
    """Files of the partitioned table, the month in the folder."""
    return _with_month(list_files(spark, base, times), MONTH_IN_FOLDER)


def months_of(files: DataFrame) -> DataFrame:
    return files.select("year", "month").distinct()


def month_list(months: DataFrame) -> list[tuple[int, int]]:
    """(year, month) pairs on the driver: path lists and job loops need them. Twelve per year."""
    return sorted((row.year, row.month) for row in months.select("year", "month").collect())


def footer_columns(files: DataFrame) -> DataFrame:
    """path, position, column, type of each column and the file's n_rows, from the footers, on the executors.

    Needs only a ``path`` column; other columns of the listing are not carried.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        # Defined here, so that executors need no module of this package.
        def arrow_uri(path: str) -> str:
            scheme, _, rest = path.partition(":")
            if scheme == "s3a":
                return f"s3:{rest}"
            if scheme == "file" and not rest.startswith("//"):
                return f"file://{rest}"
            return path

        for batch in batches:
            for path in batch["path"]:
                store, key = fs.FileSystem.from_uri(arrow_uri(path))
                with store.open_input_file(key) as handle:
                    file = pq.ParquetFile(handle)
                    schema, n_rows = file.schema_arrow, file.metadata.num_rows
                yield pd.DataFrame(
                    {
                        "path": path,
                        "position": range(len(schema)),
                        "column": schema.names,
                        "type": [str(kind) for kind in schema.types],
                        "n_rows": n_rows,
                    }
                )

    ddl = "path string, position int, column string, type string, n_rows bigint"
    return files.select("path").mapInPandas(read, ddl)


def rows_per_month(files: DataFrame) -> DataFrame:
    """year, month, n_rows of the files together."""
    counts = footer_columns(files).filter("position = 0").select("path", "n_rows")
    return files.join(counts, "path").groupBy("year", "month").agg(F.sum("n_rows").alias("n_rows"))


def file_signatures(files: DataFrame) -> DataFrame:
    """path, signature: the file's columns and types in order, as one text."""
    entry = F.struct("position", F.concat_ws(" ", "column", "type").alias("text"))
    return (
        footer_columns(files)
        .groupBy("path")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select("path", F.concat_ws(", ", "entries.text").alias("signature"))
    )


def signature_summary(files: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Each distinct signature with its files and months; the input for drawing eras.

    ``files`` carries year and month; ``columns`` narrows the comparison to those names (any case).
    """
    found = footer_columns(files)
    if columns is not None:
        found = found.filter(F.lower("column").isin([name.lower() for name in columns]))
    entry = F.struct("position", F.concat_ws(" ", F.lower("column"), "type").alias("text"))
    per_file = (
        found.groupBy("path")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        .select("path", F.concat_ws(", ", "entries.text").alias("signature"))
    )
    month = F.col("year") * 100 + F.col("month")
    return (
        files.join(per_file, "path")
        .groupBy("signature")
        .agg(
            F.count(F.lit(1)).alias("files"),
            F.min(month).alias("first_month"),
            F.max(month).alias("last_month"),
        )
    )
