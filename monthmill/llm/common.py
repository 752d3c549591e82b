"""Helpers of the operators: intermediate tables, hash expressions, sizes of joins."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

#: White space of the contracts, as a Java and RE2 character class: blank, tab, line feed, vertical tab, form feed, return.
SPACE = r"[\x20\x09-\x0D]"
#: A word is a run of anything else.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a table that may be broadcast, as it was counted before the join.
BROADCAST_ROWS = 1 << 17

#: Rows of a batch that a task has as Python objects at once: whole batches of texts would double what a worker holds.
SLICE_ROWS = 256

_written: dict[str, list[str]] = {}
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors once for an application, so that tasks in Python can import it there."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if context.applicationId in _shipped or not package.is_dir():
        return
    archive = f"{tempfile.mkdtemp(prefix='monthmill-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it names none, one in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of a frame, written to the shared folder and read back: lineage ends here and nothing is
    computed twice. The files go when the application ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    application = spark.sparkContext.applicationId
    if application not in _written:
        _written[application] = []
        atexit.register(_remove, spark, application)
    _written[application].append(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, application: str) -> None:
    """Deletes what an application has written, as long as it still runs."""
    context = spark.sparkContext
    if context._jsc is None or context.applicationId != application:
        return
    for path in _written.pop(application, []):
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def sized(df: DataFrame, rows: int | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """A written table as the small side of a join: broadcast if it has at most `most` rows, which are counted
    first; else left to a shuffled join, whose large keys adaptive execution splits."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= most else df


def values_of(column: pa.Array) -> Iterator:
    """A column's values as Python objects, few of which exist at once."""
    for start in range(0, len(column), SLICE_ROWS):
        yield from column.slice(start, SLICE_ROWS).to_pylist()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of batches, as tuples; a batch is let go before the next one comes."""
    for batch in batches:
        yield from zip(*map(values_of, batch.columns))
        del batch


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def id_remainder(n: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % n


def hash_bits(value: Column, digits: int = 12) -> Column:
    """The leading hexadecimal digits (15 at most) of the MD5 of a text, as a number: the same in every engine."""
    return F.conv(F.substring(F.md5(value), 1, digits), 16, 10).cast("long")


def quoted(name: str) -> str:
    """A column's name as Spark reads it whole, with dots or other signs in it."""
    return "`" + name.replace("`", "``") + "`"


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(quoted(name)) for name in df.columns]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns (maps aside, which have no hash), that ends an order of rows: rows that are still equal are alike."""
    return F.xxhash64(*[F.col(quoted(field.name)) for field in df.schema if not isinstance(field.dataType, MapType)])


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame doesn't have, whatever its other columns are called."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted
