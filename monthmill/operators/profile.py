"""Column profiles, negative amounts and duplicate rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthmill.operators.topk import sort_up

_MICROSECONDS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_AS_JSON = {
    "timestampFormat": _MICROSECONDS,
    "timestampNTZFormat": _MICROSECONDS,
    "ignoreNullFields": "false",
}


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, and NaN in floating point columns."""
    test = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        test = test | F.isnan(name)
    return test


def _slot(kind: T.DataType) -> str:
    """Type under which a column's values can be grouped with those of other columns."""
    if isinstance(kind, (T.IntegralType, T.BooleanType, T.DateType, T.TimestampType)):
        return "bigint"
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return "double"
    if isinstance(kind, T.TimestampNTZType):
        return "timestamp_ntz"
    return "string"


def _has_map(kind: T.DataType) -> bool:
    inner = {T.ArrayType: lambda: [kind.elementType], T.StructType: lambda: [field.dataType for field in kind]}
    return isinstance(kind, T.MapType) or any(_has_map(part) for part in inner.get(type(kind), list)())


def _in_order(kind: T.DataType, value: Column) -> Column:
    """A value with its maps, at any depth, as their entries in order, so that equal maps are equal."""
    if not _has_map(kind):
        return value
    if isinstance(kind, T.MapType):
        return F.array_sort(
            F.transform(
                F.map_entries(value),
                lambda entry: F.struct(_in_order(kind.keyType, entry["key"]).alias("key"), _in_order(kind.valueType, entry["value"]).alias("value")),
            )
        )
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _in_order(kind.elementType, item))
    return F.when(value.isNotNull(), F.struct(*[_in_order(field.dataType, value[field.name]).alias(field.name) for field in kind]))


def _slot_value(kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.sha2(name, 256)  # every text alike, whatever its length
    if isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        return F.sha2(F.to_json(_in_order(kind, F.col(name)), _AS_JSON), 256)
    return F.col(name).cast(_slot(kind))


def profile(df: DataFrame) -> DataFrame:
    """column, dtype, missing_count, missing_pct, unique_count; a missing value counts as a value.

    One scan: cells become (position, value) rows that are counted before the shuffle, so columns
    with few values shrink to as many rows and a frequent value to one. Distinct counts are exact.
    """
    slots = sorted({_slot(field.dataType) for field in df.schema})
    cells = []
    for i, field in enumerate(df.schema):
        own, value = _slot(field.dataType), _slot_value(field.dataType, field.name)
        if own == "double":
            value = F.nullif(value, F.lit(float("nan")))
        values = [(value if s == own else F.lit(None).cast(s)).alias(f"as_{s}") for s in slots]
        cells.append(F.struct(F.lit(i).alias("pos"), *values))
    names = [f"as_{s}" for s in slots]
    values = df.select(F.inline(F.array(*cells))).groupBy("pos", *names)
    values = values.agg(F.count("*").alias("n"))
    missing = reduce(and_, [F.col(name).isNull() for name in names])
    counted = values.groupBy("pos").agg(
        F.sum("n").alias("total"),
        F.sum(F.when(missing, F.col("n")).otherwise(0)).alias("missing_count"),
        F.count("*").alias("unique_count"),
    )
    return _with_names(df, counted)


def quick_profile(df: DataFrame, relative_error: float = 0.05) -> DataFrame:
    """The same report with approximate distinct counts, in one aggregate of fixed size."""
    parts = [F.count("*").alias("total")]
    for i, name in enumerate(df.columns):
        missing = is_missing(df, name)
        distinct = F.approx_count_distinct(F.when(~missing, F.col(name)), relative_error)
        parts.append(F.count_if(missing).alias(f"missing_{i}"))
        parts.append((distinct + F.coalesce(F.max(missing.cast("int")), F.lit(0))).cast("long").alias(f"unique_{i}"))
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"),
                F.col("total"),
                F.col(f"missing_{i}").alias("missing_count"),
                F.col(f"unique_{i}").alias("unique_count"),
            )
            for i in range(len(df.columns))
        ]
    )
    return _with_names(df, df.agg(*parts).select(F.inline(rows)))


def _with_names(df: DataFrame, counted: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(name) for name in df.columns])
    kinds = F.array(*[F.lit(field.dataType.simpleString()) for field in df.schema])
    share = F.try_divide(F.lit(100.0) * F.col("missing_count"), F.col("total"))
    # Every column has its row, also where there are no cells to count.
    places = df.sparkSession.range(0, len(df.columns), 1, 1).select(F.col("id").cast("int").alias("pos"))
    return places.join(counted, "pos", "left").select(
        names[F.col("pos")].alias("column"),
        kinds[F.col("pos")].alias("dtype"),
        F.coalesce("missing_count", F.lit(0)).cast("long").alias("missing_count"),
        F.round(share, 2).alias("missing_pct"),
        F.coalesce("unique_count", F.lit(0)).cast("long").alias("unique_count"),
    )


def columns_with_missing(report: DataFrame) -> DataFrame:
    return report.filter(F.col("missing_count") > 0).orderBy(
        F.desc_nulls_last("missing_count"), F.asc_nulls_last("column")
    )


def columns_without_missing(report: DataFrame) -> DataFrame:
    return sort_up(report.filter(F.col("missing_count") == 0).select("column"), "column")


def missing_counts(df: DataFrame) -> DataFrame:
    """column, missing_count for the columns that have missing values, in one aggregate."""
    counts = {name: F.count_if(is_missing(df, name)) for name in df.columns}
    return _unpivot(df, counts, "missing_count").filter(F.col("missing_count") > 0)


def negative_columns(df: DataFrame) -> DataFrame:
    """column, negative_count for the numeric columns that hold a negative value."""
    counts = {
        field.name: F.count_if(F.col(field.name) < 0)
        for field in df.schema
        if isinstance(field.dataType, T.NumericType)
    }
    return _unpivot(df, counts, "negative_count").filter(F.col("negative_count") > 0)


def _unpivot(df: DataFrame, counts: dict[str, Column], out: str) -> DataFrame:
    """One aggregate row turned into one row per entry."""
    wide = df.agg(*[count.alias(f"c{i}") for i, count in enumerate(counts.values())])
    rows = [
        F.struct(F.lit(name).alias("column"), F.col(f"c{i}").alias(out))
        for i, name in enumerate(counts)
    ]
    return wide.select(F.inline(F.array(*rows)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """total_rows and duplicate_rows: how many repeat an earlier row in every column.

    Copies are counted before the shuffle; texts are compared by SHA-256, maps by their entries.
    """
    keys = []
    for field in df.schema:
        kind, name = field.dataType, field.name
        value = F.col(name)
        if isinstance(kind, (T.StringType, T.BinaryType)):
            value = _slot_value(kind, name)
        elif isinstance(kind, T.MapType):
            value = _entries(name)
        keys.append(value.alias(name))
    copies = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    return copies.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("duplicate_rows"),
    )
