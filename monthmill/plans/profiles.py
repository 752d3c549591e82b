"""Column profiles of any range of months, from a table of sketches and not from the trips.

A landed month is profiled once: per column its rows, missing and negative values, least and greatest number, a sketch of distinct
values (HyperLogLog) and, for numbers, one of ranks (KLL). Counts add up and sketches merge, so the profile of a range is an aggregate of
one row per month and column. Counts, least and greatest are exact; distinct counts and quartiles have the bounds below.

Values are hashed before they are sketched, so that a column has one kind of sketch whatever its type; numbers of equal value in
columns whose type changes between months are one value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthmill.operators.profile import is_missing

#: Bits of a distinct sketch: 2^LG_K registers. Three standard errors of its estimate.
LG_K = 14
DISTINCT_BOUND = 3 * 1.04 / 2 ** (LG_K / 2)
#: Size of a rank sketch. A quartile's rank is off by less than this share of the rows in 99 of 100 cases.
RANK_K = 800
RANK_BOUND = 0.004

MONTH = ["year", "month"]
STORE_DDL = """column string, dtype string, n_rows bigint, missing_count bigint, negative_count bigint, least double, greatest double,
    total double, distinct_sketch binary, rank_sketch binary, year int, month int"""


def _hashed(df: DataFrame, name: str) -> Column:
    """A 64-bit hash of a value; numbers by their value as a double where that is exact, -0 as 0."""
    kind, value = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.xxhash64(value.cast("double") + F.lit(0.0))
    if isinstance(kind, T.IntegralType):
        whole = value.cast("bigint")
        return F.when(F.abs(whole) <= 2**53, F.xxhash64(whole.cast("double"))).otherwise(F.xxhash64(whole))
    return F.xxhash64(value)


def _measures(df: DataFrame, name: str) -> Column:
    """What is stored of a column, as a struct of aggregates."""
    kind, missing = df.schema[name].dataType, is_missing(df, name)
    if isinstance(kind, (T.MapType, T.ArrayType, T.StructType)):
        raise TypeError(f"column {name} is {kind.simpleString()}; sketches are of plain values")
    number = F.when(~missing, F.col(name).cast("double")) if isinstance(kind, T.NumericType) else None
    none = F.lit(None).cast("double")
    parts = [
        F.lit(name).alias("column"),
        F.lit(kind.simpleString()).alias("dtype"),
        F.count("*").alias("n_rows"),
        F.count_if(missing).alias("missing_count"),
        (F.lit(0).cast("bigint") if number is None else F.count_if(number < 0)).alias("negative_count"),
        (none if number is None else F.min(number)).alias("least"),
        (none if number is None else F.max(number)).alias("greatest"),
        (none if number is None else F.sum(number)).alias("total"),
        F.hll_sketch_agg(F.when(~missing, _hashed(df, name)), LG_K).alias("distinct_sketch"),
        (F.lit(None).cast("binary") if number is None else F.kll_sketch_agg_double(number, RANK_K)).alias("rank_sketch"),
    ]
    return F.struct(*parts)


def month_profiles(trips: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A row per year, month and column, from one scan; what is shuffled is one row per month and task."""
    columns = columns or [name for name in trips.columns if name not in MONTH]
    wide = trips.groupBy(*MONTH).agg(*[_measures(trips, name).alias(f"c{i}") for i, name in enumerate(columns)])
    return wide.select(*MONTH, F.inline(F.array(*[F.col(f"c{i}") for i in range(len(columns))])))


def store_profiles(trips: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Writes the profiles of the months that the trips have, in place of earlier ones of these months; the others stay."""
    rows = month_profiles(trips, columns).hint("rebalance", *[F.col(name) for name in MONTH])
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH).parquet(path)


def stored_profiles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_DDL).parquet(path)


def _quartile(share: float) -> Column:
    return F.when(F.col("n_rows") > F.col("missing_count"), F.kll_sketch_get_quantile_double("ranks", F.lit(share)))


def range_profile(stored: DataFrame) -> DataFrame:
    """column, dtypes, n_rows, missing_count, missing_pct, negative_count, unique_count, unique_low, unique_high, mean, least, q25, q50,
    q75, greatest of the months given, which a filter on year and month picks.

    A missing value counts as a value, as in the exact profile; the bounds of the distinct count are three standard errors.
    """
    merged = stored.groupBy("column").agg(
        F.concat_ws(", ", F.sort_array(F.collect_set("dtype"))).alias("dtypes"),
        *[F.sum(name).alias(name) for name in ("n_rows", "missing_count", "negative_count")],
        F.sum("total").alias("total"),
        F.min("least").alias("least"),
        F.max("greatest").alias("greatest"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("found"),
        F.kll_merge_agg_double("rank_sketch").alias("ranks"),
    )
    also = (F.col("missing_count") > 0).cast("bigint")
    counted = F.col("n_rows") - F.col("missing_count")
    return merged.select(
        "column",
        "dtypes",
        "n_rows",
        "missing_count",
        F.round(F.try_divide(F.lit(100.0) * F.col("missing_count"), F.col("n_rows")), 2).alias("missing_pct"),
        "negative_count",
        (F.col("found") + also).alias("unique_count"),
        (F.floor(F.col("found") * (1 - DISTINCT_BOUND)) + also).alias("unique_low"),
        (F.ceil(F.col("found") * (1 + DISTINCT_BOUND)) + also).alias("unique_high"),
        F.try_divide("total", counted).alias("mean"),
        "least",
        *[F.when(F.col("greatest").isNotNull(), _quartile(share)).alias(name) for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))],
        "greatest",
    )
