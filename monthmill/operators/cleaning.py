"""Cleaning of an incoming month: each rule by itself, the chain, and an audit of the chain.

A null comparison never removes a row. Every rule is a narrow transformation, so the chain is one
pass over the month.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from monthmill.fixed_values import MISSING_TOGETHER, REFUND_AMOUNTS
from monthmill.functions.dates import seconds_of_day
from monthmill.functions.names import existing_columns
from monthmill.operators.joins import with_both_unknown
from monthmill.sources.lookups import inline_relation
from monthmill.operators.profile import is_missing

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"


def all_missing(df: DataFrame, columns: list[str] = MISSING_TOGETHER) -> Column:
    return reduce(and_, [is_missing(df, name) for name in columns])


def any_missing(df: DataFrame, columns: list[str] = MISSING_TOGETHER) -> Column:
    return reduce(or_, [is_missing(df, name) for name in columns])


def reversed_trip(pickup: str = PICKUP, dropoff: str = DROPOFF) -> Column:
    return F.coalesce(F.col(dropoff) < F.col(pickup), F.lit(False))


def refund(
    df: DataFrame, amounts: list[str] = REFUND_AMOUNTS, distance: str = "trip_distance"
) -> Column:
    """Some amount below 0 on a trip that did cover distance; amounts that are no columns are passed over."""
    found = existing_columns(df, amounts)
    if not found:
        return F.lit(False)
    negative = reduce(or_, [F.coalesce(F.col(name) < 0, F.lit(False)) for name in found])
    return negative & F.coalesce(F.col(distance) > 0, F.lit(False))


def drop_all_missing(df: DataFrame, columns: list[str] = MISSING_TOGETHER) -> DataFrame:
    return df.filter(~all_missing(df, columns))


def count_any_missing(df: DataFrame, columns: list[str] = MISSING_TOGETHER) -> DataFrame:
    return df.agg(F.count_if(any_missing(df, columns)).alias("rows_with_missing"))


def split_times(df: DataFrame) -> DataFrame:
    """Date at midnight and seconds since midnight for pickup and dropoff, where present."""
    for name, prefix in ((PICKUP, "Pickup"), (DROPOFF, "Dropoff")):
        if name in df.columns:
            df = df.withColumn(f"{prefix}_date", F.to_date(name))
            df = df.withColumn(f"{prefix}_time", seconds_of_day(F.col(name)))
    return df


def drop_reversed(df: DataFrame, pickup: str = PICKUP, dropoff: str = DROPOFF) -> DataFrame:
    return df.filter(~reversed_trip(pickup, dropoff))


def drop_refunds(
    df: DataFrame, amounts: list[str] = REFUND_AMOUNTS, distance: str = "trip_distance"
) -> DataFrame:
    return df.filter(~refund(df, amounts, distance))


def count_negative_distance(df: DataFrame, distance: str = "trip_distance") -> DataFrame:
    return df.agg(F.count_if(F.col(distance) < 0).alias("negative_distances"))


def clean_month(
    df: DataFrame,
    missing: list[str] = MISSING_TOGETHER,
    amounts: list[str] = REFUND_AMOUNTS,
) -> DataFrame:
    """Incomplete, reversed and refunded trips removed, the two timestamps split and dropped."""
    return (
        drop_all_missing(df, missing)
        .transform(split_times)
        .transform(drop_reversed)
        .drop(PICKUP, DROPOFF)
        .transform(drop_refunds, amounts)
    )


def audit_month(
    df: DataFrame,
    lookup: DataFrame,
    lookup_key: str = "location_id",
    missing: list[str] = MISSING_TOGETHER,
    amounts: list[str] = REFUND_AMOUNTS,
    pickup_location: str = "PULocationID",
    dropoff_location: str = "DOLocationID",
) -> DataFrame:
    """step_no, step, rows_before, dropped, rows_after of the chain, from a single pass.

    The last step only reports (rows with both locations unknown stay), so it drops none and its
    finding is in ``flagged``; so is the count of rows with any missing column in the first step.
    """
    steps = [
        ("drop_all_missing", all_missing(df, missing)),
        ("drop_reversed", reversed_trip()),
        ("drop_refunds", refund(df, amounts)),
    ]
    alive: Column = F.lit(True)
    counts = [F.count("*").alias("rows_0"), F.count_if(any_missing(df, missing)).alias("flag_0")]
    for i, (_, test) in enumerate(steps, 1):
        alive = alive & ~test
        counts.append(F.count_if(alive).alias(f"rows_{i}"))
    # Counted per pair of locations first: the lookup then meets pairs, not trips.
    pairs = df.groupBy(pickup_location, dropoff_location).agg(*counts)
    pairs = with_both_unknown(
        pairs, lookup, lookup_key, pickup_location, dropoff_location, "__unknown"
    ).withColumn("flag_last", F.when(F.col("__unknown"), F.col(f"rows_{len(steps)}")))
    totals = [f"rows_{i}" for i in range(len(steps) + 1)] + ["flag_0", "flag_last"]
    one = pairs.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in totals])

    names = [name for name, _ in steps] + ["report_unknown_locations"]
    rows = []
    for i, name in enumerate(names, 1):
        before, after = F.col(f"rows_{i - 1}"), F.col(f"rows_{min(i, len(steps))}")
        flag = {1: F.col("flag_0"), len(names): F.col("flag_last")}.get(i, F.lit(0).cast("long"))
        rows.append(
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(name).alias("step"),
                before.alias("rows_before"),
                (before - after).alias("dropped"),
                after.alias("rows_after"),
                flag.alias("flagged"),
            )
        )
    return one.select(F.inline(F.array(*rows)))


def write_cleaned(
    df: DataFrame,
    lookup: DataFrame,
    path: str,
    lookup_key: str = "location_id",
    missing: list[str] = MISSING_TOGETHER,
    amounts: list[str] = REFUND_AMOUNTS,
    pickup_location: str = "PULocationID",
    dropoff_location: str = "DOLocationID",
) -> DataFrame:
    """Writes the month as `clean_month` leaves it, and returns the rows of `audit_month`, both from one job.

    The counts are observed on their way into the files: every trip is tested once, counted, and kept or not. Nothing is shuffled after
    that, as a task of an earlier stage may run again and be counted again; a task that writes counts only when it is committed.
    The two locations are looked up per trip, which a lookup of a few hundred rows makes cheap.
    """
    steps = [
        ("drop_all_missing", all_missing(df, missing)),
        ("drop_reversed", reversed_trip()),
        ("drop_refunds", refund(df, amounts)),
    ]
    tests = {f"__test_{i}": test for i, (_, test) in enumerate(steps)}
    marked = df.withColumns({**tests, "__any": any_missing(df, missing)})
    marked = with_both_unknown(marked, lookup, lookup_key, pickup_location, dropoff_location, "__unknown")
    alive: Column = F.lit(True)
    counts = [F.count(F.lit(1)).alias("rows_0"), F.count_if("__any").alias("flag_first")]
    for i, name in enumerate(tests, 1):
        alive = alive & ~F.col(name)
        counts.append(F.count_if(alive).alias(f"rows_{i}"))
    counts.append(F.count_if(alive & F.col("__unknown")).alias("flag_last"))
    seen = Observation()
    kept = marked.observe(seen, *counts).filter(alive).select(*df.columns).transform(split_times).drop(PICKUP, DROPOFF)
    kept.write.mode("errorifexists").parquet(path)
    found = seen.get
    names = [name for name, _ in steps] + ["report_unknown_locations"]
    rows = []
    for i, name in enumerate(names, 1):
        before, after = found[f"rows_{i - 1}"], found[f"rows_{min(i, len(steps))}"]
        flag = {1: found["flag_first"], len(names): found["flag_last"]}.get(i, 0)
        rows.append((i, name, before, before - after, after, flag))
    ddl = "step_no int, step string, rows_before bigint, dropped bigint, rows_after bigint, flagged bigint"
    return inline_relation(df.sparkSession, rows, ddl)
