"""The daily rollup: build, write, refresh.

It stores sums and counts and never an average, so every coarser question re-aggregates it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthmill.functions.measures import count_where, rounded_sum, tipped_positive
from monthmill.plans.fact import narrow_fact
from monthmill.schemas import ROLLUP_KEYS, ROLLUP_MEASURES


def build_rollup(fact: DataFrame, partitions: tuple[str, ...] = ("year",)) -> DataFrame:
    """One row per pickup day, zone, payment type and partition of the file.

    Aggregated within each task first; what is shuffled is at most one row per group and task.
    Partitioning by year and month gives a finer grain that answers every question alike and is
    cheaper to refresh.
    """
    measures = [
        F.count("*").alias("trips"),
        count_where(tipped_positive()).alias("tipped_trips"),
        rounded_sum("fare_amount").alias("total_fare"),
        rounded_sum("tip_amount").alias("total_tip"),
        rounded_sum("total_amount").alias("total_revenue"),
        rounded_sum("trip_distance").alias("total_distance"),
    ]
    grouped = fact.groupBy(*ROLLUP_KEYS, *partitions).agg(*measures)
    return grouped.select(*ROLLUP_KEYS, *ROLLUP_MEASURES, *partitions)


def _spread(rollup: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Rows of a partition in few tasks, in key order.

    The rebalance gives neither one task per year nor a file per task and year: it splits a
    partition that is too large for a task and joins small ones. The order makes keys compress to
    runs, and lets a filter on days skip row groups.
    """
    rows = rollup.hint("rebalance", *[F.col(name) for name in partitions])
    return rows.sortWithinPartitions(*partitions, *ROLLUP_KEYS)


def write_rollup(
    rollup: DataFrame, path: str, partitions: tuple[str, ...] = ("year",)
) -> None:
    """Replaces exactly the partitions present in the input; the others stay."""
    (
        _spread(rollup, partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def rebuild_rollup(fact: DataFrame, path: str, partitions: tuple[str, ...] = ("year",)) -> None:
    """Full rebuild: what was there before is gone, years without trips included."""
    (
        _spread(build_rollup(fact, partitions), partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .parquet(path)
    )


def refresh_rollup(
    spark: SparkSession,
    base: str,
    path: str,
    changed: DataFrame,
    partitions: tuple[str, ...] = ("year",),
    **ranges: tuple[int, int],
) -> None:
    """Recomputes the partitions that ``changed`` touches, from the fact, and replaces them.

    Idempotent: running it again for the same input gives the same rollup, which adding the new
    rows' sums would not. The touched partitions come to the driver as literals (one per year or
    month), so that the fact scan is pruned when it is planned. A changed month outside the given
    ranges raises before anything is written: its rows would be left out and not be seen again.
    """
    months = changed.select("year", "month").distinct().collect()
    if not months:
        return
    for name, ends in ranges.items():
        outside = {row[name[:-1]] for row in months if not ends[0] <= row[name[:-1]] <= ends[1]}
        if outside:
            raise ValueError(f"files changed in {name} outside {ends}: {sorted(outside)}")
    touched = {tuple(row[name] for name in partitions) for row in months}
    hit = F.lit(False)
    for row in touched:
        this = F.lit(True)
        for name, value in zip(partitions, row):
            this = this & (F.col(name) == value)
        hit = hit | this
    fact = narrow_fact(spark, base, **ranges).filter(hit)
    write_rollup(build_rollup(fact, partitions), path, partitions)
