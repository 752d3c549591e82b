"""Rollup refresh for newly landed files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from monthmill.plans.ledger import refresh_by_ledger
from monthmill.plans.rollup import refresh_rollup
from monthmill.schemas import NARROW_DDL


def start_rollup_refresh(
    spark: SparkSession,
    base: str,
    rollup: str,
    checkpoint: str,
    partitions: tuple[str, ...] = ("year",),
    files_per_batch: int | None = None,
    ledger: str | None = None,
    **ranges: tuple[int, int],
) -> StreamingQuery:
    """Processes the files that landed since the last run, then stops.

    With a ledger only new files are read, and the rollup is summed up from what each has contributed (`plans.ledger`).

    A batch only says which partitions changed; these are recomputed from the fact and replaced.
    So a batch that is replayed after a failure counts nothing twice, and late or corrupt
    timestamps need no watermark: a trip belongs to the partition of its file.
    """
    files = spark.readStream.schema(NARROW_DDL)
    if ledger is not None and ranges:
        raise ValueError("a ledger counts every file; ranges belong to the questions")
    if files_per_batch is not None:
        files = files.option("maxFilesPerTrigger", files_per_batch)

    def refresh(batch: DataFrame, _: int) -> None:
        if ledger is not None:
            refresh_by_ledger(batch.sparkSession, base, rollup, ledger, partitions)
            return
        refresh_rollup(batch.sparkSession, base, rollup, batch, partitions, **ranges)

    return (
        files.parquet(base)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def run_rollup_refresh(spark: SparkSession, base: str, rollup: str, checkpoint: str, **options) -> None:
    """The same, waiting for the end; a failed batch raises.

    A stream sees a file once, by its path. With a ledger, files that were rewritten or are gone are looked for afterwards.
    """
    start_rollup_refresh(spark, base, rollup, checkpoint, **options).awaitTermination()
    if options.get("ledger") is not None:
        refresh_by_ledger(spark, base, rollup, options["ledger"], options.get("partitions", ("year",)))
