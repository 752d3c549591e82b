"""Command line of the recurring jobs: ``python -m monthmill.jobs --help``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from monthmill.plans.landing import LOOKBACK_MONTHS, backfill, catch_up
from monthmill.streaming.refresh import run_rollup_refresh


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="monthmill.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    fill = jobs.add_parser("backfill", help="land the missing months of a range of years")
    fill.add_argument("--source", required=True)
    fill.add_argument("--target", required=True)
    fill.add_argument("--years", required=True, help="one year, or first and last with a hyphen")
    fill.add_argument("--prefix", help="only files of this name before the month")
    fill.add_argument("--dry-run", action="store_true")
    fill.add_argument("--manifest", help="keep here what each landed month holds, and look only into months that changed")

    recent = jobs.add_parser("catch-up", help="land recent missing months")
    recent.add_argument("--source", required=True)
    recent.add_argument("--target", required=True)
    recent.add_argument("--lookback", type=int, default=LOOKBACK_MONTHS)
    recent.add_argument("--cap", type=int, help="months landed in one run at most; none by default")
    recent.add_argument("--prefix", help="only files of this name before the month")
    recent.add_argument("--month", help="only this month, as 2025-01")
    recent.add_argument("--manifest", help="keep here what each landed month holds, and look only into months that changed")

    refresh = jobs.add_parser("refresh", help="bring the rollup up to date with landed files")
    refresh.add_argument("--base", required=True)
    refresh.add_argument("--rollup", required=True)
    refresh.add_argument("--checkpoint", required=True)
    refresh.add_argument("--by-month", action="store_true", help="the rollup is partitioned by year and month")
    refresh.add_argument("--ledger", help="keep what each file contributes here, and read only files that changed")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"monthmill {args.job}").getOrCreate()
    if args.job == "backfill":
        done = backfill(spark, args.source, args.target, args.years, args.dry_run, args.prefix, args.manifest)
        done.show(1000, False)
    elif args.job == "catch-up":
        month = tuple(int(part) for part in args.month.split("-")) if args.month else None
        done = catch_up(
            spark,
            args.source,
            args.target,
            dt.date.today(),
            args.lookback,
            args.cap,
            month,
            args.prefix,
            args.manifest,
        )
        done.show(1000, False)
    else:
        partitions = ("year", "month") if args.by_month else ("year",)
        run_rollup_refresh(
            spark, args.base, args.rollup, args.checkpoint, partitions=partitions, ledger=args.ledger
        )


if __name__ == "__main__":
    main()
