"""The rollup kept by a ledger of files, on hand-made monthly files."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from monthmill import jobs
from monthmill.plans import ledger as ledgers
from monthmill.plans.fact import narrow_fact
from monthmill.plans.rollup import build_rollup
from monthmill.streaming.refresh import run_rollup_refresh
from tests.trip_frames import MONTHS, month_frame, write_layout

BY = [("year",), ("year", "month")]


@pytest.fixture
def place(tmp_path):
    return {name: str(tmp_path / name) for name in ("trips", "rollup", "ledger")}


def land(spark, place, year, month, count, mode="append"):
    folder = f"{place['trips']}/year={year}/month={month:02d}"
    month_frame(spark, year, month, count).coalesce(1).write.mode(mode).parquet(folder)


def refresh(spark, place, by=("year",)):
    """status -> (files, months, trips)"""
    done = ledgers.refresh_by_ledger(spark, place["trips"], place["rollup"], place["ledger"], by)
    return {row.status: (row.files, row.months, row.trips) for row in done.collect()}


def agrees(spark, place, rows, by=("year",)):
    want = build_rollup(narrow_fact(spark, place["trips"]), by)
    got = spark.read.schema(want.schema).parquet(place["rollup"])
    assert rows(got) == rows(want)


@pytest.mark.parametrize("by", BY)
def test_land_replace_remove_and_replay(spark, place, rows, by):
    write_layout(spark, place["trips"], MONTHS[:3])
    assert refresh(spark, place, by) == {"added": (3, 3, 18), "replaced": (0, 0, 0), "removed": (0, 0, 0), "kept": (0, 0, 0)}
    agrees(spark, place, rows, by)

    land(spark, place, 2024, 3, 8)
    land(spark, place, 2023, 2, 4)  # a second file of a month that is there
    assert refresh(spark, place, by) == {"added": (2, 2, 12), "replaced": (0, 0, 0), "removed": (0, 0, 0), "kept": (3, 3, 0)}
    agrees(spark, place, rows, by)

    land(spark, place, 2022, 12, 11, "overwrite")  # another name in the same month
    assert refresh(spark, place, by) == {"added": (1, 1, 11), "replaced": (0, 0, 0), "removed": (1, 1, 0), "kept": (4, 3, 0)}
    agrees(spark, place, rows, by)

    shutil.rmtree(f"{place['trips']}/year=2023/month=01")
    shutil.rmtree(f"{place['trips']}/year=2024")
    assert refresh(spark, place, by) == {"added": (0, 0, 0), "replaced": (0, 0, 0), "removed": (2, 2, 0), "kept": (3, 2, 0)}
    agrees(spark, place, rows, by)
    gone = "year=2024/month=3"
    assert not Path(place["ledger"], "sums", gone).exists() and not Path(place["rollup"], gone if "month" in by else "year=2024").exists()

    assert refresh(spark, place, by)["kept"] == (3, 2, 0)
    agrees(spark, place, rows, by)


def test_a_file_rewritten_under_its_name(spark, place, rows, tmp_path):
    write_layout(spark, place["trips"], MONTHS[:2])
    refresh(spark, place)
    (old,) = Path(place["trips"], "year=2023/month=01").glob("*.parquet")
    month_frame(spark, 2023, 1, 9, "double").coalesce(1).write.parquet(str(tmp_path / "other"))
    (new,) = (tmp_path / "other").glob("*.parquet")
    shutil.copyfile(new, old)
    old.with_name(f".{old.name}.crc").unlink(missing_ok=True)
    assert refresh(spark, place)["replaced"] == (1, 1, 9)
    agrees(spark, place, rows)


def test_only_changed_files_are_read(spark, place, monkeypatch):
    write_layout(spark, place["trips"], MONTHS[:3])
    refresh(spark, place)
    read = []
    real = ledgers.contributions
    monkeypatch.setattr(ledgers, "contributions", lambda spark, base, paths: read.append(paths) or real(spark, base, paths))
    refresh(spark, place)
    assert read == []
    land(spark, place, 2023, 2, 4)
    refresh(spark, place)
    ((path,),) = read
    assert "/year=2023/month=02/" in path


@pytest.mark.parametrize("step", ["write_rollup", "_replace_partitions"])
def test_a_run_that_failed_counts_nothing_twice(spark, place, rows, monkeypatch, step):
    write_layout(spark, place["trips"], MONTHS[:2])
    refresh(spark, place)
    land(spark, place, 2023, 1, 5)
    calls = []
    real = getattr(ledgers, step)

    def fail_last(*args):
        """Fails as the run writes the rollup, or the list of files, with what comes before already written."""
        calls.append(args)
        if step == "write_rollup" or len(calls) == 2:
            raise OSError("lost")
        return real(*args)

    with monkeypatch.context() as patch:
        patch.setattr(ledgers, step, fail_last)
        with pytest.raises(OSError, match="lost"):
            refresh(spark, place)
    assert refresh(spark, place)["added"] == (1, 1, 5)
    agrees(spark, place, rows)
    assert refresh(spark, place)["added"] == (0, 0, 0)


def test_an_empty_folder(spark, place):
    assert refresh(spark, place) == {status: (0, 0, 0) for status in ("added", "replaced", "removed", "kept")}


def test_stream_with_a_ledger(spark, place, rows, tmp_path):
    progress = str(tmp_path / "progress")
    write_layout(spark, place["trips"], MONTHS[:3])
    run_rollup_refresh(spark, place["trips"], place["rollup"], progress, ledger=place["ledger"])
    agrees(spark, place, rows)
    write_layout(spark, place["trips"], MONTHS[3:])
    shutil.rmtree(f"{place['trips']}/year=2023/month=01")  # no new file says so
    run_rollup_refresh(spark, place["trips"], place["rollup"], progress, ledger=place["ledger"], files_per_batch=1)
    agrees(spark, place, rows)
    with pytest.raises(ValueError, match="ranges"):
        run_rollup_refresh(spark, place["trips"], place["rollup"], progress, ledger=place["ledger"], years=(2021, 2026))


def test_job(spark, place, rows, tmp_path):
    write_layout(spark, place["trips"], MONTHS)
    jobs.main(
        ["refresh", "--base", place["trips"], "--rollup", place["rollup"], "--checkpoint", str(tmp_path / "c"), "--ledger", place["ledger"], "--by-month"],
        spark,
    )
    agrees(spark, place, rows, BY[1])
