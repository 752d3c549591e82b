"""Landing with a manifest: which months are looked into."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from monthmill import jobs
from monthmill.plans import landing, manifest
from monthmill.sources import files
from tests.trip_frames import MONTHS, month_frame, write_published


@pytest.fixture
def place(spark, tmp_path):
    write_published(spark, str(tmp_path / "published"), MONTHS[:4])
    return {name: str(tmp_path / name) for name in ("published", "trips", "manifest")}


@pytest.fixture
def looked_into(monkeypatch):
    """Months whose footers are read, by side."""
    seen: list[tuple[str, int]] = []
    real = files.footer_columns

    def footers(frame):
        for row in frame.collect():
            seen.append(("landed" if "/year=" in row.path else "published", row.year * 100 + row.month))
        return real(frame)

    for module in (files, manifest):
        monkeypatch.setattr(module, "footer_columns", footers)
    return seen


def run(spark, place, years="2022-2024", **options):
    done = landing.backfill(spark, place["published"], place["trips"], years, manifest=place["manifest"], **options)
    out: dict[str, list] = {}
    for row in done.collect():
        out.setdefault(row.status, []).append(row.year * 100 + row.month)
    return {status: sorted(months) for status, months in out.items() if status != "unpublished"}


LANDED = [202212, 202301, 202302, 202403]


def test_second_run_reads_no_footer(spark, place, looked_into, rows):
    assert run(spark, place) == {"uploaded": LANDED}
    held = manifest.read_manifest(spark, place["manifest"])
    assert rows(held, "year", "month", "source_files", "landed_files", "source_trips", "trips") == [
        (2022, 12, 1, 1, 5, 5), (2023, 1, 1, 1, 6, 6), (2023, 2, 1, 1, 7, 7), (2024, 3, 1, 1, 8, 8),
    ]
    assert rows(held.filter("signature LIKE '%ratecodeid double%'"), "month") == [(1,), (12,)]
    looked_into.clear()
    assert run(spark, place) == {"skipped": LANDED}
    assert looked_into == []
    assert manifest.read_manifest(spark, place["manifest"]).count() == 4


def test_only_what_changed_is_looked_into(spark, place, looked_into):
    run(spark, place)
    month_frame(spark, 2023, 1, 6, "double").coalesce(1).write.mode("overwrite").parquet(f"{place['published']}/trips_2023-01.parquet")
    month_frame(spark, 2023, 2, 30, "bigint", "int").coalesce(1).write.mode("overwrite").parquet(f"{place['published']}/trips_2023-02.parquet")
    looked_into.clear()
    done = run(spark, place)
    assert {month for _, month in looked_into} <= {202301, 202302}
    # The month that grew is landed again; the other holds the rows that it should, whatever its file looks like.
    assert done["uploaded"] == [202302] and 202301 in done["skipped"]
    looked_into.clear()
    assert run(spark, place) == {"skipped": LANDED} and looked_into == []


def test_part_of_a_month_is_landed_again(spark, place):
    run(spark, place)
    folder = f"{place['trips']}/year=2023/month=02"
    part = spark.createDataFrame(spark.read.parquet(folder).limit(3).toPandas(), spark.read.parquet(folder).schema)
    part.write.mode("overwrite").parquet(folder)
    assert run(spark, place)["uploaded"] == [202302]


def test_a_month_that_is_gone_is_landed_again(spark, place):
    run(spark, place)
    shutil.rmtree(f"{place['trips']}/year=2023/month=01")
    assert run(spark, place) == {"uploaded": [202301], "skipped": [202212, 202302, 202403]}
    assert run(spark, place) == {"skipped": LANDED}


def test_months_landed_without_a_manifest(spark, place, looked_into):
    landing.backfill(spark, place["published"], place["trips"], "2022-2024")
    assert run(spark, place) == {"skipped": LANDED}
    looked_into.clear()
    assert run(spark, place) == {"skipped": LANDED} and looked_into == []


def test_dry_run_writes_no_manifest(spark, place):
    assert run(spark, place, dry_run=True) == {"uploaded": LANDED}
    assert not Path(place["manifest"]).exists() and not Path(place["trips"]).exists()


def test_a_landing_that_failed_has_no_rows(spark, place, monkeypatch):
    def fail(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(landing, "land", fail)
        with pytest.raises(OSError, match="lost"):
            run(spark, place)
    assert manifest.read_manifest(spark, place["manifest"]).count() == 0
    assert run(spark, place) == {"uploaded": LANDED}


def test_jobs(spark, place, capsys):
    where = ["--source", place["published"], "--target", place["trips"], "--manifest", place["manifest"]]
    jobs.main(["backfill", *where, "--years", "2022-2023"], spark)
    jobs.main(["catch-up", *where, "--month", "2024-03"], spark)
    assert manifest.read_manifest(spark, place["manifest"]).count() == 4
    assert "uploaded" in capsys.readouterr().out
