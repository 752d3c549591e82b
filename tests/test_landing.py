from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from monthmill import jobs
from monthmill.plans import landing, warehouse
from monthmill.plans.fact import fact_trips
from monthmill.sources.files import months_of, partition_files
from monthmill.sources.trips import narrow_trips, one_file
from tests.trip_frames import MONTHS, month_frame, write_published


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("published"))
    write_published(spark, path, MONTHS[:4])
    return path


def months(spark, *pairs):
    return spark.createDataFrame(list(pairs), "year int, month int")


def by_status(df):
    out: dict[str, list] = {}
    for row in df.collect():
        out.setdefault(row.status, []).append((row.year, row.month))
    return {status: sorted(found) for status, found in out.items()}


def test_candidates_roll_over_the_year(spark, rows):
    got = landing.months_before(spark, dt.date(2025, 1, 31), 3)
    assert rows(got) == [(2024, 10), (2024, 11), (2024, 12)]
    assert landing.months_before(spark, dt.date(2025, 1, 31), 0).count() == 0


def test_cap_stops_the_run(spark):
    """Newest first: the second month to upload is the last one looked at."""
    asked = months(spark, *[(2024, m) for m in range(1, 7)])
    out = months(spark, (2024, 5), (2024, 3), (2024, 2))
    there = months(spark, (2024, 4), (2024, 1))
    plan = landing.catch_up_plan(asked, out, there, cap=2)
    assert by_status(plan) == {
        "unpublished": [(2024, 6)],
        "uploaded": [(2024, 3), (2024, 5)],
        "skipped": [(2024, 4)],
        "not_reached": [(2024, 1), (2024, 2)],
    }


def test_backfill_twice(spark, published, tmp_path):
    target = str(tmp_path / "trips")
    first = by_status(landing.backfill(spark, published, target, "2022-2023"))
    assert first["uploaded"] == [(2022, 12), (2023, 1), (2023, 2)]
    assert len(first["unpublished"]) == 21
    again = landing.backfill(spark, published, target, "2022-2023")
    assert by_status(again)["skipped"] == first["uploaded"]
    assert "uploaded" not in by_status(again)
    assert tuple(landing.status_totals(again).first()) == (0, 3, 21)


def test_landed_files_keep_their_types(spark, published, tmp_path, rows):
    target = str(tmp_path / "trips")
    landing.backfill(spark, published, target, "2022-2024")
    assert rows(months_of(partition_files(spark, target))) == [
        (2022, 12), (2023, 1), (2023, 2), (2024, 3),
    ]
    old = one_file(spark, f"{target}/year=2022/month=12")
    new = one_file(spark, f"{target}/year=2023/month=02")
    assert dict(old.dtypes)["ratecodeid"] == "double" and dict(new.dtypes)["pulocationid"] == "int"
    assert fact_trips(spark, target).count() == 5 + 6 + 7 + 8


def test_part_of_a_month_is_landed_again(spark, published, tmp_path):
    target = str(tmp_path / "trips")
    landing.backfill(spark, published, target, "2022-2024")
    month = f"{target}/year=2023/month=02"
    part = spark.createDataFrame(one_file(spark, month).limit(3).toPandas(), one_file(spark, month).schema)
    part.write.mode("overwrite").parquet(month)
    assert fact_trips(spark, target).count() < 5 + 6 + 7 + 8
    again = by_status(landing.backfill(spark, published, target, "2022-2024"))
    assert again["uploaded"] == [(2023, 2)] and len(again["skipped"]) == 3
    assert fact_trips(spark, target).count() == 5 + 6 + 7 + 8


def test_dry_run_writes_nothing(spark, published, tmp_path):
    target = str(tmp_path / "trips")
    plan = landing.backfill(spark, published, target, "2024", dry_run=True)
    assert by_status(plan)["uploaded"] == [(2024, 3)]
    assert partition_files(spark, target).count() == 0


def test_catch_up_and_single_month(spark, published, tmp_path):
    target = str(tmp_path / "trips")
    one = landing.catch_up(spark, published, target, dt.date(2024, 5, 1), month=(2022, 12))
    beside = {"out_of_range": [(2023, 1), (2023, 2), (2024, 3)]}
    assert by_status(one) == {"uploaded": [(2022, 12)]} | beside
    recent = landing.catch_up(spark, published, target, dt.date(2023, 3, 15), 4, 1)
    assert by_status(recent) == {
        "uploaded": [(2023, 2)],
        "not_reached": [(2022, 11), (2022, 12), (2023, 1)],
        "out_of_range": [(2024, 3)],
    }
    rest = landing.catch_up(spark, published, target, dt.date(2023, 3, 15), 4, 3)
    assert by_status(rest) == {
        "skipped": [(2022, 12), (2023, 2)],
        "uploaded": [(2023, 1)],
        "unpublished": [(2022, 11)],
        "out_of_range": [(2024, 3)],
    }


def test_catch_up_without_a_cap_lands_every_month_asked_for(spark, published, tmp_path):
    target = str(tmp_path / "trips")
    done = landing.catch_up(spark, published, target, dt.date(2024, 5, 1), lookback=24)
    assert by_status(done)["uploaded"] == [(2022, 12), (2023, 1), (2023, 2), (2024, 3)]
    assert "not_reached" not in by_status(done)


def test_one_product_of_several(spark, tmp_path):
    source, target = str(tmp_path / "published"), str(tmp_path / "trips")
    for name, count in (("first", 3), ("second", 4)):
        month_frame(spark, 2024, 3, count, "bigint").coalesce(1).write.parquet(f"{source}/{name}_2024-03.parquet")
    with pytest.raises(ValueError, match="2024-03"):
        landing.backfill(spark, source, target, "2024")
    landing.backfill(spark, source, target, "2024", prefix="second")
    assert narrow_trips(spark, target).count() == 4


def test_footers_are_read_without_the_package_on_the_workers(spark, published):
    """What is sent to the workers names no module of this package."""
    import pickletools

    from pyspark import cloudpickle

    from monthmill.sources.files import footer_columns

    sent = []
    frame = type("Frame", (), {"select": lambda self, *_: self, "mapInPandas": lambda self, f, _: sent.append(f)})()
    footer_columns(frame)
    texts = [str(arg) for _, arg, _ in pickletools.genops(cloudpickle.dumps(sent[0]))]
    assert "_arrow_uri" not in texts


def test_month_of_mixed_types_is_refused(spark, tmp_path):
    source = str(tmp_path / "published")
    folder = f"{source}/trips_2024-03.parquet"
    month_frame(spark, 2024, 3, 2, "bigint").write.parquet(folder)
    month_frame(spark, 2024, 3, 2, "double").write.mode("append").parquet(folder)
    with pytest.raises(ValueError, match="2024-03"):
        landing.backfill(spark, source, str(tmp_path / "trips"), "2024")


def test_jobs(spark, published, tmp_path, capsys):
    target, rollup = str(tmp_path / "trips"), str(tmp_path / "rollup")
    where = ["--source", published, "--target", target]
    jobs.main(["backfill", *where, "--years", "2022-2023", "--dry-run"], spark)
    jobs.main(["backfill", *where, "--years", "2022-2023"], spark)
    jobs.main(["catch-up", *where, "--month", "2024-03"], spark)
    jobs.main(
        ["refresh", "--base", target, "--rollup", rollup, "--checkpoint", str(tmp_path / "c")], spark
    )
    assert "uploaded" in capsys.readouterr().out
    assert spark.read.parquet(rollup).agg(F.sum("trips")).first()[0] == 26


# --- tables ---


def test_warehouse(spark, tmp_path, rows):
    df = spark.createDataFrame([(1, 2024), (2, 2025)], "` Trip Id ` int, year int")
    warehouse.create_namespace(spark, "mill_test")
    warehouse.create_namespace(spark, "mill_test")
    warehouse.load_staging(df, "mill_test.staging")
    warehouse.load_staging(df, "mill_test.staging")
    assert warehouse.read_table(spark, "mill_test.staging").columns == ["trip_id", "year"]
    assert warehouse.read_table(spark, "mill_test.staging").count() == 2
    warehouse.create_view(df, "trips_view")
    got = warehouse.run_sql(spark, "SELECT year, count(*) AS n FROM trips_view GROUP BY 1 ORDER BY 1")
    assert rows(got.filter("year > 2024")) == [(2025, 1)]


def test_star_is_replaced(spark):
    fact = spark.createDataFrame([(1, 3600)], "payment_type int, pickup_time int")
    dims = {"dim_mill": spark.createDataFrame([(1, "Card")], "payment_type int, text string")}
    for _ in range(2):
        warehouse.load_star(spark, fact, dims)
    assert spark.table("fact_trips").count() == 1 and spark.table("dim_mill").count() == 1
    warehouse.drop_star(spark, ["dim_mill"])
    assert not spark.catalog.tableExists("fact_trips")


def test_tables_are_not_overwritten_by_accident(spark, tmp_path, rows):
    df = spark.createDataFrame([(2024, 1), (2025, 2)], "year int, n int")
    flat, parts = str(tmp_path / "flat"), str(tmp_path / "parts")
    warehouse.write_table(df, flat)
    warehouse.write_partitioned(df, parts, ["year"])
    assert rows(spark.read.parquet(parts), "year", "n") == [(2024, 1), (2025, 2)]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warehouse.write_table(df, flat)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        warehouse.write_partitioned(df, parts, ["year"])


def test_report_is_one_file(spark, tmp_path):
    path = tmp_path / "report"
    warehouse.write_report(spark.createDataFrame([("a", 0)], "column string, missing int"), str(path))
    (file,) = path.glob("*.csv")
    assert file.read_text() == "column,missing\na,0\n"
