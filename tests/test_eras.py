"""Eras found in the footers of hand-made monthly files."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthmill.plans.fact import fact_trips
from monthmill.sources.eras import found_eras, month_signatures, schema_islands
from monthmill.sources.files import partition_files
from tests.trip_frames import month_frame

TYPES = [((2023, 11), "double", "double"), ((2023, 12), "bigint", "double"), ((2024, 2), "bigint", "double"), ((2024, 3), "double", "double"),
         ((2024, 4), "bigint", "bigint"), ((2025, 1), "bigint", "bigint")]


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trips"))
    for i, ((year, month), rate, count) in enumerate(TYPES):
        frame = month_frame(spark, year, month, 4 + i).withColumn("ratecodeid", F.col("ratecodeid").cast(rate))
        frame = frame.withColumn("passenger_count", F.col("passenger_count").cast(count)).withColumnRenamed("ratecodeid", "RatecodeID" if i % 2 else "ratecodeid")
        frame.repartition(2).write.parquet(f"{path}/year={year}/month={month:02d}")
    return path


def islands(spark, base, columns=None):
    return [tuple(row) for row in schema_islands(partition_files(spark, base), columns).orderBy("island").collect()]


def test_a_type_that_returns_is_an_island_of_its_own(spark, base):
    text = "ratecodeid {}, passenger_count {}"
    assert islands(spark, base) == [
        (1, text.format("double", "double"), 202311, 202311, 1, 2),
        (2, text.format("int64", "double"), 202312, 202402, 2, 4),
        (3, text.format("double", "double"), 202403, 202403, 1, 2),
        (4, text.format("int64", "int64"), 202404, 202501, 2, 4),
    ]
    assert [row[1:4] for row in islands(spark, base, ["Passenger_Count"])] == [
        ("passenger_count double", 202311, 202403),
        ("passenger_count int64", 202404, 202501),
    ]


def test_found_eras_are_read(spark, base, rows):
    eras = found_eras(spark, base)
    assert [(era.first, era.last, dict(era.types)["ratecodeid"]) for era in eras] == [
        ((2023, 11), (2023, 11), "double"), ((2023, 12), (2024, 2), "bigint"), ((2024, 3), (2024, 3), "double"), ((2024, 4), (2025, 1), "bigint"),
    ]
    fact = fact_trips(spark, base, eras)
    assert {kind for name, kind in fact.dtypes if name in ("rate_code_id", "passenger_count")} == {"bigint"}
    assert rows(fact.groupBy("year", "month").count()) == [(*month, 4 + i) for i, (month, _, _) in enumerate(TYPES)]
    assert rows(fact.groupBy("rate_code_id").count())[0][0] == 1


def test_eras_of_a_filter_read_nothing_else(spark, base):
    plan = fact_trips(spark, base, found_eras(spark, base)).filter("year = 2025")
    assert len(plan.inputFiles()) == 12 and plan.count() == 9
    assert plan.select("trip_distance").filter("month = 1")._jdf.queryExecution().optimizedPlan().toString().count("Union") <= 1


def test_a_later_month_needs_its_era(spark, base, tmp_path):
    eras = found_eras(spark, base)[:-1]
    with pytest.raises(ValueError, match="2024-04"):
        fact_trips(spark, base, eras)


def test_files_of_a_month_that_differ(spark, tmp_path):
    path = str(tmp_path)
    month_frame(spark, 2024, 1, 3, "double").coalesce(1).write.parquet(f"{path}/year=2024/month=01")
    month_frame(spark, 2024, 2, 3, "double").coalesce(1).write.parquet(f"{path}/year=2024/month=02")
    month_frame(spark, 2024, 2, 3, "bigint").coalesce(1).write.mode("append").parquet(f"{path}/year=2024/month=02")
    assert [row[2:4] for row in islands(spark, path)] == [(202401, 202401), (202402, 202402)]
    with pytest.raises(ValueError, match="202402"):
        found_eras(spark, path)


def test_columns_that_are_absent(spark, tmp_path, rows):
    path = str(tmp_path)
    month_frame(spark, 2024, 1, 3).drop("passenger_count").coalesce(1).write.parquet(f"{path}/year=2024/month=01")
    month_frame(spark, 2024, 2, 3).coalesce(1).write.parquet(f"{path}/year=2024/month=02")
    month_frame(spark, 2024, 3, 3).drop("passenger_count", "ratecodeid").coalesce(1).write.parquet(f"{path}/year=2024/month=03")
    assert rows(month_signatures(partition_files(spark, path)), "month", "signatures")[0][1] == ["ratecodeid int64, passenger_count absent"]
    fact = fact_trips(spark, path, found_eras(spark, path))
    assert rows(fact.groupBy("month").agg(F.count("rate_code_id"), F.count("passenger_count"))) == [(1, 3, 0), (2, 3, 3), (3, 0, 0)]


def test_a_type_that_cannot_be_declared(spark, tmp_path):
    path = str(tmp_path)
    month_frame(spark, 2024, 1, 3).withColumn("ratecodeid", F.lit(True)).coalesce(1).write.parquet(f"{path}/year=2024/month=01")
    with pytest.raises(ValueError, match="bool"):
        found_eras(spark, path)


def test_no_files(spark, tmp_path):
    assert found_eras(spark, str(tmp_path)) == []
