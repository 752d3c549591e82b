"""The star reloaded as a whole, and the fact as a stored view."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthmill.plans import star, stored
from monthmill.plans.fact import fact_trips
from monthmill.plans.star import Link, StarError, reload_star
from monthmill.sources.eras import found_eras
from tests.trip_frames import MONTHS, month_frame, write_layout

KEYS = {"dim_payment": "payment_type", "dim_location": "location_id"}
LINKS = [Link("payment_type", "dim_payment", "payment_type"), Link("pickup_location_id", "dim_location", "location_id")]


def frames(spark, fact=((1, 10, 3600), (2, 20, 7200)), payments=((1, "Card"), (2, "Cash")), places=((10, "Pier"), (20, "Pond"))):
    return (
        spark.createDataFrame(list(fact), "payment_type int, pickup_location_id int, pickup_time int"),
        {
            "dim_payment": spark.createDataFrame(list(payments), "payment_type int, payment_desc string"),
            "dim_location": spark.createDataFrame(list(places), "location_id int, zone string"),
        },
    )


def load(spark, namespace, strict=True, **changes):
    fact, dimensions = frames(spark, **changes)
    return reload_star(spark, namespace, fact, dimensions, KEYS, LINKS, strict)


@pytest.fixture
def namespace(spark):
    """A namespace that is not there yet, with nothing of it left afterwards; a table outside it that has to stay."""
    name = "mill_star"
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
    spark.sql("DROP TABLE IF EXISTS fact_trips")
    spark.range(7).write.saveAsTable("fact_trips")
    yield name
    assert spark.table("fact_trips").count() == 7
    spark.sql("DROP TABLE fact_trips")
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def tables(spark, namespace):
    return sorted(row.tableName for row in spark.sql(f"SHOW TABLES IN {namespace}").collect() if not row.isTemporary)


def asked(spark, namespace):
    text = f"""SELECT zone, payment_desc, pickup_time FROM {namespace}.fact_trips
        LEFT JOIN {namespace}.dim_payment USING (payment_type) LEFT JOIN {namespace}.dim_location ON location_id = pickup_location_id"""
    return sorted(tuple(row) for row in spark.sql(text).collect())


STAR = ["dim_location", "dim_payment", "fact_trips"]
FIRST = [("Pier", "Card", 3600), ("Pond", "Cash", 7200)]


def test_reload_of_a_star_that_exists(spark, namespace):
    found = load(spark, namespace)
    assert sorted(tuple(row) for row in found.collect()) == [
        ("foreign", "payment_type -> dim_payment", 0, 0), ("foreign", "pickup_location_id -> dim_location", 0, 0),
        ("primary", "dim_location", 0, 0), ("primary", "dim_payment", 0, 0),
    ]
    assert tables(spark, namespace) == STAR and asked(spark, namespace) == FIRST
    load(spark, namespace, fact=((1, 20, 60),), payments=((1, "Credit card"),))
    assert tables(spark, namespace) == STAR and asked(spark, namespace) == [("Pond", "Credit card", 60)]


@pytest.mark.parametrize(
    ("changes", "text"),
    [
        ({"payments": ((1, "Card"), (1, "Cash"))}, "primary dim_payment: 1 keys, 1 rows"),
        ({"payments": ((1, "Card"), (2, "Cash"), (None, "Other"))}, "primary dim_payment: 1 keys, 1 rows"),
        ({"fact": ((1, 10, 1), (9, 10, 2), (9, 20, 3))}, "foreign payment_type -> dim_payment: 1 keys, 2 rows"),
    ],
)
def test_violated_keys_leave_the_old_star(spark, namespace, changes, text):
    load(spark, namespace)
    with pytest.raises(StarError, match=text):
        load(spark, namespace, **changes)
    assert tables(spark, namespace) == STAR and asked(spark, namespace) == FIRST
    found = load(spark, namespace, strict=False, **changes)
    assert text in [f"{row.kind} {row.name}: {row.key_values} keys, {row.rows} rows" for row in found.collect()]
    assert tables(spark, namespace) == STAR


def test_null_foreign_keys_pass(spark, namespace):
    load(spark, namespace, fact=((None, None, 5),))
    assert asked(spark, namespace) == [(None, None, 5)]


def test_a_load_that_fails_leaves_the_old_star(spark, namespace):
    load(spark, namespace)
    fact, dimensions = frames(spark)
    broken = fact.withColumn("pickup_time", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        reload_star(spark, namespace, broken, dimensions, KEYS, LINKS)
    assert tables(spark, namespace) == STAR and asked(spark, namespace) == FIRST


@pytest.mark.parametrize("step", range(1, 7))
def test_a_switch_that_fails_is_taken_back(spark, namespace, monkeypatch, step):
    load(spark, namespace)
    real, renamed = spark.sql, []

    def sql(text, *args, **options):
        if " RENAME TO " in text:
            renamed.append(text)
            if len(renamed) == step:
                raise OSError("catalog gone")
        return real(text, *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(spark, "sql", sql, raising=False)
        with pytest.raises(OSError, match="catalog gone"):
            load(spark, namespace, fact=((1, 20, 60),))
    assert tables(spark, namespace) == STAR and asked(spark, namespace) == FIRST


def test_only_the_namespace_is_dropped_from(spark, namespace):
    load(spark, namespace)
    star.drop_star(spark, namespace, list(KEYS))
    assert tables(spark, namespace) == []
    with pytest.raises(ValueError, match="namespace"):
        star.drop_tables(spark, namespace, ["default.fact_trips"])


# --- stored view ---


@pytest.fixture
def base(spark, tmp_path):
    path = str(tmp_path / "trips")
    write_layout(spark, path, MONTHS[:4])
    return path


def counts(frame):
    return sorted(tuple(row) for row in frame.groupBy("year", "month").agg(F.count("*"), F.sum("rate_code_id"), F.sum("passenger_count")).collect())


def test_view_of_another_session(spark, namespace, base):
    view = stored.store_fact_view(spark, namespace, base)
    other = spark.newSession()
    assert other.table(view).schema == fact_trips(spark, base).schema
    assert counts(other.table(view)) == counts(fact_trips(spark, base))
    assert sorted(map(repr, other.table(view).collect())) == sorted(map(repr, fact_trips(spark, base).collect()))


def test_view_reads_the_folders_of_a_filter(spark, namespace, base):
    view = stored.store_fact_view(spark, namespace, base)
    months = spark.newSession().table(view).filter("year = 2023 AND month = 2").select("trip_distance")
    (file,) = months.inputFiles()
    assert "/year=2023/month=02/" in file and months.count() == 7


def test_view_stored_again_after_a_month_landed(spark, namespace, base):
    view = stored.store_fact_view(spark, namespace, base)
    month_frame(spark, 2025, 5, 6).coalesce(1).write.parquet(f"{base}/year=2025/month=05")
    assert spark.table(view).count() == 26
    stored.store_fact_view(spark, namespace, base)
    assert spark.table(view).count() == 32 and spark.table(view).filter("year = 2025").count() == 6
    assert len(tables(spark, namespace)) == 5  # four eras and the view


def test_view_of_found_eras(spark, namespace, base):
    month_frame(spark, 2024, 4, 3, "double").coalesce(1).write.parquet(f"{base}/year=2024/month=04")
    view = stored.store_fact_view(spark, namespace, base, found_eras(spark, base))
    assert spark.newSession().table(view).count() == 29
    assert dict(spark.table(view).dtypes)["rate_code_id"] == "bigint"


def test_a_month_without_an_era_leaves_the_old_view(spark, namespace, base):
    view = stored.store_fact_view(spark, namespace, base)
    month_frame(spark, 2020, 1, 3).coalesce(1).write.parquet(f"{base}/year=2020/month=01")
    with pytest.raises(ValueError, match="2020-01"):
        stored.store_fact_view(spark, namespace, base)
    assert spark.table(view).count() == 26
