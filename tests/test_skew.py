"""A key that holds a third of all rows: results stay whole and the work is split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthmill.operators import keys, profile, quantiles, sets
from monthmill.operators.joins import join_lookup
from monthmill.plans import lakehouse

ROWS = 60_000


@pytest.fixture
def hot(spark):
    """Every third row has location 0; the others are spread over 1000 locations."""
    place = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000)
    return spark.range(0, ROWS, 1, 8).select(
        place.alias("pickup_location_id"), (F.col("id") % 100 / 4).alias("tip_amount"), "id"
    )


@pytest.fixture
def zones(spark):
    return spark.range(1000).select(
        F.col("id").alias("location_id"), F.concat(F.lit("zone "), F.col("id") % 7).alias("zone")
    )


@pytest.fixture
def small_limits(spark):
    """Limits scaled down to the test's size, as if the lookup were too large to broadcast."""
    limits = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {name: spark.conf.get(name, None) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.usefixtures("small_limits")
def test_lookup_join_splits_the_hot_key(hot, zones):
    joined = join_lookup(hot, zones, "pickup_location_id", "location_id")
    counts = joined.groupBy("zone").agg(F.count("*").alias("n"))
    assert "skew=true" in final_plan(counts)
    assert sum(row.n for row in counts.collect()) == ROWS


@pytest.mark.usefixtures("small_limits")
def test_top_zones_are_whole(hot, zones):
    top = lakehouse.top_zones_from_fact(hot, zones).collect()
    assert sum(row.trips for row in top) == ROWS and top[0].zone == "zone 0"


@pytest.mark.usefixtures("small_limits")
def test_foreign_keys_with_a_hot_orphan(hot, zones):
    known = zones.filter("location_id > 0")
    checked = keys.foreign_key_violations([("c", hot, "pickup_location_id", known, "location_id")])
    row = checked.first()
    assert (row.orphan_keys, row.orphan_rows) == (1, hot.filter("pickup_location_id = 0").count())


def test_first_of_a_hot_key(hot):
    got = sets.first_per_key(hot, ["pickup_location_id"], ["id"])
    assert got.filter("pickup_location_id = 0").first().id == 0
    assert got.count() == hot.select("pickup_location_id").distinct().count()


def test_profile_and_duplicates_with_hot_values(hot):
    report = {row.column: row.unique_count for row in profile.profile(hot).collect()}
    distinct = hot.select("pickup_location_id").distinct().count()
    assert report == {"pickup_location_id": distinct, "tip_amount": 100, "id": ROWS}
    repeats = profile.duplicate_rows(hot.select("pickup_location_id")).first()
    assert repeats.duplicate_rows == ROWS - distinct


def test_quantiles_with_a_hot_value(hot):
    exact = hot.select(F.expr("percentile(pickup_location_id, array(0.2, 0.34, 0.9))")).first()[0]
    row = quantiles.exact_quantiles(hot, ["pickup_location_id"], [0.2, 0.34, 0.9]).first()
    assert row["values"] == pytest.approx(exact)
