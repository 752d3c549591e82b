"""Profiles of months from stored sketches; maps at any depth in the exact profile."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from monthmill.operators.profile import profile
from monthmill.plans import profiles

ROWS = 60_000


@pytest.fixture(scope="module")
def trips(spark):
    """Six months; a column with many values, one with few, one with missing ones, one that changes its sign."""
    n = F.col("id")
    return spark.range(0, ROWS, 1, 4).select(
        F.lit(2024).alias("year"), (n % 6 + 1).cast("int").alias("month"), n.alias("trip"), (n % 7).cast("int").alias("code"),
        F.when(n % 10 != 0, (n % 4000 - 1000) / 8).alias("amount"), F.concat(F.lit("zone "), n % 300).alias("zone"),
    )


@pytest.fixture(scope="module")
def stored(spark, trips, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("profiles"))
    profiles.store_profiles(trips, path)
    return path


@pytest.mark.parametrize("months", [(1, 6), (2, 3), (5, 5)])
def test_range_agrees_with_the_exact_profile(spark, trips, stored, months):
    some = trips.filter(F.col("month").between(*months)).drop("year", "month")
    exact = {row.column: row for row in profile(some).collect()}
    found = profiles.range_profile(profiles.stored_profiles(spark, stored).filter(F.col("month").between(*months)))
    rows = {row.column: row for row in found.collect()}
    assert set(rows) == set(exact)
    for name, row in rows.items():
        assert (row.n_rows, row.missing_count, row.missing_pct) == (some.count(), exact[name].missing_count, exact[name].missing_pct)
        assert row.unique_low <= exact[name].unique_count <= row.unique_high
        assert abs(row.unique_count - exact[name].unique_count) <= profiles.DISTINCT_BOUND * exact[name].unique_count + 1
    amount = rows["amount"]
    want = some.agg(F.min("amount"), F.max("amount"), F.count_if(F.col("amount") < 0), F.avg("amount")).first()
    assert (amount.least, amount.greatest, amount.negative_count) == tuple(want)[:3] and amount.mean == pytest.approx(want[3])
    for name, share in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
        below, upto = some.filter("amount is not null").agg(F.avg((F.col("amount") < amount[name]).cast("int")), F.avg((F.col("amount") <= amount[name]).cast("int"))).first()
        assert below - profiles.RANK_BOUND <= share <= upto + profiles.RANK_BOUND
    assert rows["zone"].q50 is None and rows["zone"].least is None


def test_the_trips_are_not_read(spark, stored):
    found = profiles.range_profile(profiles.stored_profiles(spark, stored).filter("month <= 2"))
    assert all("/profiles" in file or stored in file for file in found.inputFiles())


def test_a_month_stored_again_takes_its_place(spark, trips, tmp_path):
    path = str(tmp_path)
    profiles.store_profiles(trips.filter("month <= 3"), path)
    profiles.store_profiles(trips.filter("month = 2").limit(10), path)
    counts = {(row.month, row.column): row.n_rows for row in profiles.stored_profiles(spark, path).collect()}
    assert counts[1, "trip"] == counts[3, "trip"] == ROWS // 6 and counts[2, "trip"] == 10


def test_a_type_that_changes_is_one_value(spark, tmp_path):
    path = str(tmp_path)
    for month, kind in ((1, "double"), (2, "bigint"), (3, "int")):
        rows = spark.range(50).select(F.lit(2024).alias("year"), F.lit(month).alias("month"), F.col("id").cast(kind).alias("code"))
        profiles.store_profiles(rows, path)
    (row,) = profiles.range_profile(profiles.stored_profiles(spark, path)).collect()
    assert (row.unique_count, row.dtypes, row.n_rows) == (50, "bigint, double, int", 150)


def test_nothing_but_missing_values(spark, tmp_path):
    path = str(tmp_path)
    rows = spark.createDataFrame([(2024, 1, None, None, float("nan"))] * 3, "year int, month int, a int, b string, c double")
    profiles.store_profiles(rows, path)
    for row in profiles.range_profile(profiles.stored_profiles(spark, path)).collect():
        assert (row.missing_count, row.unique_count, row.q50, row.least, row.mean) == (3, 1, None, None, None)


def test_nested_columns_are_refused(spark):
    with pytest.raises(TypeError, match="sketches"):
        profiles.month_profiles(spark.range(1).select(F.lit(1).alias("year"), F.lit(1).alias("month"), F.array("id").alias("ids")))


def test_maps_at_any_depth_are_compared_by_content(spark):
    one, other = "map('a', 1, 'b', 2)", "map('b', 2, 'a', 1)"
    kinds = ["{0}", "array({0}, null)", "named_struct('m', {0}, 'n', 1)", "array(named_struct('m', array({0})))", "map('k', {0})", "named_struct('x', map(1, {0}))"]
    texts = [", ".join(f"{kind.format(value)} AS c{i}" for i, kind in enumerate(kinds)) for value in (one, other, "map('a', 1, 'b', 3)")]
    df = spark.sql(" UNION ALL ".join(f"SELECT {text}" for text in texts))
    assert {row.column: row.unique_count for row in profile(df).collect()} == {f"c{i}": 2 for i in range(len(kinds))}
    nulls = spark.sql(f"SELECT named_struct('m', {one}) AS s UNION ALL SELECT null UNION ALL SELECT named_struct('m', null)")
    assert profile(nulls).first().unique_count == 3
