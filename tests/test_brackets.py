"""Exact quantiles from a sketch and a count."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from monthmill.operators import brackets, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]


@pytest.fixture
def scans(monkeypatch):
    """How many times the rows are counted after the first scan."""
    seen = []
    real = brackets._count_scan
    monkeypatch.setattr(brackets, "_count_scan", lambda df, open_: seen.append(len(open_)) or real(df, open_))
    return seen


def values_of(spark, numbers, kind="double"):
    df = spark.createDataFrame([(x,) for x in numbers], f"x {kind}").repartition(4)
    return brackets.bracketed_quantiles(df, ["x"], PROBS).first()


def sets():
    rng = random.Random(3)
    return {
        "many": [rng.gauss(0, 1) * 10 ** rng.randint(-5, 5) for _ in range(5000)],
        "few": [float(rng.choice([1, 2, 3])) for _ in range(2000)],
        "one": [4.5] * 300,
        "two rows": [1.0, 2.0],
        "signs of zero": [-0.0, 0.0, -1.0, 1.0],
        "hot": [7.0] * 2000 + [rng.random() for _ in range(900)],
        "far apart": [10.0**k for k in range(-300, 300, 3)] + [-(10.0**k) for k in range(-300, 300, 7)],
        "tiny": [5e-324 * k for k in range(40)],
        "huge": [1.7e308, -1.7e308, 1.6e308, 0.0, 1.0],
    }


@pytest.mark.parametrize("name", list(sets()))
def test_agrees_with_sorted_values(spark, name):
    numbers = sets()[name]
    got = values_of(spark, numbers)
    ordered, want = sorted(numbers), []
    for p in PROBS:
        spot = p * (len(ordered) - 1)
        low, high = ordered[math.floor(spot)], ordered[math.ceil(spot)]
        want.append(low if low == high else low + (high - low) * (spot - math.floor(spot)))
    assert got["values"] == pytest.approx(want, rel=1e-12, abs=0)
    assert (got.total, got["min"], got["max"]) == (len(ordered), ordered[0], ordered[-1])


def test_two_scans_are_enough_for_few_values_a_cell(spark, scans):
    df = spark.range(0, 200_000, 1, 4).select((F.col("id") * 7919 % 200_003).alias("a"), F.rand(5).alias("b"), (F.col("id") % 3).alias("c"))
    got = {row.column: row for row in brackets.bracketed_quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.75]).collect()}
    assert scans[0] == 3 and len(scans) <= 2 and sum(scans[1:]) <= 1
    want = {row.column: row for row in quantiles.exact_quantiles(df, ["a", "b", "c"], [0.25, 0.5, 0.75]).collect()}
    for name, row in got.items():
        assert row["values"] == pytest.approx(want[name]["values"], rel=1e-14) and row.total == want[name].total
        assert [row["mean"], row["std"], row["min"], row["max"]] == pytest.approx([want[name][x] for x in ("mean", "std", "min", "max")], rel=1e-9)


def test_wrong_brackets_and_small_grids_only_cost_scans(spark, monkeypatch, scans):
    for name, value in (("MARGIN", 0.0), ("SKETCH_K", 8), ("GRID", 4)):
        monkeypatch.setattr(brackets, name, value)
    numbers = sets()["many"][:700]
    got = values_of(spark, numbers)
    assert got["values"] == pytest.approx(np.quantile(numbers, PROBS).tolist(), rel=1e-12) and len(scans) > 2


def test_whole_numbers_beyond_doubles_stay_apart(spark):
    base = 2**53
    numbers = [base + k for k in range(1, 100)] + [-(2**63), 2**63 - 1]
    df = spark.createDataFrame([(x,) for x in numbers], "x bigint")
    (column,) = brackets._first_scan(df, ["x"], [0.5])
    while column.brackets:
        again = {}
        for rank, least, greatest in brackets._count_scan(df, [(0, column)])[0]:
            if least == greatest:
                column.found[rank] = least
            else:
                again.setdefault((least, greatest), []).append(rank)
        column.brackets = brackets._apart([(low, high, ranks) for (low, high), ranks in again.items()])
    assert column.found == {50: sorted(numbers)[50]}


def test_missing_infinite_and_no_values(spark):
    nan, inf = float("nan"), float("inf")
    df = spark.createDataFrame([(1.0, None, nan, inf), (nan, None, nan, -inf), (None, None, nan, 2.0), (3.0, None, nan, inf)], "a double, b int, c double, d double")
    got = {row.column: row for row in brackets.describe_bracketed(df, ["a", "b", "c", "d"]).collect()}
    assert (got["a"]["count"], got["a"].q25, got["a"].q50, got["a"].q75) == (2, 1.5, 2.0, 2.5)
    assert got["b"]["count"] == got["c"]["count"] == 0 and got["b"].q50 is got["c"].q50 is None
    assert got["d"]["count"] == 4 and got["d"].q75 == inf and got["d"].min == -inf
    assert brackets.describe_bracketed(df.limit(0), ["a"]).first()["count"] == 0
