"""Exact interpolated quantiles in two scans: a sketch says where to look, a second scan counts there.

The first scan takes count, mean, deviation, ends and a rank sketch of each column, an aggregate of fixed size. The sketch brackets each
wanted rank between two values. The second scan counts, in one grouping, the values in each bracket by the cells of an even grid, and those
outside without a grid. A cell that holds one value settles its ranks. A rank whose cell holds several values, or that the
sketch has bracketed wrongly, is looked for between the ends of that cell in a further scan, with a grid of its own; each one divides the
values by GRID, and none is needed where a bracket has fewer values than cells.

Whole numbers are counted as such, so that those beyond 2^53 stay apart. A missing value or NaN takes no part; -0.0 is 0.0. What comes to the
driver between scans is a row for each column and wanted rank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from monthmill.sources.lookups import inline_relation

#: Cells of a bracket.
GRID = 1 << 16
#: Size of the rank sketch, and by how much of the rows a bracket is wider on both sides than the ranks it is for.
SKETCH_K = 1600
MARGIN = 0.003


@dataclass
class _Column:
    """A column on its way: its moments, the value found for each rank, and where each open rank lies."""

    name: str
    whole: bool
    moments: dict
    found: dict[int, int | float] = field(default_factory=dict)
    brackets: list[tuple] = field(default_factory=list)  # (low, high, ranks), ascending and apart

    def value(self) -> Column:
        if self.whole:
            return F.col(self.name).cast("bigint")
        return F.nullif(F.col(self.name).cast("double"), F.lit(float("nan"))) + F.lit(0.0)

    def literal(self, number) -> Column:
        return F.lit(number).cast("bigint" if self.whole else "double")


def _first_scan(df: DataFrame, columns: list[str], probs: list[float]) -> list[_Column]:
    held = [_Column(name, isinstance(df.schema[name].dataType, T.IntegralType), {}) for name in columns]
    kinds = ["bigint" if column.whole else "double" for column in held]
    parts = []
    for i, column in enumerate(held):
        value = column.value()
        sketch = F.kll_sketch_agg_bigint if column.whole else F.kll_sketch_agg_double
        parts += [
            F.count(value).alias(f"count_{i}"), F.avg(value).alias(f"mean_{i}"), F.stddev(value).alias(f"std_{i}"),
            F.min(value).alias(f"min_{i}"), F.max(value).alias(f"max_{i}"), sketch(value, SKETCH_K).alias(f"sketch_{i}"),
        ]
    sides = [max(0.0, p - MARGIN) for p in probs] + [min(1.0, p + MARGIN) for p in probs]
    quantile = {"bigint": F.kll_sketch_get_quantile_bigint, "double": F.kll_sketch_get_quantile_double}
    shown = []
    for i, kind in enumerate(kinds):
        some = F.col(f"count_{i}") > 0
        shown += [F.col(f"{name}_{i}") for name in ("count", "mean", "std", "min", "max")]
        shown.append(F.array(*[F.when(some, quantile[kind](f"sketch_{i}", F.lit(side))) for side in sides]).alias(f"at_{i}"))
    row = df.agg(*parts).select(*shown).first()
    for i, column in enumerate(held):
        column.moments = {name: row[f"{name}_{i}"] for name in ("count", "mean", "std", "min", "max")}
        n = column.moments["count"]
        if n == 0:
            continue
        wanted: dict[tuple, set[int]] = {}
        for k, p in enumerate(probs):
            ends = row[f"at_{i}"][k], row[f"at_{i}"][k + len(probs)]
            wanted.setdefault(ends, set()).update((math.floor(p * (n - 1)), math.ceil(p * (n - 1))))
        column.brackets = _apart([(low, high, sorted(ranks)) for (low, high), ranks in wanted.items()])
    return held


def _apart(brackets: list[tuple]) -> list[tuple]:
    """Brackets in order, those that overlap united."""
    out: list[tuple] = []
    for low, high, ranks in sorted(brackets, key=lambda b: (b[0], b[1])):
        if out and low <= out[-1][1]:
            first, last, others = out[-1]
            out[-1] = (first, max(last, high), sorted({*others, *ranks}))
        else:
            out.append((low, high, ranks))
    return out


def _place(column: _Column, value: Column) -> tuple[Column, Column]:
    """The part of a column that a value is in, odd in a bracket and even between two, and its cell there."""
    part, cell = F.lit(2 * len(column.brackets)), F.lit(0)
    for i in range(len(column.brackets) - 1, -1, -1):
        low, high, _ = column.brackets[i]
        lower, upper = column.literal(low), column.literal(high)
        part = F.when(value < lower, 2 * i).when(value <= upper, 2 * i + 1).otherwise(part)
        if low < high:
            cell = F.when((value >= lower) & (value <= upper), _cell(column, value, low, high)).otherwise(cell)
    return part, cell


def _cell(column: _Column, value: Column, low, high) -> Column:
    """The cell of a value of a bracket, which never falls as the value grows; its two ends are in different ones."""
    if column.whole:
        width = float(int(high) - int(low))
        apart = (value.cast("decimal(20,0)") - F.lit(int(low)).cast("decimal(20,0)")).cast("double")
    elif math.isinf(low) or math.isinf(high):
        return F.when(value == float("-inf"), 0).when(value == float("inf"), 2).otherwise(1)
    else:
        scale = 0.25 if max(abs(low), abs(high)) > 1e300 else 1.0  # no difference of two numbers is infinite
        width, apart = high * scale - low * scale, value * scale - F.lit(low * scale)
    return F.least(F.lit(GRID - 1), F.floor(apart / width * GRID).cast("int"))


def _count_scan(df: DataFrame, open_: list[tuple[int, _Column]]) -> dict[int, list]:
    """For each column the cells that hold a wanted rank: (rank, least, greatest), from one scan and one grouping."""
    cells = []
    for i, column in open_:
        value = column.value()
        part, cell = _place(column, value)
        number, whole = (F.lit(None).cast("double"), value) if column.whole else (value, F.lit(None).cast("bigint"))
        cells.append(F.struct(F.lit(i).alias("i"), part.alias("part"), cell.alias("cell"), number.alias("number"), whole.alias("whole")))
    rows = df.select(F.inline(F.array(*cells))).filter("number IS NOT NULL OR whole IS NOT NULL")
    ends = [f(name).alias(f"{side}_{name}") for name in ("number", "whole") for side, f in (("least", F.min), ("greatest", F.max))]
    counts = rows.groupBy("i", "part", "cell").agg(F.count("*").alias("n"), *ends)
    # A column has at most GRID rows for each bracket here, and one for each place between two.
    upto = Window.partitionBy("i").orderBy("part", "cell").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("below", F.coalesce(F.sum("n").over(upto), F.lit(0)))
    wanted = {i: sorted({rank for *_, ranks in column.brackets for rank in ranks}) for i, column in open_}
    hit = F.lit(False)
    for i, ranks in wanted.items():
        inside = [(F.col("below") <= rank) & (F.lit(rank) < F.col("below") + F.col("n")) for rank in ranks]
        hit = hit | ((F.col("i") == i) & reduce(or_, inside))
    out: dict[int, list] = {i: [] for i in wanted}
    for row in placed.filter(hit).collect():
        whole = dict(open_)[row.i].whole
        least, greatest = (row.least_whole, row.greatest_whole) if whole else (row.least_number, row.greatest_number)
        out[row.i] += [(rank, least, greatest) for rank in wanted[row.i] if row.below <= rank < row.below + row.n]
    return out


def bracketed_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """column, total, mean, std, min, max and ``values``: one per probability, interpolated between neighbours."""
    held = _first_scan(df, columns, probs)
    while open_ := [(i, column) for i, column in enumerate(held) if column.brackets]:
        for i, cells in _count_scan(df, open_).items():
            column, again = held[i], {}
            for rank, least, greatest in cells:
                if least == greatest:
                    column.found[rank] = least
                else:
                    again.setdefault((least, greatest), []).append(rank)
            column.brackets = _apart([(low, high, ranks) for (low, high), ranks in again.items()])
    rows = []
    for column in held:
        m = column.moments
        if m["count"]:
            values = []
            for p in probs:
                spot = p * (m["count"] - 1)
                low, high = column.found[math.floor(spot)], column.found[math.ceil(spot)]
                values.append(float(low) if low == high else float(low) + (float(high) - float(low)) * (spot - math.floor(spot)))
            rows.append((column.name, m["count"], float(m["mean"]), m["std"], float(m["min"]), float(m["max"]), values))
    ddl = "column string, total bigint, mean double, std double, min double, max double, values array<double>"
    return df.sparkSession.createDataFrame(rows, ddl)


def describe_bracketed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of `quantiles.describe`: count, mean, std, min, three exact quartiles, max; null where all is missing."""
    quartiles = bracketed_quantiles(df, columns, [0.25, 0.5, 0.75])
    every = inline_relation(df.sparkSession, [(name,) for name in columns], "column string")
    places = [F.col("values")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]
    return every.join(quartiles, "column", "left").select("column", F.coalesce("total", F.lit(0)).alias("count"), "mean", "std", "min", *places, "max")
