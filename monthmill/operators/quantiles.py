"""Exact interpolated quantiles without bringing a column's values into one task.

Every pass counts values per cell of a logarithmic grid and keeps only the cells that hold a wanted
rank; the next pass splits those cells on a finer grid, the last one by value. Each pass therefore
shuffles counts, not values, and the number of counts has a fixed bound: 2**10 cells per power of
two, then 2**20 per kept cell, then what fits between neighbours at 30 bits. Count, mean, deviation
and ends come from the cells of the first pass. Values are compared as doubles, which are exact for
whole numbers up to 2**53.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.sources.lookups import inline_relation

COARSE_BITS = 10
FINE_BITS = 30
LOWEST_EXPONENT = -900  # smaller magnitudes share the lowest octave; order is kept all the same
PAST_FINITE = 1 << 62


def long_form(df: DataFrame, columns: list[str]) -> DataFrame:
    """column and v (double), one row per non-missing cell; NaN counts as missing, -0.0 as 0.0."""
    nan = F.lit(float("nan"))
    values = [(F.nullif(F.col(c).cast("double"), nan) + F.lit(0.0)).alias(c) for c in columns]
    return df.select(*values).unpivot([], columns, "column", "v").filter(F.col("v").isNotNull())


def _cell(value: Column, bits: int) -> Column:
    """Grid cell as a bigint that grows with the value."""
    size = F.abs(value)
    exponent = F.greatest(F.floor(F.log2(size)).cast("int"), F.lit(LOWEST_EXPONENT))
    mantissa = F.floor(size * F.pow(F.lit(2.0), F.lit(bits) - exponent)).cast("long")
    octave = (exponent - F.lit(LOWEST_EXPONENT - 1)).cast("long")
    place = octave * F.lit(2 << bits) + mantissa
    place = F.when(size == F.lit(float("inf")), F.lit(PAST_FINITE)).otherwise(place)
    return F.when(value > 0, place).when(value < 0, -place).otherwise(F.lit(0).cast("long"))


BASIC = ["mean", "std", "min", "max"]


def _counted(cells: DataFrame, group: list, cell: Column, more: list[Column]) -> DataFrame:
    """Values per cell, with the smallest and largest: cells are disjoint, so these bound it."""
    return cells.groupBy(*group, cell.alias("cell")).agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), *more
    )


def _with_basic(coarse: DataFrame) -> DataFrame:
    """Count, mean, sample deviation and ends of each column, from the sums and variances of its cells."""
    column = Window.partitionBy("column")
    sized = coarse.withColumn("total", F.sum("n").over(column)).withColumn("mean", F.sum("sum").over(column) / F.col("total"))
    apart = F.col("sum") / F.col("n") - F.col("mean")
    squares = F.sum(F.col("n") * (F.col("var") + apart * apart)).over(column)
    return sized.withColumns(
        {
            "std": F.sqrt(squares / F.nullif(F.col("total") - 1, F.lit(0))),
            "min": F.min("lo").over(column),
            "max": F.max("hi").over(column),
        }
    )


def _holding(counts: DataFrame, group: list, start: Column) -> DataFrame:
    """The cells that hold a wanted rank, each with those ranks and the count of values below it."""
    upto = Window.partitionBy(*group).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    below = start + F.coalesce(F.sum("n").over(upto), F.lit(0))
    inside = F.filter("ranks", lambda r: (r >= F.col("below")) & (r < F.col("below") + F.col("n")))
    kept = counts.withColumn("below", below).withColumn("ranks", inside)
    return kept.filter(F.size("ranks") > 0).select("column", "total", *BASIC, "ranks", "below", "lo", "hi")


def exact_quantiles(df: DataFrame, columns: list[str], probs: list[float]) -> DataFrame:
    """column, total, mean, std, min, max and ``values``: one per probability, interpolated between neighbours."""
    cells = long_form(df, columns)

    moments = [F.sum("v").alias("sum"), F.var_pop("v").alias("var")]
    coarse = _with_basic(_counted(cells, ["column"], _cell(F.col("v"), COARSE_BITS), moments))
    spot = [(F.col("total") - 1) * F.lit(float(p)) for p in probs]
    wanted = F.array(*[f(s).cast("long") for s in spot for f in (F.floor, F.ceil)])
    coarse = coarse.withColumn("ranks", F.array_distinct(wanted))
    kept = _holding(coarse, ["column"], F.lit(0))

    for finer in (_cell(F.col("v"), FINE_BITS), F.col("v")):
        # At most two cells per probability and column: the broadcast does not grow with the data.
        held = F.broadcast(kept.withColumnRenamed("column", "kept_column"))
        here = (F.col("column") == F.col("kept_column")) & F.col("v").between(F.col("lo"), F.col("hi"))
        group = ["column", "total", "ranks", F.col("below").alias("start")]
        carried = [F.any_value(name).alias(name) for name in BASIC]
        split = _counted(cells.join(held, here).drop("lo", "hi"), group, finer, carried)
        kept = _holding(split, ["column", "start"], F.col("start"))

    found = kept.select("column", "total", *BASIC, F.explode("ranks").alias("rank"), F.col("lo").alias("v"))
    ranked = found.groupBy("column", "total").agg(
        F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"),
        *[F.any_value(name).alias(name) for name in BASIC],
    )
    results = []
    for s in spot:
        low = F.element_at("at", F.floor(s).cast("long"))
        high = F.element_at("at", F.ceil(s).cast("long"))
        results.append(low + (high - low) * (s - F.floor(s)))
    return ranked.select("column", "total", *BASIC, F.array(*results).alias("values"))


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: count, mean, std, min, three exact quartiles, max; null where all is missing."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    every = inline_relation(df.sparkSession, [(name,) for name in columns], "column string")
    return (
        every.join(quartiles, "column", "left")
        .select(
            "column",
            F.coalesce("total", F.lit(0)).alias("count"),
            "mean",
            "std",
            "min",
            F.col("values")[0].alias("q25"),
            F.col("values")[1].alias("q50"),
            F.col("values")[2].alias("q75"),
            "max",
        )
    )
