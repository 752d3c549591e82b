"""Primary and foreign key checks: Spark enforces none, so violations are counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.operators.sets import union_all


def primary_key_violations(tables: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """table_name, null_keys (rows), repeated_keys (key values), extra_rows (beyond the first)."""
    results = []
    for name, df, keys in tables:
        some_null = F.lit(False)
        for key in keys:
            some_null = some_null | F.col(key).isNull()
        groups = df.groupBy(*keys).agg(F.count("*").alias("__n"))
        repeated = ~some_null & (F.col("__n") > 1)
        results.append(
            groups.agg(
                F.coalesce(F.sum(F.when(some_null, F.col("__n"))), F.lit(0)).alias("null_keys"),
                F.count_if(repeated).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(repeated, F.col("__n") - 1)), F.lit(0)).alias("extra_rows"),
            ).select(F.lit(name).alias("table_name"), "null_keys", "repeated_keys", "extra_rows")
        )
    return union_all(results)


def foreign_key_violations(
    constraints: list[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """constraint_name, orphan_keys, orphan_rows per (name, child, key, parent, parent key).

    Null keys pass. Only the key column is read. The child is reduced to its distinct keys with
    counts before it meets the parent's, and the join reuses the grouping's partitioning. It is a left
    join kept where nothing matched: an anti join would be moved below the grouping, where a key
    that many rows share is not yet reduced to one.
    """
    results = []
    for name, child, key, parent, parent_key in constraints:
        used = (
            child.filter(F.col(key).isNotNull())
            .groupBy(F.col(key).alias("__key"))
            .agg(F.count("*").alias("__n"))
        )
        known = parent.select(F.col(parent_key).alias("__parent"), F.lit(True).alias("__found")).distinct()
        matched = used.join(known, F.col("__key") == F.col("__parent"), "left")
        orphans = matched.filter(F.col("__found").isNull())
        results.append(
            orphans.agg(
                F.count("*").alias("orphan_keys"),
                F.coalesce(F.sum("__n"), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(name).alias("constraint_name"), "orphan_keys", "orphan_rows")
        )
    return union_all(results)


def _common_type(kinds: set[str]) -> str:
    """The type in which keys are compared, as a join of the columns would compare them."""
    if len(kinds) == 1:
        return kinds.pop()
    if kinds <= {"tinyint", "smallint", "int", "bigint"}:
        return "bigint"
    return "double" if kinds <= {"tinyint", "smallint", "int", "bigint", "float", "double"} else "string"


def foreign_keys_at_once(
    constraints: list[tuple[str, DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """The rows of `foreign_key_violations`, from one scan of each frame and one grouping for all constraints.

    Each frame is scanned once, for whatever constraints it takes part in, on either side: its keys become rows of
    (parent, key), which are grouped once. A group knows whether the parent has the key and how many rows of each constraint use it, so
    there is no join, and a key that many rows share is one row per task before it is shuffled.
    """
    parents: dict[tuple[int, str], int] = {}  # a parent's frame and key -> its number
    frames: dict[int, DataFrame] = {}
    kinds: dict[int, set[str]] = {}
    ends: list[tuple[int, str, int, int | None]] = []  # frame, key, parent, constraint (None for the parent's own keys)
    for i, (_, child, key, parent, parent_key) in enumerate(constraints):
        number = parents.setdefault((id(parent), parent_key), len(parents))
        frames |= {id(child): child, id(parent): parent}
        kinds.setdefault(number, set()).update({child.schema[key].dataType.simpleString(), parent.schema[parent_key].dataType.simpleString()})
        ends += [(id(child), key, number, i), (id(parent), parent_key, number, None)]
    types = {number: _common_type(set(found)) for number, found in kinds.items()}
    rows = []
    for place, frame in frames.items():
        cells = [
            F.struct(F.lit(number).alias("parent"), F.col(key).cast(types[number]).cast("string").alias("key"), F.lit(-1 if i is None else i).alias("used_by"))
            for own, key, number, i in dict.fromkeys(ends)
            if own == place
        ]
        rows.append(frame.select(F.inline(F.array(*cells))).filter(F.col("key").isNotNull()))
    numbers = range(len(constraints))
    uses = [F.count_if(F.col("used_by") == i).alias(f"uses_{i}") for i in numbers]
    groups = union_all(rows).groupBy("parent", "key").agg(F.max(F.col("used_by") < 0).alias("known"), *uses)
    orphans = groups.filter(~F.col("known")).agg(
        *[F.count_if(F.col(f"uses_{i}") > 0).alias(f"keys_{i}") for i in numbers],
        *[F.coalesce(F.sum(f"uses_{i}"), F.lit(0)).alias(f"rows_{i}") for i in numbers],
    )
    found = [F.struct(F.lit(constraints[i][0]).alias("constraint_name"), F.col(f"keys_{i}").alias("orphan_keys"), F.col(f"rows_{i}").alias("orphan_rows")) for i in numbers]
    return orphans.select(F.inline(F.array(*found)))
