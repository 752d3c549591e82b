"""A star that is reloaded as a whole: a new version beside the old one, checked, then put in its place.

All of a version's tables are loaded under names of their own in the star's namespace. Keys are checked there: every dimension's primary
key, every foreign key of the fact. Only then do the tables take the names that queries use, fact first, and only then is
the old version dropped. A load or a check that fails leaves the old star as it was; so does a switch that fails halfway, which is
taken back. Nothing outside the namespace is touched.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from monthmill.operators.keys import foreign_keys_at_once, primary_key_violations
from monthmill.operators.sets import union_all
from monthmill.plans.warehouse import FACT, create_namespace


@dataclass(frozen=True)
class Link:
    """A foreign key of the fact: its column, the dimension and the dimension's key."""

    column: str
    dimension: str
    key: str


class StarError(ValueError):
    """A new version whose keys are violated; ``violations`` has the rows of the check."""

    def __init__(self, violations: list):
        super().__init__("; ".join(f"{row.kind} {row.name}: {row.key_values} keys, {row.rows} rows" for row in violations))
        self.violations = violations


def key_violations(fact: DataFrame, dimensions: dict[str, DataFrame], keys: dict[str, str], links: list[Link]) -> DataFrame:
    """kind, name, key_values, rows: a row for each primary key (null and repeated keys, rows beyond the first of each) and for each
    foreign key (values without a dimension row, fact rows that have them), violated or not. A null foreign key passes."""
    primary = primary_key_violations([(name, dimensions[name], [key]) for name, key in keys.items()]).selectExpr(
        "'primary' AS kind", "table_name AS name", "repeated_keys + CAST(null_keys > 0 AS INT) AS key_values", "null_keys + extra_rows AS rows"
    )
    if not links:
        return primary
    foreign = foreign_keys_at_once([(f"{link.column} -> {link.dimension}", fact, link.column, dimensions[link.dimension], link.key) for link in links])
    return union_all([primary, foreign.selectExpr("'foreign' AS kind", "constraint_name AS name", "orphan_keys AS key_values", "orphan_rows AS rows")])


def reload_star(
    spark: SparkSession,
    namespace: str,
    fact: DataFrame,
    dimensions: dict[str, DataFrame],
    keys: dict[str, str],
    links: list[Link],
    strict: bool = True,
    fact_name: str = FACT,
) -> DataFrame:
    """Replaces the star of a namespace, which is made if it is not there; returns `key_violations` of the new version.

    keys: each dimension's key. strict: a violated key raises `StarError` and leaves the old version; else violations are only
    returned. Columns keep their types: times of day are whole seconds since midnight.
    """
    create_namespace(spark, namespace)
    version = uuid.uuid4().hex[:12]
    loaded = {name: f"{namespace}.{name}__new_{version}" for name in [*dimensions, fact_name]}
    try:
        for name, frame in [*dimensions.items(), (fact_name, fact)]:
            frame.write.mode("errorifexists").saveAsTable(loaded[name])
        tables = {name: spark.table(place) for name, place in loaded.items()}
        found = key_violations(tables[fact_name], {name: tables[name] for name in dimensions}, keys, links)
        # One row per key of the star; fixed here, as the tables get other names.
        rows = found.collect()
        if strict and (violated := [row for row in rows if row.rows]):
            raise StarError(violated)
        _switch(spark, namespace, loaded, version, [fact_name, *dimensions])
    except BaseException:
        drop_tables(spark, namespace, [place.split(".")[-1] for place in loaded.values()])
        raise
    return spark.createDataFrame([tuple(row) for row in rows], found.schema)


def _switch(spark: SparkSession, namespace: str, loaded: dict[str, str], version: str, names: list[str]) -> None:
    """Gives the new tables their names, and the old ones others, which are dropped last. What was done is undone if a step fails."""
    done: list[tuple[str, str]] = []

    def rename(old: str, new: str) -> None:
        spark.sql(f"ALTER TABLE {old} RENAME TO {new}")
        done.append((old, new))

    aside = {}
    try:
        for name in names:
            if spark.catalog.tableExists(f"{namespace}.{name}"):
                aside[name] = f"{name}__old_{version}"
                rename(f"{namespace}.{name}", f"{namespace}.{aside[name]}")
            rename(loaded[name], f"{namespace}.{name}")
    except BaseException:
        for old, new in reversed(done):
            spark.sql(f"ALTER TABLE {new} RENAME TO {old}")
        raise
    drop_tables(spark, namespace, [aside[name] for name in names if name in aside])


def drop_tables(spark: SparkSession, namespace: str, names: list[str]) -> None:
    """Drops tables of one namespace, in the order given; names that are not there are passed over."""
    for name in names:
        if "." in name:
            raise ValueError(f"{name} names a namespace of its own")
        spark.sql(f"DROP TABLE IF EXISTS {namespace}.{name}")


def drop_star(spark: SparkSession, namespace: str, dimensions: list[str], fact_name: str = FACT) -> None:
    """Drops the fact, then the dimensions, of one namespace."""
    drop_tables(spark, namespace, [fact_name, *dimensions])
