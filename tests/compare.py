"""Runs registered queries next to their SQL: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(row) for row in df.collect()])


def sql_rows(con, text):
    result = con.execute(text)
    return rows_of([column[0] for column in result.description], result.fetchall())


def kinds(con, text, df):
    """Column types of both sides, by name, in one vocabulary."""
    names = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "date": "DATE",
        "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    ours = {name: names.get(kind, kind) for name, kind in df.dtypes}
    theirs = {row[0]: row[1] for row in con.execute(f"DESCRIBE {text}").fetchall()}
    return ours, theirs


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from monthmill.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    picked = sys.argv[2:]
    spark, con, bad = local_session("compare"), connect(sf_dir), 0
    for name, query in queries().items():
        if picked and name not in picked:
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            got = spark_rows(df)
        except Exception as error:  # report and go on to the next query
            print(f"{name}: FAILED {str(error)[:1500]}")
            bad += 1
            continue
        took = time.time() - start
        text = oracle_sql().get(name)
        if text is None:
            print(f"{name}: {len(got[1])} rows, no SQL, {took:.1f}s")
            continue
        try:
            want = sql_rows(con, text)
            ours, theirs = kinds(con, text, df)
        except Exception as error:
            print(f"{name}: SQL FAILED {str(error)[:1500]}")
            bad += 1
            continue
        same = got == want
        note = "" if ours == theirs else f" types {set(ours.items()) ^ set(theirs.items())}"
        print(f"{name}: {'ok' if same else 'DIFFERS'} {len(got[1])} rows {took:.1f}s{note}", flush=True)
        if not same:
            bad += 1
            print("  ", got[0], want[0], len(got[1]), len(want[1]))
            extra = sorted(set(got[1]) - set(want[1]))[:3], sorted(set(want[1]) - set(got[1]))[:3]
            print("   spark only", extra[0], "\n   sql only  ", extra[1])
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
