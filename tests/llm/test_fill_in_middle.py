from __future__ import annotations

import hashlib
import random
import re

import pytest

from monthmill.llm import fill_in_middle
from monthmill.llm.fill_in_middle import Cuts
from monthmill.llm.queries import LLM_ORACLE
from tests.compare import connect, kinds, spark_rows, sql_rows
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
MARKED = ["a <P> b", "<S>", "x<M>y", "ends in <", "<P <S M>", "<<>>", "P>S>M>"]


def plain(own, text):
    """A document's row by lists of units."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if own is None else own}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return own, n, "plain", None, None, text
    if h4 % 100 < 80:
        return own, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return own, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts(seed: int, n: int):
    rng = random.Random(seed)
    signs = "ab é漢🙂 \n\t\x0b<PSM>  "
    return [(i, "".join(rng.choice(signs) for _ in range(rng.randint(0, 40)))) for i in range(n)]


@pytest.mark.parametrize("block", [1, 2, 5, 256])
def test_every_cut(block):
    rng = random.Random(block)
    for _, text in [*texts(block, 60), (0, text_of(rng, 20)), (0, " \n "), (0, ""), (0, "\t x"), (0, "x \t")]:
        cuts, units = Cuts(text.encode(), block), UNIT.findall(text)
        assert cuts.n_units == len(units) and cuts.n_points == len(text)
        for k in range(len(units) + 1):
            held = "".join(units[:k])
            assert cuts.after(k) == (len(held.encode()), len(held))


def same(df, rows):
    got = [tuple(row) for row in df.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output").collect()]
    assert sorted(got, key=repr) == sorted((plain(row[0], row[1]) for row in rows), key=repr)


def test_forms(spark):
    rows = texts(1, 500) + [(1000 + i, text) for i, text in enumerate(MARKED * 9)]
    df = fill_in_middle.fill_in_middle(documents(spark, rows))
    same(df, rows)
    assert {row.form for row in df.select("form").distinct().collect()} == {"plain", "psm", "spm"}


def test_restored(spark):
    rows = texts(2, 500) + [(1000 + i, text) for i, text in enumerate(MARKED * 9)]
    df = fill_in_middle.fill_in_middle(documents(spark, rows)).select("doc_id", fill_in_middle.restored().alias("text"))
    assert dict(map(tuple, df.collect())) == dict(rows)


def test_rates(spark):
    rows = [(i, text_of(random.Random(i), 3)) for i in range(400)]
    forms = [row.form for row in fill_in_middle.fill_in_middle(documents(spark, rows), rate=100, suffix_first=0).collect()]
    assert set(forms) == {"psm"}
    assert {row.form for row in fill_in_middle.fill_in_middle(documents(spark, rows), rate=0).collect()} == {"plain"}


def test_odd_rows_and_empty(spark):
    df = with_clashing(odd_documents(spark))
    same(fill_in_middle.fill_in_middle(df), odd_rows())
    report = fill_in_middle.fill_in_middle_report(df)
    want = sorted((hashlib.sha256((row[1] or "").encode()).hexdigest() for row in odd_rows()))
    assert sorted(row.restored_sha256 for row in report.collect()) == want
    assert fill_in_middle.fill_in_middle_report(empty_documents(spark)).count() == 0


def test_matches_sql(spark):
    con, text = connect("/root/testdata/sf0.001"), LLM_ORACLE["op13_fill_in_middle"]
    df = fill_in_middle.fill_in_middle_report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    assert spark_rows(df) == sql_rows(con, text)
    ours, theirs = kinds(con, text, df)
    assert ours == theirs
