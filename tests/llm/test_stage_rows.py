"""Rows that the pipeline's stages must take: ties, null and repeated ids, columns with dots in their names."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from monthmill.llm import exact_dedup, mixing, simhash, toxicity
from monthmill.llm.queries import LLM_ORACLE
from tests.compare import connect, spark_rows, sql_rows
from tests.llm.frames import documents, text_of

DOTTED = ["a.b", "c`d", "e f.g.h"]


def dotted(docs):
    return docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in DOTTED})


STAGES = {
    "toxicity": lambda docs: toxicity.clean_documents(docs, docs.sparkSession.createDataFrame([(i, 1, int(i % 9 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")),
    "exact_dedup": exact_dedup.distinct_documents,
    "near_duplicates": simhash.distinct_documents,
    "mixing": mixing.mix,
}


@pytest.mark.parametrize("stage", list(STAGES))
def test_columns_with_dots(spark, stage):
    rng = random.Random(1)
    docs = dotted(documents(spark, [(i, text_of(rng, 3) + (" vile awful" if i % 9 == 0 else "")) for i in range(60)] + [(90, "same"), (91, "same")]))
    kept = STAGES[stage](docs)
    assert kept.columns == docs.columns and 0 < kept.count()
    assert all(row["a.b"] == f"a.b{row.doc_id}" for row in kept.collect())


@pytest.mark.parametrize("stage", ["exact_dedup", "near_duplicates"])
def test_ties_do_not_depend_on_the_order_of_rows(spark, stage):
    rows = [(4, "One text that all of these rows share.", source) for source in "HGFEDCBA"]
    kept = {tuple(STAGES[stage](documents(spark, some)).first()) for some in (rows, rows[::-1], rows[3:] + rows[:3])}
    assert len(kept) == 1


@pytest.mark.parametrize("own", [lambda i: None, lambda i: 7, lambda i: i % 3])
def test_mix_of_null_and_repeated_ids(spark, own):
    """Within a document of each target, as with ids of their own."""
    rng = random.Random(2)
    rows = [(own(i), text_of(rng, 1), f"src{i % 3}") for i in range(400)]
    sizes = [len(text.split()) for _, text, _ in rows]
    report = mixing.mix_report(documents(spark, rows))
    taken = report.groupBy("source_size", "target").agg(F.sum("taken").alias("taken")).collect()
    assert len(taken) == 3 and all(abs(row.taken - row.target) <= max(sizes) for row in taken)
    assert sorted(map(tuple, report.collect()), key=repr) == sorted(map(tuple, mixing.mix_report(documents(spark, rows[::-1])).collect()), key=repr)
    assert mixing.mix(documents(spark, rows)).count() == report.agg(F.sum("copies")).first()[0]


def test_mix_matches_sql(spark):
    con = connect("/root/testdata/sf0.001")
    df = mixing.mix_report(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    ours, theirs = spark_rows(df), sql_rows(con, LLM_ORACLE["op10_mixing"])
    assert ours == theirs


def test_mix_caps_in_many_rounds(spark):
    """Weights of many sizes: each round caps further documents, and the mix still meets its targets."""
    rng = random.Random(4)
    rows = [(i, text_of(rng, 2), f"src{i % 2}") for i in range(600)]
    docs = documents(spark, rows).withColumn("quality", F.pow(F.lit(1.7), F.col("doc_id") % 30))
    report = mixing.mix_report(docs, weight="quality", weights=(1, 1))
    total = report.groupBy("source_size", "target").agg(F.sum("taken").alias("taken"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert len(total) == 2 and all(abs(row.taken - row.target) <= 60 and row.over <= 0 for row in total)
