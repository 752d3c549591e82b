"""The pipeline's stages on the smallest tables, each against a plain version, and the registered queries against their SQL."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from monthmill.llm import toxicity
from monthmill.llm.common import written
from monthmill.llm.queries import LLM_ORACLE, LLM_QUERIES
from tests.compare import connect, kinds, spark_rows, sql_rows
from tests.llm.frames import documents, empty_documents, odd_rows, text_of, with_clashing
from tests.llm.test_dedup_mix_shard import bare
from tests.llm.test_packing import check
from tests.llm.test_simhash import plain_components, plain_fingerprint

SF_DIR = "/root/testdata/sf0.001"


def test_registered():
    assert set(LLM_QUERIES) | {"pipeline"} <= set(queries())
    assert set(LLM_ORACLE) <= set(oracle_sql()) and "pipeline" not in oracle_sql()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_duplicates", "mixing", "packing"]


@pytest.mark.parametrize("name", list(LLM_ORACLE))
def test_matches_sql(spark, name):
    con = connect(SF_DIR)
    df = LLM_QUERIES[name](spark, SF_DIR)
    assert spark_rows(df) == sql_rows(con, LLM_ORACLE[name])
    ours, theirs = kinds(con, LLM_ORACLE[name], df)
    assert ours == theirs


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, labels, kept = docs.columns, spark.read.parquet(f"{SF_DIR}/labels.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF_DIR), name)
        if name != "packing":
            assert docs.columns == columns
        kept[name] = before, docs

    before, after = (f.collect() for f in kept["toxicity"])
    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity_report(kept["toxicity"][0], labels).collect()}
    assert Counter(after) == Counter(r for r in before if not predicted[r.doc_id])
    toxic = {r.doc_id for r in labels.filter("toxic = 1").collect()}
    clean = {r.doc_id for r in labels.filter("toxic = 0").collect()}
    assert not [r for r in before if predicted[r.doc_id] and r.doc_id in clean]
    assert len([r for r in after if r.doc_id in toxic]) < len([r for r in before if r.doc_id in toxic])

    before, after = (f.collect() for f in kept["exact_dedup"])
    best = {}
    for r in sorted(before, key=lambda r: (-len(r.text), r.doc_id)):
        best.setdefault(bare(r.text), r)
    assert Counter(after) == Counter(best.values())

    before, after = (f.collect() for f in kept["near_duplicates"])
    fps = {r.doc_id: plain_fingerprint(r.text) for r in before}
    root, least = plain_components(set(fps.values())), {}
    for doc_id, fp in sorted(fps.items()):
        least.setdefault(root[fp], doc_id)
    assert sorted(r.doc_id for r in after) == sorted(least.values())

    before, after = (f.collect() for f in kept["mixing"])
    words, taken = defaultdict(int), defaultdict(int)
    for r in before:
        words[r.source] += len(r.text.split())
    for r in after:
        taken[r.source] += len(r.text.split())
    copies = Counter(r.doc_id for r in after)
    assert set(after) <= set(before) and max(copies.values()) <= 3
    assert abs(sum(taken.values()) / sum(words.values()) - 1) < 0.1

    before, after = (f.collect() for f in kept["packing"])
    padding, sequences = check([(r.doc_id, r.text) for r in before], after)
    assert padding < 0.02 * 4096 * sequences + 4 * 4096


def test_run_on_empty_documents(spark, tmp_path):
    empty_documents(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

def test_run_on_odd_and_clashing_rows(spark, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, columns that stages use themselves and one with a dot."""
    rows = odd_rows() + [(100 + i, text_of(random.Random(i), 6), "src0") for i in range(40)]
    docs = with_clashing(documents(spark, rows)).withColumn("a.b", F.lit("own"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(100 + i, 1, int(i % 8 == 0)) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, str(tmp_path))
        assert after.columns == kept.columns and after.filter("`a.b` <> 'own' OR row <> 'own row'").isEmpty()
        kept = written(after, "kept")
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in kept.select("doc_id").collect()} and sum(p.length for p in pieces) > 1000
