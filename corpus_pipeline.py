"""From raw documents to packed training windows, in five stages that each call one operator.

Each stage takes (spark, docs, sf_dir) and works on all rows the one before has kept; its result is written as Parquet and read
again as the next one's documents. All but the last return the columns of documents, the last the pieces of the windows:
doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. A document that the mix repeats is packed as often.

Defined results: a null or empty text is not toxic; it is an exact copy of other empty ones, of which the one of the smallest id stays, and
is never taken into the mix. Null ids rank last, and rows that tie go by the hash of all columns. Further columns pass all stages but
the last, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from monthmill.llm import exact_dedup, mixing, packing, simhash, toxicity
from monthmill.llm.common import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; the classifier learns from `labels`."""
    return toxicity.clean_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space, the longest stays."""
    return exact_dedup.distinct_documents(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled or repeated until each source has its share of the words."""
    return mixing.mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents become pieces of token windows."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_duplicates", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_windows),
]

#: SQL has no tokenizer, no noisy-or training and no XXH64; tests/llm compares the stages with plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = written(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
