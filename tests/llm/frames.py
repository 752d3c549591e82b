"""Small invented tables for the document operators, and the odd rows that all of them must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "amber basin cedar delta ember fjord grove harbor inlet jetty knoll lagoon meadow north orchard prairie quarry river summit tundra".split()


def sentence(rng: random.Random, n: int = 8) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def text_of(rng: random.Random, sentences: int) -> str:
    return " ".join(sentence(rng, rng.randint(4, 12)) for _ in range(sentences))


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def odd_rows():
    """Nulls, empty and blank texts, a very long text and a very long word, equal rows, equal ids, signs of many kinds."""
    rng = random.Random(5)
    long_text = text_of(rng, 9000)
    return [
        (1, None, "src1"), (2, "", "src1"), (3, " \t\n\x0b\x0c\r ", None), (None, "Amber basin. Cedar delta.", "src2"), (None, None, None),
        (4, long_text, "src1"), (5, "x" * 60_000, "src2"), (6, "Same row here.", "src2"), (6, "Same row here.", "src2"),
        (7, "Same  row\nhere.", None), (8, "İstanbul ß ﬁne — ünïcode blank 漢字 🙂 it's 3rd.", "src0"), (8, "Another text of the same id.", "src0"),
        (9, "<|endoftext|> <|STARTOFTEXT|> stop", "src0"), (10, "a", "src0"),
    ]


def odd_documents(spark):
    return documents(spark, odd_rows())


def empty_documents(spark):
    return spark.createDataFrame([], DOCS)


#: Columns that an operator might use itself.
CLASHING = [
    "row", "suspect", "text_sha256", "key", "size", "rate", "cut", "copies", "fp", "root", "tag", "hash", "shard", "depth", "found", "toxicity", "toxic",
    "word", "bits", "mix_key", "mix_copy", "simhash_tag", "simhash_root", "host", "paths", "part", "edge", "train", "n", "bucket", "component_id",
]


def with_clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({name: F.lit(f"own {name}") for name in CLASHING if name not in df.columns})
