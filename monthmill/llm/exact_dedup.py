"""Exact de-duplication in two passes with a Bloom filter, from DataFrame operations alone.

The first pass sets, per document, a few bits of one 64-bit word of a filter (a blocked Bloom filter) and keeps
the bits that two or more documents set. The second pass looks each document up in that filter: unless all
its bits were kept, its text occurs once and the row passes straight through. Only the rest, the possibly
repeated rows, shuffle by their SHA-256, which decides. The filter has BITS_PER_ROW bits for each row, so that
few rows shuffle without need at any size, and only words with kept bits exist as rows of it: they are
broadcast up to a counted number and joined by a shuffle beyond it.

A group of a third of all rows is a few bits to the filter, one row for each task in the aggregate, and is split by
adaptive execution in the join.

Defined results: a null text counts as empty, and empty texts are equal to each other. A null doc_id ranks after
all others. Rows that repeat doc_id and text are members of their group like others; of them one stays. Other
columns take no part. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import columns_of, free_name, row_hash, sized, text_or_empty, written

BITS_PER_ROW = 16
PROBES = 3
#: Words of the filter that are broadcast at most, each two longs.
FILTER_ROWS = 1 << 20

_SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def digest(text: str = "text") -> Column:
    """SHA-256 of the text without white space."""
    bare = reduce(lambda out, space: F.replace(out, F.lit(space), F.lit("")), _SPACES, text_or_empty(text))
    return F.sha2(bare, 256)


def _hex(sha: str, start: int, digits: int) -> Column:
    return F.conv(F.substring(sha, start, digits), 16, 10).cast("long")


def _word(sha: str, words: int) -> Column:
    return _hex(sha, 1, 12) % words


def _bits(sha: str) -> list[Column]:
    """One-bit masks, PROBES of them, some perhaps equal."""
    places = [_hex(sha, 13 + 2 * i, 2).bitwiseAND(F.lit(63)).cast("int") for i in range(PROBES)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places]


def repeated_filter(digests: DataFrame, sha: str) -> tuple[DataFrame, int]:
    """First pass: (word, bits) of the bits that at least two rows set, and the length of the filter in words."""
    words = max(1, digests.count() * BITS_PER_ROW // 64)
    cells = digests.select(_word(sha, words).alias("word"), F.explode(F.array_distinct(F.array(*_bits(sha)))).alias("bit"))
    twice = cells.groupBy("word", "bit").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    return written(twice.groupBy("word").agg(F.bit_or("bit").alias("bits")), "bloom"), words


def flagged(rows: DataFrame, sha: str, bloom: DataFrame, words: int, flag: str) -> DataFrame:
    """Second pass: the rows with a column `flag`, false only where the filter shows the digest to be unique."""
    word, bits = f"{flag}_word", f"{flag}_bits"
    bloom = sized(bloom.select(F.col("word").alias(word), F.col("bits").alias(bits)), most=FILTER_ROWS)
    mask = reduce(Column.bitwiseOR, _bits(sha))
    hit = F.coalesce(F.col(bits).bitwiseAND(mask) == mask, F.lit(False))
    return rows.join(bloom, _word(sha, words) == F.col(word), "left").withColumn(flag, hit).drop(word, bits)


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            F.length(text_or_empty(text)).cast("long").alias("n_chars"),
            digest(text).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    )
    bloom, words = repeated_filter(rows, "text_sha256")
    looked_up = flagged(rows, "text_sha256", bloom, words, "suspect")
    straight = looked_up.filter("not suspect").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    suspects = looked_up.filter("suspect")
    first = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("no_id"), "doc_id", "row"))
    groups = written(suspects.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("group_size"), first.alias("first")), "groups")
    repeated = suspects.join(groups, "text_sha256").select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"), "text_sha256"
    )
    return straight.unionByName(repeated)


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the longest as written, then the smallest doc_id, then the least hash
    of all columns."""
    sha, suspect, row = (free_name(docs, name) for name in ("text_sha256", "suspect", "row"))
    bloom, words = repeated_filter(written(docs.select(digest(text).alias(sha)), "digests"), sha)
    looked_up = flagged(docs.withColumn(sha, digest(text)), sha, bloom, words, suspect)
    straight = looked_up.filter(~F.col(suspect)).select(*columns_of(docs))
    order = F.struct((-F.length(text_or_empty(text))).alias("n"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), row_hash(docs).alias("rest"))
    one = F.min_by(F.struct(*columns_of(docs)), order).alias(row)
    repeated = looked_up.filter(F.col(suspect)).groupBy(sha).agg(one).select(f"{row}.*")
    return straight.unionByName(repeated)
