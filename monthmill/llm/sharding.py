"""Shards of bounded size by extendible hashing, from DataFrame operations alone.

A shard is a prefix of hash bits. It starts as the empty prefix, and a shard of more bytes than the limit is split on its next bit, and
only such a shard, until each fits. The directory maps every prefix of the greatest depth to the shard it points to.

Sizes are counted once for STEP more bits at a time: each row counts for its cell of that depth, cells are summed up to all
shorter prefixes, and a cell belongs to the shortest of them that fits. Cells with none, whose shards are still too large, have
their rows counted again with the next STEP bits. A cell is one row for each task before any shuffle.

Hash bits come from doc_id first, then from the text and from the row's place, so that a null or repeated doc_id
does not hold rows together. Defined results: a null or empty text has no bytes; a row larger than the limit is a shard that
exceeds it, marked oversized, as are rows that all 62 bits leave together. Other columns take no part in the report, whatever their
names, and are written with their documents. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import free_name, hash_bits, sized, text_or_empty, written

LIMIT_BYTES = 16 << 20
#: Bits of the hash from the id, the text and the row's place.
ID_BITS, TEXT_BITS, PLACE_BITS = 24, 24, 14
BITS = ID_BITS + TEXT_BITS + PLACE_BITS
STEP = 10


def _hash(doc_id: Column, text: Column, place: Column) -> Column:
    """BITS bits, the id's first."""
    parts = ((F.coalesce(doc_id.cast("string"), F.lit("")), ID_BITS), (text, TEXT_BITS), (place.cast("string"), PLACE_BITS))
    out = F.lit(0).cast("long")
    for value, bits in parts:
        out = F.shiftleft(out, bits).bitwiseOR(F.shiftrightunsigned(hash_bits(value), 48 - bits))
    return out


def _prefix(bits: int) -> Column:
    """The first `bits` bits of a hash."""
    return F.shiftrightunsigned("hash", BITS - bits)


def _step(rows: DataFrame, done: int, limit: int, last: bool) -> DataFrame:
    """(cell, depth, bytes, docs): for each cell of the rows at depth done + STEP the shard it belongs to, with depth null where none fits."""
    deep = min(done + STEP, BITS)
    cells = rows.groupBy(_prefix(deep).alias("cell")).agg(F.sum("n_bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
    cells = written(cells, "cells")
    each = cells.withColumn("depth", F.explode(F.sequence(F.lit(done), F.lit(deep))))
    each = each.withColumn("prefix", F.call_function("shiftrightunsigned", F.col("cell"), (F.lit(deep) - F.col("depth")).cast("int")))
    sums = each.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("docs").alias("docs"))
    if not last:
        # A row that no bit can split ends here as well: its cell is one document.
        fits = (F.col("bytes") <= limit) | (F.col("docs") == 1)
    else:
        fits = (F.col("bytes") <= limit) | (F.col("docs") == 1) | (F.col("depth") == deep)
    fitting = written(sums.filter(fits), "fitting")
    shard = F.min(F.struct("depth", "shard_bytes", "shard_docs"))
    found = each.select("cell", "depth", "prefix").join(
        fitting.select("depth", "prefix", F.col("bytes").alias("shard_bytes"), F.col("docs").alias("shard_docs")), ["depth", "prefix"]
    ).groupBy("cell").agg(shard.alias("shard"))
    return written(cells.select("cell").join(found, "cell", "left").select("cell", "shard.*"), "directory")


def shards(rows: DataFrame, limit: int = LIMIT_BYTES) -> DataFrame:
    """Rows with columns hash and n_bytes, and for each its depth, shard_bytes and shard_docs."""
    out, rest = None, rows
    for done in range(0, BITS, STEP):
        deep = min(done + STEP, BITS)
        directory = _step(rest, done, limit, deep == BITS)
        of_cell = sized(directory.withColumnRenamed("cell", "row_cell"))
        placed = rest.join(of_cell, _prefix(deep) == F.col("row_cell")).drop("row_cell")
        here = placed.filter(F.col("depth").isNotNull())
        out = here if out is None else out.unionByName(here)
        if directory.filter(F.col("depth").isNull()).isEmpty():
            break
        rest = written(placed.filter(F.col("depth").isNull()).select(*rest.columns), "oversized")
    return out


def _name(depth: str = "depth") -> Column:
    """A shard's prefix as text of bits."""
    return F.substring(F.lpad(F.bin("hash"), BITS, "0"), F.lit(1), F.col(depth))


def shard_report(docs: DataFrame, limit: int = LIMIT_BYTES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (its bits), depth, shard_bytes, shard_docs, oversized."""
    rows = written(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            _hash(F.col(doc_id), text_or_empty(text), F.monotonically_increasing_id()).alias("hash"),
            F.octet_length(text_or_empty(text)).cast("long").alias("n_bytes"),
        ),
        "hashed",
    )
    return shards(rows, limit).select(
        "doc_id", "n_bytes", _name().alias("shard"), "depth", "shard_bytes", "shard_docs", (F.col("shard_bytes") > limit).alias("oversized")
    )


def directory(report: DataFrame) -> DataFrame:
    """The directory: one pointer for each prefix of the greatest depth, as (prefix, shard, depth)."""
    each = report.select("shard", "depth").distinct()
    deepest = each.agg(F.max("depth")).first()[0] or 0
    more = (F.lit(deepest) - F.col("depth")).cast("int")
    ends = F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), more) - 1)
    bits = F.when(more > 0, F.lpad(F.bin("end"), more, F.lit("0"))).otherwise(F.lit(""))
    return each.withColumn("end", F.explode(ends)).select(F.concat("shard", bits).alias("prefix"), "shard", "depth")


def directory_ranges(report: DataFrame) -> DataFrame:
    """The directory with its pointers run-length coded: for each shard the first and the last BITS-bit hash that points to it, as (first,
    last, shard, depth). One row per shard, however deep the deepest one is; a hash in no range is of no document."""
    each = report.select("shard", "depth").distinct()
    bits = F.conv(F.rpad("shard", BITS, "0"), 2, 10).cast("long")
    wide = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(BITS) - F.col("depth")).cast("int"))
    return each.select(bits.alias("first"), (bits + wide - 1).alias("last"), "shard", "depth")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes documents as Parquet, one folder shard=<bits> for each shard. The texts shuffle once."""
    inner = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    rows = docs.withColumnsRenamed(inner)
    hashed = rows.withColumn("hash", _hash(F.col(inner[doc_id]), text_or_empty(inner[text]), F.monotonically_increasing_id()))
    narrow = written(hashed.select("hash", F.octet_length(text_or_empty(inner[text])).cast("long").alias("n_bytes")), "hashed")
    table = written(shards(narrow, limit).select(_name().alias("prefix"), "depth").distinct(), "shards")
    # A document's shard is the one of its prefixes, of the depths that occur, that is a shard.
    depths = sorted(row.depth for row in table.select("depth").distinct().collect())
    bits = F.lpad(F.bin("hash"), BITS, "0")
    prefixes = F.explode(F.array(*[F.substring(bits, 1, depth) for depth in depths] or [F.lit("")]))
    found = hashed.withColumn("prefix", prefixes).join(sized(table.select("prefix")), "prefix")
    name = free_name(docs, "shard")
    columns = [F.col(v).alias(k) for k, v in inner.items()]
    found.select(*columns, F.concat(F.lit("b"), "prefix").alias(name)).repartition(name).write.partitionBy(name).parquet(path)
