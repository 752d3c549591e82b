"""Near-duplicate documents by SimHash, joined on deletion variants.

Fingerprints of 64 bits are linked if at most three bits differ. Cut into two halves, one of them differs in at most one
bit. So each fingerprint is indexed under 64 keys: a half and the place of a wildcard bit, with that bit deleted. Linked
fingerprints share a key, and members of a key are verified on all 64 bits.

Only distinct fingerprints are indexed, so exact copies are one entry. A half that very many fingerprints share would make
large keys; these are refined: the other half is cut in two as well and indexed under its own one-wildcard
variants, which still loses no link, as at most one bit of one quarter differs. A refined key leaves 16 bits and
two wildcards open and so has 2^18 members at most. Within a key, verified links become a star of each
connected part, never all pairs.

Defined results: a null text counts as empty; texts without words have fingerprint zero and are linked like others.
component_id is the smallest doc_id; null ids only count where a component has no other. Rows that repeat are members like others.
Other columns take no part, whatever their names; of rows that tie for the one that stays, the hash of all columns decides. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import columns_of, free_name, row_hash, ship, sized, text_or_empty, values_of, written
from monthmill.llm.components import components

SHINGLE_WORDS = 3
MOST_BITS = 3
SEED = 42
#: A half shared by more distinct fingerprints than this has its keys refined.
HALF_MEMBERS = 4096
#: Shingles hashed at once, so that a very long text takes bounded memory.
_CHUNK = 65_280


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of a text: bit i is 1 if it is set in over half of its shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "replace").lower().split()  # of bytes: A-Z and ASCII white space only
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, _CHUNK):
        part = words[start : start + _CHUNK + shingle - 1]
        k = max(1, len(part) - shingle + 1)
        shingles = map(b" ".join, zip(*(part[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
        hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, k)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(k, 8), axis=1, bitorder="little")
        whole = k // 255 * 255  # sums of 255 bits fit a byte, which is several times as fast
        counts += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        counts += bits[whole:].sum(axis=0, dtype=np.uint8)
    set_bits = np.flatnonzero(2 * counts > n)
    return sum(1 << int(i) for i in set_bits)


def fingerprints(docs: DataFrame, text: str, keep: list[str], shingle: int = SHINGLE_WORDS) -> DataFrame:
    """The columns `keep` and a column fp, the fingerprint as a long."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col(text).cast("string").alias("the_text"), *keep)
    schema = ", ".join(["fp long", *(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[1:])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(x, shingle) for x in values_of(batch.column(0))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(values), *batch.columns[1:]], ["fp", *batch.schema.names[1:]])

    return narrow.mapInArrow(run, schema)


def _half_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp) under a half, a wildcard's place and that half without the bit: 1 + 5 + 32 bits."""
    places = np.arange(32, dtype=np.uint64)
    for batch in batches:
        for start in range(0, batch.num_rows, 8192):
            fp = batch.column(0)[start : start + 8192].to_numpy(zero_copy_only=False).view(np.uint64)
            keys = []
            for half in range(2):
                value = (fp >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
                cleared = value[:, None] & ~(np.uint64(1) << places)[None, :]
                keys.append(cleared | (places << np.uint64(32))[None, :] | np.uint64(half << 37))
            key = np.concatenate(keys, axis=1).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(np.repeat(fp, 64).view(np.int64))], ["key", "fp"])


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp) of large keys, each under a quarter of the other half and a wildcard there as well: 38 + 1 + 4 + 16 bits."""
    places = np.arange(16, dtype=np.uint64)
    for batch in batches:
        for start in range(0, batch.num_rows, 8192):
            key = batch.column(0)[start : start + 8192].to_numpy(zero_copy_only=False).view(np.uint64)
            fp = batch.column(1)[start : start + 8192].to_numpy(zero_copy_only=False).view(np.uint64)
            other = np.where(key >> np.uint64(37) & np.uint64(1), fp, fp >> np.uint64(32)) & np.uint64(0xFFFFFFFF)
            keys = []
            for quarter in range(2):
                value = (other >> np.uint64(16 * quarter)) & np.uint64(0xFFFF)
                cleared = value[:, None] & ~(np.uint64(1) << places)[None, :]
                keys.append(cleared | (places << np.uint64(16))[None, :] | np.uint64(quarter << 20))
            wide = np.concatenate(keys, axis=1) | (key << np.uint64(21))[:, None] | np.uint64(1 << 62)
            yield pa.RecordBatch.from_arrays([pa.array(wide.ravel().view(np.int64)), pa.array(np.repeat(fp, 32).view(np.int64))], ["key", "fp"])


def _stars(members: np.ndarray, most: int) -> np.ndarray:
    """For rows of n fingerprints each, the index of the first member of each one's connected part."""
    rows, n = members.shape
    label = np.broadcast_to(np.arange(n), (rows, n)).copy()
    block = max(1, (1 << 22) // (rows * n))
    while True:
        new = label.copy()
        for i in range(0, n, block):
            near = np.bitwise_count(members[:, i : i + block, None] ^ members[:, None, :]) <= most
            new[:, i : i + block] = np.where(near, label[:, None, :], n).min(axis=2)
        new = np.take_along_axis(new, new, axis=1)
        if (new == label).all():
            return label
        label = new


def _links(most: int):
    """A function from (key, fp) rows, a partition sorted by key, to (a, b): stars of what each key links."""

    def of_runs(key: np.ndarray, fp: np.ndarray) -> np.ndarray:
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        sizes = np.diff(np.r_[starts, len(key)])
        out = []
        for n in np.unique(sizes[sizes > 1]):
            at = starts[sizes == n]
            step = max(1, (1 << 20) // int(n * n))
            for i in range(0, len(at), step):
                members = fp[at[i : i + step, None] + np.arange(n)]
                label = _stars(members, most)
                first = np.take_along_axis(members, label, axis=1)
                moved = label != np.arange(n)
                out.append(np.stack([members[moved], first[moved]], axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps, rows = [], [], 0
        edges = lambda e: pa.RecordBatch.from_arrays([pa.array(e[:, i].view(np.int64)) for i in range(2)], ["a", "b"])
        for batch in batches:
            keys.append(batch.column(0).to_numpy(zero_copy_only=False))
            fps.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            rows += batch.num_rows
            if rows >= 1 << 18:
                key, fp = np.concatenate(keys), np.concatenate(fps)
                end = np.searchsorted(key, key[-1])  # the last key may go on in the next batch
                if end:
                    yield edges(np.ascontiguousarray(of_runs(key[:end], fp[:end]).T).T.copy())
                keys, fps, rows = [key[end:]], [fp[end:]], 0
        if keys:
            yield edges(of_runs(np.concatenate(keys), np.concatenate(fps)).copy())

    return run


def linked(nodes: DataFrame, most: int = MOST_BITS, half_members: int = HALF_MEMBERS) -> DataFrame:
    """(a, b): links of distinct fingerprints, a column fp of longs, that span every connected part at `most` (3 at most) bits."""
    if not 0 <= most <= 3:
        raise ValueError("two halves find links of three bits at most")
    ship(nodes.sparkSession)
    nodes = nodes.select("fp")
    keys = nodes.mapInArrow(_half_keys, "key long, fp long")
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    halves = nodes.select(F.explode(F.array(low, F.shiftrightunsigned("fp", 32).bitwiseOR(F.lit(1 << 37)))).alias("half"))
    crowded = written(halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > half_members).select("half"), "crowded")
    values = crowded.count()
    if values:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place"))
        place = F.call_function("shiftleft", F.col("place").cast("long"), F.lit(32))
        large = crowded.select("half", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("place"))
        large = large.select(F.col("half").bitwiseAND(F.bitwise_not(bit)).bitwiseOR(place).alias("key")).distinct()
        small = sized(written(large, "large_keys"), 32 * values)
        refined = keys.join(small, "key", "left_semi").mapInArrow(_refined, "key long, fp long")
        keys = keys.join(small, "key", "left_anti").unionByName(refined)
    dealt = keys.repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(_links(most), "a long, b long").distinct()


def _classes(rows: DataFrame, most: int, first) -> DataFrame:
    """(fp, root, *first): each distinct fingerprint of rows, the least one that it reaches, and what `first` aggregates over it."""
    nodes = written(rows.groupBy("fp").agg(*first), "nodes")
    found = components(linked(nodes, most)).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    joined = nodes.join(found, "fp", "left")
    return written(joined.withColumn("root", F.coalesce("root", "fp")), "classes")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, most: int = MOST_BITS) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = written(fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", ["doc_id"], shingle), "fps")
    classes = _classes(rows, most, [F.min("doc_id").alias("first_id")])
    ids = written(classes.groupBy("root").agg(F.min("first_id").alias("component_id")), "ids")
    by_fp = written(classes.join(ids, "root").select("fp", "component_id"), "by_fp")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def distinct_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, most: int = MOST_BITS) -> DataFrame:
    """One row of each component, with all its columns: the one with the smallest doc_id, null last, then the least hash of the text,
    then that of all columns.

    Rows that are alone pass straight through; only members of components of several rows shuffle with their texts.
    """
    narrow = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text_or_empty(text)).alias("tag"), F.col(text).alias("text"))
    rows = written(fingerprints(narrow, "text", ["id", "tag"], shingle), "fps")
    classes = _classes(rows, most, [F.count(F.lit(1)).alias("n")])
    several = classes.groupBy("root").agg(F.sum("n").alias("n")).filter("n > 1").select("root")
    by_fp = written(classes.join(written(several, "several"), "root").select("fp", "root"), "by_fp")
    tag, root = free_name(docs, "simhash_tag"), free_name(docs, "simhash_root")
    members = written(rows.join(by_fp, "fp").groupBy("id", "tag").agg(F.min("root").alias(root)), "members")
    members = members.select(F.col("id").alias(f"{root}_id"), F.col("tag").alias(f"{root}_tag"), root)
    tagged = docs.withColumn(tag, F.xxhash64(text_or_empty(text)))
    same = F.col(doc_id).eqNullSafe(F.col(f"{root}_id")) & (F.col(tag) == F.col(f"{root}_tag"))
    joined = tagged.join(sized(members), same, "left")
    alone = joined.filter(F.col(root).isNull()).select(*columns_of(docs))
    order = F.struct(F.col(doc_id).isNull().alias("none"), F.col(doc_id).alias("id"), F.col(tag).alias("tag"), row_hash(docs).alias("rest"))
    one = F.min_by(F.struct(*columns_of(docs)), order).alias(tag)
    return alone.unionByName(joined.filter(F.col(root).isNotNull()).groupBy(root).agg(one).select(f"{tag}.*"))
