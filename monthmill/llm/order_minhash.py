"""Order MinHash fingerprints of documents: likeness under edits, sensitive to order.

A text's k-mers, runs of K words, are numbered by occurrence, so that each is one of a set. For each of ENTRIES hash functions the
LEAST smallest of them are taken, put back into text order and hashed as a tuple. The likeness of two
fingerprints is the share of equal tuples; an edit that moves, repeats or replaces k-mers changes it, one
that keeps their order does not.

A report compares each document with the next one, in descending order of doc_id. That neighbour is found without a
window over the whole table: rows are range-partitioned and sorted, each task reads its rows in order, and the pairs that span two
tasks are made up from one first and one last row of each.

Defined results: a null text counts as empty; a text of fewer than K words is one k-mer, an empty one none, with a fingerprint of its
own. Rows of equal doc_id are in the order of their texts; null ids come last. The only row of a table is its own neighbour. Other
columns take no part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import ship, sized, text_or_empty, written

K = 5
ENTRIES = 32
LEAST = 2
SEED = 7
#: Hexadecimal digits of a tuple.
DIGITS = 8

#: K-mers ranked at once, so that a very long text takes bounded memory.
_PART = 1 << 14

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_RANDOM = np.random.default_rng(SEED)
_FACTORS = _RANDOM.integers(1, 1 << 63, ENTRIES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, ENTRIES, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def numbered_kmers(text: str, k: int = K) -> np.ndarray:
    """A hash for each k-mer and its occurrence number, in text order."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxh64_intdigest, words, repeat(SEED)), np.uint64, len(words))
    n = max(1, len(words) - k + 1)
    kmers = np.zeros(n, np.uint64)
    for i in range(min(k, len(words))):
        kmers = _mixed(kmers + hashes[i : i + n])
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    place = np.arange(n)
    occurrence = np.empty(n, np.uint64)
    occurrence[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    return np.where(occurrence > 0, _mixed(kmers + occurrence * _FACTORS[0]), kmers)


def signature(text: str, k: int = K) -> np.ndarray:
    """ENTRIES numbers of 32 bits, each of the tuple of k-mers that one hash function picks."""
    kmers = numbered_kmers(text, k)
    if not len(kmers):
        return np.zeros(ENTRIES, np.uint32)
    rows, values, places = np.arange(ENTRIES), [], []
    for start in range(0, len(kmers), _PART):
        ranks = (kmers[None, start : start + _PART] ^ _SHIFTS[:, None]) * _FACTORS[:, None]
        for _ in range(min(LEAST, ranks.shape[1])):
            least = ranks.argmin(axis=1)
            values.append(ranks[rows, least])
            places.append(least + start)
            ranks[rows, least] = np.iinfo(np.uint64).max
    least = np.argsort(np.stack(values, axis=1), axis=1, kind="stable")[:, :LEAST]
    picked = np.sort(np.take_along_axis(np.stack(places, axis=1), least, axis=1), axis=1)
    out = np.full(ENTRIES, len(kmers) >= LEAST, np.uint64)
    for column in picked.T:
        out = _mixed(out * _FACTORS[1] + kmers[column])
    return (out >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """A text whose last third is replaced by as much of the beginning of the following one."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_SCHEMA = "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"


def _compared(text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
    changed = edited(text, following)
    of_changed = signature(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "replace")).digest()
    return len(text), sha, own.astype(">u4").tobytes(), of_changed.astype(">u4").tobytes(), likeness(own, of_changed), likeness(own, next_own)


def neighbour_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last third replaced by the beginning of the next document; near_edited and near_next are the
    likeness of the document's fingerprint to those of the edited text and of the next document.
    """
    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    id_type = narrow.limit(0).toArrow().schema.field("doc_id").type
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    in_order = narrow.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finished rows, and the task's first and last row, whose neighbours are in other tasks, with their texts."""
        part, before, rows = TaskContext.get().partitionId(), None, []

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 10
            types = [id_type, *_TYPES, pa.int32(), pa.string(), pa.string()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["doc_id", *_COLUMNS, "part", "edge", "text"])

        none = (None,) * len(_COLUMNS)
        for held in batches:
            for doc, text in zip(held.column(0).to_pylist(), held.column(1).to_pylist()):
                own = signature(text)
                if before is None:
                    rows.append((doc, *none, part, "first", text))
                else:
                    rows.append((before[0], *_compared(before[1], before[2], text, own), part, None, None))
                before = doc, text, own
            yield batch()
        if before is not None:
            rows.append((before[0], *none, part, "last", before[1]))
            yield batch()

    found = written(in_order.mapInArrow(run, f"doc_id {kind}, {_SCHEMA}, part int, edge string, text string"), "neighbours")
    ends = found.filter("edge is not null")
    first, last = ends.filter("edge = 'first'"), ends.filter("edge = 'last'")
    # One number for each task: the next task with rows, after the last one the first.
    by_part = Window.orderBy("part")
    following = first.select("part").withColumn("next_part", F.coalesce(F.lead("part").over(by_part), F.first("part").over(by_part)))
    pairs = last.select("doc_id", "text", "part").join(sized(written(following, "parts")), "part")
    pairs = pairs.join(first.select(F.col("part").alias("next_part"), F.col("text").alias("following")), "next_part").select("doc_id", "text", "following")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in batches:
            texts = zip(held.column(1).to_pylist(), held.column(2).to_pylist())
            columns = list(zip(*(_compared(text, signature(text), other, signature(other)) for text, other in texts))) or [()] * len(_COLUMNS)
            yield pa.RecordBatch.from_arrays([held.column(0), *(pa.array(c, t) for c, t in zip(columns, _TYPES))], ["doc_id", *_COLUMNS])

    finished = pairs.mapInArrow(finish, f"doc_id {kind}, {_SCHEMA}")
    every = found.filter("edge is null").select("doc_id", *_COLUMNS).unionByName(finished)
    as_text = {c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    return every.withColumns(as_text)
