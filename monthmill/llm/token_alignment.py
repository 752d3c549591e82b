"""Alignment of two tokenizers' tokens of the same texts by merge-path partitioning.

Both tokenizers cut the bytes of blank+text; a token is known by where it ends. The ends of a block of documents stand one after the other,
so that the two ascending lists are merged at once, however long a document is: binary searches on every WORK-th diagonal
of the merge path divide the merge into independent pieces of equal work. A piece gives its overlaps, the pairs of an A and a B
token that share bytes, and whether both end there. Where a piece ends between the two ends of such a pair, the boundary is
stitched. Tokens between two common ends make a group; the last ones of a group are a link.

A report adds how often each pair of ids is linked over all documents. The pairs are counted in Spark. Those of the highest counts, at most
FREQUENT, are sent to all tasks; links of the others are joined by pair. None of these is hot, as their counts are the low ones.

Texts are cut before single blanks between words, where neither tokenizer joins what stands on both sides (no piece of B has a blank
after something else). New units are joined to longer texts, which are encoded at once and divided where units end; their ids are kept in a
Python worker's table. When it is full, the units that came most often stay.

Defined results: null and empty texts, and those whose tokens' bytes are not those of blank+text, have no tokens. Rows that repeat, also
with equal ids, are documents of their own. Other columns take no part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import ship, written

#: Steps of the merge path in a piece.
WORK = 1 << 15
#: Pairs of ids that are sent to all tasks.
FREQUENT = 1 << 17
#: Characters of text that are aligned at once, and units and tokens in a worker's table.
BLOCK = 1_000_000
TABLE_UNITS, TABLE_TOKENS = 150_000, 2_000_000
#: Units that are encoded at once, and those of them that are joined to one text.
_BATCH, _JOINED = 1 << 13, 1 << 7

_IRREGULAR = re.compile(r" (?:\s|\Z)")
_CUT = re.compile(r"(?<! ) (?=\S)")


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def units(text: str) -> list[str]:
    """Parts of blank+text, each less its first character, a blank."""
    if not text[0].isspace() and not _IRREGULAR.search(text):
        return text.split(" ")
    first, *rest = _CUT.split(" " + text)
    return [first[1:], *rest] if first else rest


def _alone(unit: str) -> bool:
    """Whether a unit can't stand between others: units(" ".join(found)) == found if none of them does."""
    return unit[0].isspace() or unit[-1] == " " or "▁" in unit


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class _Side:
    """One tokenizer's tokens of the units of the table, one after the other."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes = token_bytes
        self.token_length = np.fromiter(map(len, token_bytes), np.int64, len(token_bytes))
        self.clear()

    def clear(self) -> None:
        self.ids, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def add(self, ids: list[list[int]], counts: list[list[int]]) -> None:
        """Ids of units one after the other, and how many each has, in lists that each hold some of the units."""
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.int32, sum(map(len, ids)))])
        n = np.fromiter(chain.from_iterable(counts), np.int64, sum(map(len, counts)))
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(n)])

    def keep(self, at: np.ndarray) -> None:
        self.ids, n = self.gather(at)
        self.start = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])

    def counts(self, ids: list[int], ends: np.ndarray) -> list[int] | None:
        """How many tokens lie before each of these ends, since the one before it; None if there is one where no token ends."""
        token_ends = np.cumsum(self.token_length[ids])
        before = np.searchsorted(token_ends, ends, "right")
        return np.diff(before, prepend=0).tolist() if before[0] and (token_ends[before - 1] == ends).all() else None

    def joined(self, ids) -> bytes:
        return b"".join([self.token_bytes[i] for i in ids])

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the units at these places, and how many each has."""
        n = self.start[at + 1] - self.start[at]
        return self.ids[np.arange(int(n.sum())) + np.repeat(self.start[at] - (np.cumsum(n) - n), n)], n


class _Places(dict):
    """Unit -> its place; a new unit gets the next one."""

    def __missing__(self, unit: str) -> int:
        place = self[unit] = len(self)
        return place


class _Table:
    """Unit -> its place; both tokenizers' tokens of it."""

    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a_model, self.b_model = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a_model.encode_special_tokens = True
        letters, b = _byte_letters(), self.b_model
        tokens = [self.a_model.id_to_token(i) or "" for i in range(self.a_model.get_vocab_size())]
        self.a = _Side([bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode() for t in tokens])
        pieces = [(i, b.id_to_piece(i)) for i in range(b.get_piece_size())]
        self.b = _Side([bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces])
        self.clear()

    def clear(self) -> None:
        self.place = _Places()
        self.true, self.uses = np.zeros(0, bool), np.zeros(0, np.int64)
        self.a.clear()
        self.b.clear()

    def forget(self) -> None:
        """Keeps the units that came most often, at most half a table of those that came again."""
        most = np.argsort(-self.uses, kind="stable")[: TABLE_UNITS // 2]
        tokens = np.cumsum(np.diff(self.a.start)[most] + np.diff(self.b.start)[most])
        kept = np.zeros(len(self.uses), bool)
        kept[most[(self.uses[most] > 1) & (tokens <= TABLE_TOKENS // 2)]] = True
        self.place = _Places(zip(compress(self.place, kept), range(int(kept.sum()))))
        self.true, self.uses = self.true[kept], self.uses[kept] // 2
        self.a.keep(np.flatnonzero(kept))
        self.b.keep(np.flatnonzero(kept))

    def encoded(self, groups: list[list[str]]) -> Iterator[tuple[list[int], list[int], list[int], list[int], list[bool]]]:
        """Some units at a time: ids of A, how many each unit has, the same of B, and whether their bytes are those of blank+unit."""
        texts = [" ".join(group) for group in groups]
        a = [e.ids for e in self.a_model.encode_batch_fast([" " + text for text in texts], add_special_tokens=False)]
        b = self.b_model.encode(texts, num_threads=1)
        for group, text, x, y in zip(groups, texts, a, b):
            true = self.a.joined(x) == self.b.joined(y) == (" " + text).encode()
            if len(group) == 1:
                yield x, [len(x)], y, [len(y)], [true]
                continue
            ends = np.cumsum([len(unit.encode()) + 1 for unit in group])
            n_x, n_y = (self.a.counts(x, ends), self.b.counts(y, ends)) if true else (None, None)
            if n_x and n_y:
                yield x, n_x, y, n_y, [True] * len(group)
            else:
                yield from self.encoded([[unit] for unit in group])

    def add(self, wanted: list[str]) -> None:
        alone = [at for at, unit in enumerate(wanted) if _alone(unit)]
        cuts = sorted({*range(0, len(wanted), _JOINED), *alone, *(at + 1 for at in alone), len(wanted)})
        a, a_n, b, b_n, true = zip(*self.encoded([wanted[low:high] for low, high in pairwise(cuts)]))
        self.true = np.concatenate([self.true, np.fromiter(chain.from_iterable(true), bool, len(wanted))])
        self.a.add(a, a_n)
        self.b.add(b, b_n)

    def places(self, found: list[str]) -> np.ndarray:
        if len(self.place) > TABLE_UNITS or len(self.a.ids) + len(self.b.ids) > TABLE_TOKENS:
            self.forget()
        known = len(self.place)
        places = np.fromiter(map(self.place.__getitem__, found), np.int64, len(found))
        wanted = list(islice(self.place, known, None))
        for at in range(0, len(wanted), _BATCH):
            self.add(wanted[at : at + _BATCH])
        self.uses = np.concatenate([self.uses, np.zeros(len(wanted), np.int64)]) + np.bincount(places, minlength=len(self.place))
        return places


_tables: dict[tuple[str, str], _Table] = {}


def _table(paths: tuple[str, str]) -> _Table:
    if paths not in _tables:
        _tables[paths] = _Table(*paths)
    return _tables[paths]


def path_cuts(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge of two ascending lists is after every `work` steps: how many of a and of b are behind. Of equal ones a's comes first."""
    steps = np.append(np.arange(0, len(a) + len(b), work), len(a) + len(b))
    low, high = np.maximum(0, steps - len(b)), np.minimum(steps, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        behind = np.zeros(len(steps), bool)
        behind[open_] = a[mid[open_]] <= b[(steps - mid - 1)[open_]]
        low, high = np.where(open_ & behind, mid + 1, low), np.where(open_ & ~behind, mid, high)
    return low, steps - low


def piece_overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of a piece in order: how many ends of a and of b lie before it, and whether both tokens end there."""
    ends = np.concatenate([a, b])
    order = np.argsort(ends, kind="stable")
    ends, of_a = ends[order], order < len(a)
    before_a = np.cumsum(of_a) - of_a
    before_b = np.arange(len(ends)) - before_a
    second = np.zeros(len(ends), bool)
    second[1:] = ends[1:] == ends[:-1]
    both = np.append(second[1:], False)
    return before_a[~second], before_b[~second], both[~second]


def overlaps(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlaps of two lists of token ends: numbers of the A and the B token, and whether both end there."""
    at_a, at_b = path_cuts(a, b, work)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a0, a1, b0, b1 in zip(at_a, at_a[1:], at_b, at_b[1:]):
        left, right, both = piece_overlaps(a[a0:a1], b[b0:b1])
        left, right = left + a0, right + b0
        if parts and a0 and b1 > b0 and a[a0 - 1] == b[b0] and parts[-1][0][-1] == a0 - 1:
            # The pair's A end closes the piece before and its B end opens this one: one overlap, not two.
            parts[-1][2][-1] = True
            left, right, both = left[1:], right[1:], both[1:]
        if len(left):
            parts.append((left, right, both))
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    return tuple(np.concatenate(column) for column in zip(*parts))


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal numbers below n as bytes, filled up with zeros, and their lengths."""
    texts = [str(i).encode() for i in range(n)]
    width = len(texts[-1]) + 1
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8).reshape(n, width), np.fromiter(map(len, texts), np.int64, n)


def _grouped_text(a_ids, b_ids, a_last, b_last, a_docs, digits) -> tuple[np.ndarray, np.ndarray]:
    """The groups of documents as text, `a1,a2|b1;a3|b2`, and how long it is for each. a_last, b_last: last tokens of each group;
    a_docs: how many A tokens each document has."""
    table, lengths = digits
    n_a, n_b = len(a_ids), len(b_ids)
    a_sizes, b_sizes = np.diff(a_last, prepend=-1), np.diff(b_last, prepend=-1)
    a_at = np.arange(n_a) + np.repeat(b_last + 1 - b_sizes, a_sizes)
    b_at = np.arange(n_b) + np.repeat(a_last + 1, b_sizes)
    ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
    ids[a_at], ids[b_at] = a_ids, b_ids
    mark[a_at[a_last]], mark[b_at[b_last]] = ord("|"), ord(";")
    size = lengths[ids]
    letters = table[ids]
    letters[np.arange(len(ids)), size] = mark
    # A document ends with the group that its last A token ends; it has no mark there.
    last_group = np.searchsorted(a_last, np.cumsum(a_docs) - 1)
    last = b_at[b_last[last_group]]
    shown = size + 1
    shown[last] -= 1
    held = letters[np.arange(table.shape[1]) < shown[:, None]]
    ends = np.cumsum(shown)[last]
    return held, np.diff(ends, prepend=0)


_COLUMNS = "n_a long, n_b long, n_overlaps long, groups string, links array<long>"


def alignments(docs: DataFrame, paths: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_overlaps, groups (ids as text: `a1,a2|b1;a3|b2`) and links, the pairs of ids that
    end the groups, as a * 2^32 + b. paths: files of A and B that every executor can read."""
    ship(docs.sparkSession)
    paths = paths or default_paths()
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()

    def block(table: _Table, ids: pa.Array, texts: list[str], digits) -> pa.RecordBatch:
        n, found = len(texts), [units(t) if t else [] for t in texts]
        n_units = np.fromiter(map(len, found), np.int64, n)
        places = table.places(list(chain.from_iterable(found)))
        doc = np.repeat(np.arange(n), n_units)
        for i in np.unique(doc[~table.true[places]]):
            # Units whose bytes differ may still add up to the right text.
            a, b = (side.joined(side.gather(places[doc == i])[0]) for side in (table.a, table.b))
            if not a == b == (" " + texts[i]).encode():
                n_units[i] = 0
                places, doc = places[doc != i], doc[doc != i]
        (a_ids, a_n), (b_ids, b_n) = table.a.gather(places), table.b.gather(places)
        a_docs, b_docs = (np.bincount(doc, weights=x, minlength=n).astype(np.int64) for x in (a_n, b_n))
        left, right, both = overlaps(np.cumsum(table.a.token_length[a_ids]), np.cumsum(table.b.token_length[b_ids]))
        a_last, b_last = left[both], right[both]
        ends = np.cumsum(a_docs)
        n_overlaps, n_links = (np.diff(np.searchsorted(x, ends), prepend=0) for x in (left, a_last))
        full = np.flatnonzero(a_docs)
        held, sizes = np.zeros(0, np.uint8), np.zeros(n, np.int64)
        if len(full):
            held, sizes[full] = _grouped_text(a_ids, b_ids, a_last, b_last, a_docs[full], digits)
        groups = pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(np.cumsum(np.r_[0, sizes]).astype(np.int32)), pa.py_buffer(held)])
        links = (a_ids[a_last].astype(np.int64) << 32) | b_ids[b_last]
        links = pa.ListArray.from_arrays(pa.array(np.cumsum(np.r_[0, n_links]).astype(np.int32)), pa.array(links, pa.int64()))
        columns = [ids, pa.array(a_docs), pa.array(b_docs), pa.array(n_overlaps, pa.int64()), groups, links]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_overlaps", "groups", "links"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(paths)
        digits = _digits(max(len(table.a.token_bytes), len(table.b.token_bytes)))
        for batch in batches:
            sizes = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            parts = (np.cumsum(sizes) - sizes) // BLOCK
            cuts = [*np.flatnonzero(np.diff(parts, prepend=-1)).tolist(), len(parts)] if len(parts) else []
            for low, high in zip(cuts, cuts[1:]):
                part = batch.slice(low, high - low)
                yield block(table, part.column(0), [t or "" for t in part.column(1).to_pylist()], digits)

    return narrow.mapInArrow(run, f"doc_id {kind}, {_COLUMNS}")


def _level(n: str):
    """Counts in steps of a quarter of a power of two."""
    return F.floor(F.log2(F.col(n)) * 4).cast("int")


def alignment_report(docs: DataFrame, paths: tuple[str, str] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best: links whose pair is as often linked as the best one of its B id; count_sum: the pairs' counts over the links.
    """
    sha = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    n_links = F.size("links").cast("long")
    found = written(
        alignments(docs, paths, doc_id, text).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "n_a", "n_b", n_links.alias("n_links"), sha.alias("groups_sha256"), "links"
        ),
        "alignments",
    )
    links = found.select("row", F.explode("links").alias("pair"))
    counts = written(links.groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    # One row per id of B, as many as its vocabulary has.
    most = counts.groupBy(F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b")).agg(F.max("n").alias("most"))
    best = counts.join(F.broadcast(most), F.col("pair").bitwiseAND(0xFFFFFFFF) == F.col("b"))
    best = best.select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))
    least, held = math.inf, 0
    for level, n in sorted(((r.level, r.n) for r in counts.groupBy(_level("n").alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True):
        held += n
        if held > FREQUENT:
            break
        least = level
    is_frequent = _level("n") >= F.lit(least)
    frequent, rare = F.broadcast(best.filter(is_frequent)), best.filter(~is_frequent)
    sums = [F.sum("n").alias("n"), F.sum("best").alias("best")]
    known = links.join(frequent, "pair").groupBy("row").agg(*sums)
    others = links.join(frequent.select("pair"), "pair", "left_anti").groupBy("row", "pair").agg(F.count("*").alias("times"))
    others = others.join(rare, "pair").groupBy("row").agg(F.sum(F.col("n") * F.col("times")).alias("n"), F.sum(F.col("best") * F.col("times")).alias("best"))
    total = known.unionByName(others).groupBy("row").agg(*sums)
    none = F.lit(0).cast("long")
    return found.drop("links").join(total, "row", "left").select(
        "doc_id", "n_a", "n_b", F.col("n_links").alias("n_groups"), "n_links",
        F.coalesce("best", none).alias("n_best"), F.coalesce("n", none).alias("count_sum"), "groups_sha256",
    )
