"""Packing documents into token windows by order-preserving dynamic programming.

Documents keep their order within a partition of the input and are one stream of tokens there. A window may end after
a document or after a sentence, and inside a sentence only if it is longer than a window; the last two
have a penalty in tokens. The dynamic program finds the ends that minimise padding plus penalties. With
cost(j) + position(j) the padding of the window from j to i is linear in i, so the best start of each window is a
sliding minimum, kept in a monotone queue: each place to cut enters and leaves it once.

A partition is a stream of its own, so nothing shuffles and a lost task is simply run again. A task holds
about STREAM_TOKENS tokens at once, or one document if that is longer; what follows the last settled
cut is carried on. Sequence ids are made of the partition's number and a running number.

Word ids come from a tokenizer file. It cuts words at white space, so a text's ids are its words' ids, and each
distinct word is encoded few times for a Python worker; the table of words is bounded.

Defined results: a null or empty text is its end id alone. Other columns take no part, and rows that repeat are
documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import rows_of, ship

WINDOW = 4096
END_ID = 2
#: Cost of ending a window inside a document after a sentence, and inside a sentence, in tokens of padding.
SENTENCE_PENALTY = 24
WORD_PENALTY = 40
#: A window may end inside a sentence that is longer than a window, after every so many tokens.
INSIDE_STEP = 32
#: Tokens of the stream that a task settles at once.
STREAM_TOKENS = 1 << 20
#: Words in a worker's table that came again, and words that came once so far.
TABLE_WORDS = 250_000
NEW_WORDS = 100_000
#: Partitions of the sequence ids' running numbers.
_PARTITION_BITS = 36

SCHEMA = (
    "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def tokenizer_path() -> str:
    """The default tokenizer file, as its package names it."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Word as UTF-8 -> its ids as little-endian unsigned 32-bit numbers. A word waits among the new ones until it comes again, so
    the many that come once don't fill the table; either is emptied when it is full."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.new: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.merge = self.tokenizer.model.tokenize
        self.as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        # Small letters, then signs: normalising leaves such a word as it is, and the two parts are cut from each other.
        self.simple = re.compile(r"([a-zß-öø-ÿ]+)([!-&(-/:;=-@\[-`{-~]*)").fullmatch

    def part(self, part: str) -> bytes:
        """Ids of letters or of signs, which the tokenizer's model merges as one."""
        return array("I", [token.id for token in self.merge(part if part.isascii() else self.as_bytes(part)[0][0])]).tobytes()

    def __missing__(self, word: bytes) -> bytes:
        ids = self.new.pop(word, None)
        if ids is not None:
            if len(self) >= TABLE_WORDS:
                self.clear()
            self[word] = ids
            return ids
        text = word.decode()
        if parts := self.simple(text):
            letters, signs = parts.groups()
            ids = self[letters.encode()] + self[signs.encode()] if signs else self.part(letters)
        else:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
        if len(self.new) >= NEW_WORDS:
            self.new.clear()
        self.new[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        """A text's ids. Of bytes, lower() changes A-Z only, as the tokenizer does later, unless a special token's name may
        be there; split() cuts at ASCII white space only, which is white space to the tokenizer too."""
        raw = text.encode("utf-8", "replace")
        return b"".join(map(self.__getitem__, (raw if b"<|" in raw else raw.lower()).split()))

    def sentence_ends(self) -> np.ndarray:
        """For each id, whether its token ends a sentence: a word's end after a mark."""
        ends = np.zeros(1 + max(self.tokenizer.get_vocab().values()), bool)
        for token, i in self.tokenizer.get_vocab().items():
            ends[i] = token.endswith((".</w>", "!</w>", "?</w>"))
        return ends


_tables: dict[str, tuple[_Words, np.ndarray]] = {}


def _table(path: str) -> tuple[_Words, np.ndarray]:
    if path not in _tables:
        words = _Words(path)
        _tables[path] = words, words.sentence_ends()
    return _tables[path]


def cut_places(lengths: list[int], inside: list[np.ndarray], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Positions where windows of a stream may end, ascending, and their penalties.

    lengths: tokens of each document; inside: positions in it after which a sentence ends.
    """
    step = min(INSIDE_STEP, max(1, window // 16))
    ends = np.cumsum(lengths)
    starts = ends - lengths
    sentences = np.concatenate([at + start for at, start in zip(inside, starts)]) if len(lengths) else np.zeros(0, np.int64)
    places = np.concatenate([ends, sentences])
    penalties = np.concatenate([np.zeros(len(ends), np.int64), np.full(len(sentences), SENTENCE_PENALTY)])
    order = np.lexsort((penalties, places))
    places, penalties = places[order], penalties[order]
    first = np.r_[True, places[1:] != places[:-1]] & (places > 0)
    places, penalties = places[first], penalties[first]
    before = np.r_[0, places[:-1]]
    wide = np.flatnonzero(places - before > window)
    if len(wide):
        extra = np.concatenate([np.arange(before[i] + step, places[i], step) for i in wide])
        places, penalties = np.r_[places, extra], np.r_[penalties, np.full(len(extra), WORD_PENALTY)]
        order = np.argsort(places, kind="stable")
        places, penalties = places[order], penalties[order]
    return places, penalties


def best_ends(places: np.ndarray, penalties: np.ndarray, final: bool, window: int = WINDOW) -> list[int]:
    """Ends of the windows of a stream that starts at 0, with the least padding plus penalties.

    A window whose length is a power of two needs no padding if it is the last one. Where the stream goes on (`final` is
    false), the last end is the one within a window's length of what is known that cost least for its position.
    """
    at, extra = [0, *places.tolist()], [0, *penalties.tolist()]
    cost, back = [0] * len(at), [0] * len(at)
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + position, index), both ascending
    for i in range(1, len(at)):
        here = at[i]
        while at[queue[0][1]] < here - window:
            queue.popleft()
        best, back[i] = queue[0]
        cost[i] = best + window - here + extra[i]
        value = cost[i] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    i = len(at) - 1
    if final:
        for j in range(i - 1, -1, -1):  # a last window that is a power of two long
            length = at[i] - at[j]
            if length > window:
                break
            if length & (length - 1) == 0 and cost[j] + extra[i] < cost[i]:
                cost[i], back[i] = cost[j] + extra[i], j
    else:
        near = [j for j in range(len(at)) if at[j] >= at[i] - window and j] if len(at) > 1 else []
        i = min(near, key=lambda j: cost[j] + at[j]) if near else 0
    ends = []
    while i:
        ends.append(at[i])
        i = back[i]
    return ends[::-1]


class _Stream:
    """Documents of a partition on their way into windows: [id, ids as bytes, tokens already packed, places of sentence ends]."""

    def __init__(self, partition: int, window: int):
        self.docs: list[list] = []
        self.window, self.sequence = window, partition << _PARTITION_BITS
        self.tokens = 0

    def add(self, doc_id, ids: bytes, ends: np.ndarray) -> None:
        self.docs.append([doc_id, ids, 0, ends])
        self.tokens += len(ids) // 4

    def settle(self, final: bool) -> list[tuple]:
        """Packs what is there, all of it if nothing follows, and returns its pieces."""
        lengths = [len(ids) // 4 - packed for _, ids, packed, _ in self.docs]
        inside = [ends[ends > packed] - packed for _, _, packed, ends in self.docs]
        places, penalties = cut_places(lengths, inside, self.window)
        out, k, position = [], 0, 0
        for end in best_ends(places, penalties, final, self.window):
            offset = 0
            while position < end:
                doc_id, ids, packed, _ = doc = self.docs[k]
                total = len(ids) // 4
                take = min(total - packed, end - position)
                out.append((doc_id, packed, take, zlib.crc32(memoryview(ids)[4 * packed : 4 * (packed + take)]), total, self.sequence, offset))
                doc[2] += take
                offset += take
                position += take
                k += doc[2] == total
            self.sequence += 1
        self.docs = self.docs[k:]
        self.tokens -= position
        return out


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    path: a tokenizer file that every executor can read, of a tokenizer that drops white space.
    """
    path = path or tokenizer_path()
    ship(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    id_type = narrow.limit(0).toArrow().schema.field("doc_id").type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, is_end = _table(path)
        end = np.asarray([end_id], "<u4").tobytes()
        stream = _Stream(TaskContext.get().partitionId(), window)

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(columns[0], id_type), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

        for doc, text in rows_of(batches):
            ids = words.ids(text or "")
            ends = np.flatnonzero(is_end[np.frombuffer(ids, "<u4")]) + 1
            stream.add(doc, ids + end, ends)
            if stream.tokens >= STREAM_TOKENS:
                yield batch(stream.settle(False))
        yield batch(stream.settle(True))

    return narrow.mapInArrow(run, SCHEMA.format(kind=kind))
