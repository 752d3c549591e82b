"""Fill-in-the-middle transformation of documents, cut at units by a Fenwick tree over blocks of the text.

A unit is white space with the word after it, or the white space that is left at the end. A text is divided into blocks of BLOCK bytes; a
Fenwick tree holds how many units end in them and how many code points begin in them. A cut after k units is found by descending the tree
from its greatest power of two on, which gives the block, the units and the code points before it, and then within the block.

Two cuts, drawn from the hash of the id, make prefix, middle and suffix, which are put into one of three forms: plain (the text as it
is), psm (prefix, suffix, middle) or spm (suffix, prefix, middle), each part behind its mark.

Defined results: a null text counts as empty and is plain, as is a text that holds a mark; a null id is hashed as the empty text. Rows
of equal id have the same draws. Columns of other names take no part. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import ship, text_or_empty

BLOCK = 256
SEED = 42
#: Percentages of documents that are transformed, and of these that have the suffix first.
RATE, SUFFIX_FIRST = 50, 80
PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK = "<P>", "<S>", "<M>"

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Cuts:
    """A text in UTF-8 whose units can be counted off."""

    def __init__(self, text: bytes, block: int = BLOCK):
        raw = np.frombuffer(text, np.uint8)
        space = _SPACE[raw]
        self.ends = np.append(space[1:], True) & ~space if len(raw) else space
        self.ends[-1:] = True  # what is left at the end is a unit, too
        self.begins, self.block = (raw & 0xC0) != 0x80, block
        starts = np.arange(0, len(raw), block)
        self.n_blocks = len(starts)
        self.units, self.n_units = self._tree(self.ends, starts)
        self.points, self.n_points = self._tree(self.begins, starts)

    @staticmethod
    def _tree(marks: np.ndarray, starts: np.ndarray) -> tuple[list[int], int]:
        """Entry i holds the marks of as many blocks up to the i-th as i's lowest bit says."""
        counts = np.add.reduceat(marks, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
        before = np.cumsum(np.r_[0, counts])
        i = np.arange(len(before))
        return (before - before[i - (i & -i)]).tolist(), int(before[-1])

    def after(self, k: int) -> tuple[int, int]:
        """Bytes and code points of the first k units."""
        if k == 0:
            return 0, 0
        at = units = points = 0
        step = 1 << self.n_blocks.bit_length() - 1
        while step:
            further = at + step
            if further <= self.n_blocks and units + self.units[further] < k:
                at, units, points = further, units + self.units[further], points + self.points[further]
            step >>= 1
        low = at * self.block
        end = low + int(np.flatnonzero(self.ends[low : low + self.block])[k - units - 1]) + 1
        return end, points + int(np.count_nonzero(self.begins[low:end]))


_SCHEMA = "doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output binary"


def transformed(text: bytes, draws: list[int], rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> tuple:
    """Units, form, code points of prefix and middle (None if plain) and output of a text, by four random numbers."""
    cuts = Cuts(text)
    n = cuts.n_units
    p, s, m = PREFIX_MARK.encode(), SUFFIX_MARK.encode(), MIDDLE_MARK.encode()
    if draws[2] % 100 >= rate or not text or p in text or s in text or m in text:
        return n, "plain", None, None, text
    first, second = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    (a, a_points), (b, b_points) = cuts.after(first), cuts.after(second)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draws[3] % 100 < suffix_first:
        return n, "spm", a_points, b_points - a_points, s + suffix + p + prefix + m + middle
    return n, "psm", a_points, b_points - a_points, p + prefix + s + suffix + m + middle


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n (units), form, prefix_chars, middle_chars, output."""
    ship(docs.sparkSession)
    own = F.col(doc_id)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(own.cast("string"), F.lit(""))).cast("binary"), 256)
    narrow = docs.select(own.alias("doc_id"), digest.alias("digest"), text_or_empty(text).cast("binary").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    types = [narrow.limit(0).toArrow().schema.field("doc_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for hexadecimal, held in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                draws = [int(hexadecimal[i : i + 8], 16) for i in range(0, 32, 8)]
                rows.append(transformed(held, draws, rate, suffix_first))
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types[1:]))], names)

    return narrow.mapInArrow(run, _SCHEMA.format(kind=kind)).withColumn("output", F.col("output").cast("string"))


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output was made of. Each mark is there once, unless the form is plain."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    width = F.lit(len(PREFIX_MARK))
    p, s, m = (F.instr(output, F.lit(mark)) for mark in (PREFIX_MARK, SUFFIX_MARK, MIDDLE_MARK))

    def between(mark: Column, end: Column) -> Column:
        return F.substring(output, mark + width, end - mark - width)

    middle = F.substring(output, m + width, F.length(output))
    return (
        F.when(form == "psm", F.concat(between(p, s), middle, between(s, m)))
        .when(form == "spm", F.concat(between(p, m), middle, between(s, p)))
        .otherwise(output)
    )


def fill_in_middle_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    found = fill_in_middle(docs, doc_id=doc_id, text=text)
    sha = F.sha2(F.col("output").cast("binary"), 256), F.sha2(restored().cast("binary"), 256)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha[0].alias("output_sha256"), sha[1].alias("restored_sha256"))
