"""Language-model scores from a subword lattice, next to a word-count baseline.

The model is a unigram distribution over an existing vocabulary of word pieces. A word's probability is the sum over all
its segmentations into pieces, from the forward recursion in log space; a text's is the product over its words and an
end. Piece probabilities start from the vocabulary's scores (merge ranks, taken as Zipf weights) and are fitted to
the training words by expectation maximisation, with the start as prior.

A piece never crosses white space, so a word's marginal is needed once for all its occurrences. Spark counts the
training words; lattices are walked for distinct words only, in numpy batches. Documents are joined with the words' values
in two parts: words of a bounded number of highest counts are sent to all tasks, and
the rest, none of which is frequent, are joined by hash. What the driver gets is bounded: sums, counts of pieces, frequent words.

Defined results: a null or empty text has one token, the end. Characters outside the vocabulary are spelled in bytes. Without training
texts the base score is 0 for every text (N = V = 0), and the model is the vocabulary's own. Rows that repeat are scored alike. Other
columns take no part, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import id_remainder, ship, written

FOLDS, HELD_OUT = 7, 2
#: Words sent to all tasks at most.
FREQUENT_WORDS = 200_000
ROUNDS = 3
#: Weight of the vocabulary's own scores, in pieces.
PRIOR = 10_000.0
SEED = 42
#: Distinct words that a task counts before it passes them on.
_TABLE = 300_000
#: Words, and word characters, that are walked together.
_WORDS, _CELLS = 4096, 1 << 17
#: Bins of counts for each doubling.
_BINS = 8

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    """The default vocabulary file, as its package names it."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def vocabulary(path: str) -> tuple[list[str], np.ndarray]:
    """The pieces of a sentencepiece file and their log probabilities by its scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    some = [i for i in range(model.vocab_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    pieces = [model.id_to_piece(i) for i in some]
    scores = np.array([-len(some) if model.is_byte(i) else model.get_score(i) for i in some])
    if scores.min() < -50:  # merge ranks: 0, -1, -2, ...
        scores = -np.log(2.0 - scores)
    return pieces, scores - np.logaddexp.reduce(scores)


def byte_piece(byte: int) -> str:
    return f"<0x{byte:02X}>"


class Lattice:
    """All segmentations of words into pieces with given log probabilities."""

    def __init__(self, pieces: list[str], log_p: np.ndarray):
        self.pieces, self.log_p = pieces, log_p
        self.number = {piece: i for i, piece in enumerate(pieces)}
        by_length: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            if not (len(piece) == 6 and piece.startswith("<0x")):
                by_length.setdefault(len(piece), []).append(i)
        self.longest = max(by_length)
        self.tables = {}
        for length, ids in by_length.items():
            codes = np.frombuffer("".join(pieces[i] for i in ids).encode("utf-32-le"), "<u4").reshape(len(ids), length)
            hashes = np.zeros(len(ids), np.uint64)
            for j in range(length):
                hashes = hashes * _FACTOR + codes[:, j] + np.uint64(1)
            order = np.argsort(hashes)
            self.tables[length] = hashes[order], np.array(ids)[order]
        self.spelled: dict[int, tuple[float, list[int]]] = {}

    def spelling(self, code: int) -> tuple[float, list[int]]:
        """Log probability and byte pieces of a character outside the vocabulary."""
        if code not in self.spelled:
            ids = [self.number[byte_piece(b)] for b in chr(code).encode("utf-8", "replace") if byte_piece(b) in self.number]
            self.spelled[code] = float(sum(self.log_p[i] for i in ids)) if ids else -50.0, ids
        return self.spelled[code]

    def _edges(self, codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, piece or -1 at each start, its log probability) for the pieces of each length, shortest first."""
        n, width = codes.shape
        hashes = np.zeros((n, width), np.uint64)
        for length in range(1, min(self.longest, width) + 1):
            starts = width - length + 1
            hashes = hashes[:, :starts] * _FACTOR + codes[:, length - 1 :] + np.uint64(1)
            if length not in self.tables:
                continue
            known, ids = self.tables[length]
            at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = known[at] == hashes
            piece = np.where(hit, ids[at], -1)
            log_p = np.where(hit, self.log_p[ids[at]], -np.inf)
            if length == 1:
                for code in np.unique(codes[~hit & (codes > 0)]):
                    log_p[codes == code] = self.spelling(int(code))[0]
            yield length, piece, log_p

    def walk(self, codes: np.ndarray, lengths: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Log marginals of words, rows of codes padded with 0; with the words' counts, also the expected number of each piece."""
        n, width = codes.shape
        edges = list(self._edges(codes))
        forward = np.full((n, width + 1), -np.inf)
        forward[:, 0] = 0.0
        for end in range(1, width + 1):
            total = forward[:, end]
            for length, _, log_p in edges:
                if length <= end:
                    total = np.logaddexp(total, forward[:, end - length] + log_p[:, end - length])
            forward[:, end] = total
        rows = np.arange(n)
        marginal = forward[rows, lengths]
        if counts is None:
            return marginal, None
        backward = np.full((n, width + 1), -np.inf)
        backward[rows, lengths] = 0.0
        for start in range(width - 1, -1, -1):
            total = backward[:, start]
            for length, _, log_p in edges:
                if start + length <= width:
                    total = np.logaddexp(total, backward[:, start + length] + log_p[:, start])
            backward[:, start] = total
        expected = np.zeros(len(self.pieces))
        for length, piece, log_p in edges:
            starts = width - length + 1
            weight = np.exp(forward[:, :starts] + log_p + backward[:, length:] - marginal[:, None]) * counts[:, None]
            weight[~np.isfinite(weight)] = 0.0
            expected += np.bincount(np.maximum(piece, 0).ravel(), np.where(piece >= 0, weight, 0.0).ravel(), len(self.pieces))
            if length == 1:
                spelled = (piece < 0) & (codes > 0)
                for code in np.unique(codes[spelled]):
                    times = weight[spelled & (codes == code)].sum()
                    for i in self.spelling(int(code))[1]:
                        expected[i] += times
        return marginal, expected

    def batches(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(places in the list, codes, lengths) of words of like length, with the mark of a word's start."""
        sizes = np.array([len(word) for word in words]) + 1
        order = np.argsort(sizes, kind="stable")
        start = 0
        while start < len(order):
            end = start + _WORDS
            while end - start > 1 and sizes[order[min(end, len(order)) - 1]] * (end - start) > _CELLS:
                end = start + (end - start) // 2
            places = order[start:end]
            width = int(sizes[places].max())
            text = "".join(("▁" + words[i]).ljust(width, "\0") for i in places)
            yield places, np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(places), width).astype(np.uint64), sizes[places]
            start = end

    def log10_marginals(self, words: list[str]) -> np.ndarray:
        out = np.empty(len(words))
        for places, codes, lengths in self.batches(words):
            out[places] = self.walk(codes, lengths)[0]
        return out / np.log(10)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 17) -> Iterator[pa.Table]:
    """Record batches joined to tables of about so many rows."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _split(text: str | None) -> list[bytes]:
    """Words of a text in UTF-8, A-Z in lower case: bytes know no other letters and no other white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n): every word of the texts and how often training texts, those with a true `train`, have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = [w.decode("utf-8", "replace") for w in counts]
            batch = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text, train in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = _split(text)
                counts.update(words if train else dict.fromkeys(words, 0))
                if len(counts) >= _TABLE:
                    yield out()
        yield out()

    return docs.select("text", "train").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit_pieces(words: DataFrame, pieces: list[str], prior: np.ndarray, ends: int, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and of the end, fitted to training words (word, n) and the number of their texts."""
    log_p = prior
    total = PRIOR
    for _ in range(rounds):
        lattice = Lattice(pieces, log_p)

        def run(batches: Iterator[pa.RecordBatch], lattice=lattice) -> Iterator[pa.RecordBatch]:
            expected = np.zeros(len(lattice.pieces))
            for table in _gathered(batches):
                words, counts = table.column(0).to_pylist(), table.column(1).to_numpy().astype(float)
                for places, codes, lengths in lattice.batches(words):
                    expected += lattice.walk(codes, lengths, counts[places])[1]
            some = np.flatnonzero(expected)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(expected[some])], ["piece", "expected"])

        found = words.filter("n > 0").select("word", "n").mapInArrow(run, "piece long, expected double")
        sums = found.groupBy("piece").agg(F.sum("expected").alias("expected")).collect()  # one row for each piece at most
        counts = np.exp(prior) * PRIOR
        for piece, expected in sums:
            counts[piece] += expected
        total = counts.sum()
        log_p = np.log(counts / total)
    end = (ends + 1.0) / (ends + total + 2.0)
    return log_p + np.log1p(-end), float(np.log10(end))


def _frequent(values: DataFrame, most: int) -> DataFrame:
    """The words of highest counts, at most so many: all above a bound found from counts of counts."""
    bin_of = F.floor(F.log2(F.col("n").cast("double")) * _BINS).cast("int")
    bins = values.filter("n > 0").groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("words")).collect()
    lowest, taken = None, 0
    for bin_, words in sorted(bins, reverse=True):
        if taken + words > most:
            break
        lowest, taken = bin_, taken + words
    return values.filter((F.col("n") > 0) & (bin_of >= lowest)) if lowest is not None else values.limit(0)


def lm_scores(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    ship(docs.sparkSession)
    pieces, prior = vocabulary(path or vocabulary_path())
    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"), (id_remainder(FOLDS, doc_id) != HELD_OUT).alias("train")
    )
    words = written(count_words(narrow), "words")
    n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    ends = narrow.filter("train").count()
    train_tokens, kinds = n_words + ends, distinct + (ends > 0)
    log_p, end_score = fit_pieces(words, pieces, prior, ends)
    lattice = Lattice(pieces, log_p)

    def marginals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches):
            values = lattice.log10_marginals(table.column(0).to_pylist())
            yield from pa.table({"word": table.column(0), "n": table.column(1), "marginal": pa.array(values)}).to_batches()

    values = written(words.mapInArrow(marginals, "word string, n long, marginal double"), "values")
    frequent = _frequent(values, FREQUENT_WORDS).toArrow()
    base = np.log10((frequent.column("n").to_numpy() + 1) / (train_tokens + kinds + 1))
    known = docs.sparkSession.sparkContext.broadcast(
        {word.encode(): (b, m) for word, b, m in zip(frequent.column("word").to_pylist(), base.tolist(), frequent.column("marginal").to_pylist())}
    )
    end_base = float(np.log10((ends + 1) / (train_tokens + kinds + 1)))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    id_type = narrow.limit(0).toArrow().schema.field("doc_id").type

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each text a row with its own part of the sums, and a row (row, key, times) for each other word."""
        from xxhash import xxh64_intdigest

        row = TaskContext.get().partitionId() << 33
        frequent = known.value
        for batch in batches:
            texts: list[tuple] = []
            rows, keys, times = [], [], []
            for doc, text, train in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = Counter(_split(text))
                base, score, n_known, rare = end_base, end_score, int(ends > 0), []
                for word, n in words.items():
                    if found := frequent.get(word):
                        base += n * found[0]
                        score += n * found[1]
                        n_known += n
                    else:
                        rare.append(word)
                texts.append((row, doc, not train, 1 + words.total(), n_known, base, score))
                rows.extend(repeat(row, len(rare)))
                keys.extend(map(xxh64_intdigest, rare, repeat(SEED)))
                times.extend(map(words.__getitem__, rare))
                row += 1
            n, m = len(texts), len(rows)
            columns = list(zip(*texts)) or [()] * 7
            none = lambda size, type_: pa.nulls(size, type_)
            together = [
                pa.concat_arrays([pa.array(columns[0], pa.int64()), pa.array(rows, pa.int64())]),
                pa.concat_arrays([pa.array(columns[1], id_type), none(m, id_type)]),
                pa.concat_arrays([pa.array(columns[2], pa.bool_()), none(m, pa.bool_())]),
                *(pa.concat_arrays([pa.array(columns[i], type_), none(m, type_)]) for i, type_ in ((3, pa.int64()), (4, pa.int64()), (5, pa.float64()), (6, pa.float64()))),
                pa.concat_arrays([none(n, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64))]),
                pa.concat_arrays([none(n, pa.int32()), pa.array(times, pa.int32())]),
            ]
            yield pa.RecordBatch.from_arrays(together, ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "key", "times"])

    schema = f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, key long, times int"
    found = written(narrow.mapInArrow(parts, schema), "parts")
    rare = found.filter("key is not null").select("row", "key", "times")
    by_key = values.select(F.xxhash64("word").alias("key"), "n", "marginal")
    one = F.log10((F.col("n") + 1) / F.lit(float(train_tokens + kinds + 1)))
    sums = rare.join(by_key, "key").groupBy("row").agg(
        F.sum(F.col("times") * one).alias("rare_base"),
        F.sum(F.col("times") * F.col("marginal")).alias("rare_score"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
    )
    texts = found.filter("key is null").drop("key", "times").join(sums, "row", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    return texts.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("rare_known")).alias("n_known"), F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base")).alias("base_score"), (F.col("score") + zero("rare_score")).alias("score"),
    )
