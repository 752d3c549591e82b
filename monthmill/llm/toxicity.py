"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence is toxic with probability sigmoid(bias + sum of its features' weights); a document is toxic unless none of its sentences
is (noisy-or): 1 - prod(1 - p). Bias and weights are fitted to document labels through that product,
which also tells which sentences offend. Features are words and their letter runs of three to six, edges marked, that
occur in more contexts of toxic documents than chance allows, and in several of these. Contexts are distinct
neighbouring words, so a copied document counts once.

Fitted on a bounded sample: the SAMPLE distinct labelled texts with the smallest hashes. Features are counted by Spark; the driver gets the
FEATURES best of them and, for sentences with one, their numbers. Scoring reads whole texts in one pass without a shuffle.

Defined results: a null or empty text has no sentence and scores 0. If the sample has no toxic text, or no feature
passes, every score is 0. Of a text with different labels, the larger counts. Null labels are not used. Rows that repeat score alike.
Further columns pass, whatever their names. An empty table gives no rows, an empty table of labels scores of 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import columns_of, free_name, id_remainder, rows_of, ship, text_or_empty, values_of, written

#: Distinct labelled texts that the model is fitted on at most.
SAMPLE = 20_000
FEATURES = 2048
FOLDS, HELD_OUT = 5, 0
#: Log-likelihood ratio, contexts in toxic texts, share of toxic ones, and toxic texts that a feature must have.
LEAST_RATIO, LEAST_CONTEXTS, LEAST_SHARE, LEAST_TEXTS = 30.0, 5, 0.5, 3
THRESHOLD = 0.5

_WORDS = re.compile(r"[^\W\d_]+")
_SENTENCES = re.compile(r"[^.!?\n]+")
#: Entries of a task's table of words or letter runs before it is emptied.
_TABLE = 200_000


def letter_runs(word: str) -> set[str]:
    """Features of a word: the word itself and its runs of 3 to 6 letters, edges included."""
    marked = f"^{word}$"
    return {marked[i : i + n] for n in range(3, 7) for i in range(len(marked) - n + 1)} | {marked}


def _sample(docs: DataFrame, labels: DataFrame, size: int) -> DataFrame:
    """(text, toxic) of distinct labelled training texts."""
    known = labels.filter(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(id_remainder(FOLDS) != HELD_OUT)
    tag = F.md5(text_or_empty())
    tagged = docs.select("doc_id", tag.alias("tag")).join(known, "doc_id")  # texts themselves don't move
    few = tagged.groupBy("tag").agg(F.max("toxic").alias("toxic"), F.min("doc_id").alias("doc_id")).orderBy("tag").limit(size)
    few = F.broadcast(written(few, "labelled"))  # `size` rows at most
    texts = docs.select("doc_id", text_or_empty().alias("text"), tag.alias("tag")).join(few, ["doc_id", "tag"])
    return written(texts.dropDuplicates(["tag"]).select("text", "toxic"), "sample")


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, before, after, toxic) of each text, distinct."""
    for text, toxic in rows_of(batches):
        words = ["", *_WORDS.findall(text.lower()), ""]
        found = list(set(zip(words[1:-1], words, words[2:])))
        if found:
            columns = [pa.array(c, pa.string()) for c in zip(*found)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([toxic] * len(found), pa.int32())], ["word", "before", "after", "toxic"])


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, toxic, clean): contexts of the words that have a run of letters, summed within the task."""
    toxic, clean = Counter(), Counter()

    def out() -> pa.RecordBatch:
        runs = list(toxic.keys() | clean.keys())
        columns = [pa.array(runs, pa.string()), *(pa.array([c[r] for r in runs], pa.int64()) for c in (toxic, clean))]
        toxic.clear(), clean.clear()
        return pa.RecordBatch.from_arrays(columns, ["run", "toxic", "clean"])

    for word, t, c in rows_of(batches):
        for run in letter_runs(word):
            if t:
                toxic[run] += t
            if c:
                clean[run] += c
        if len(toxic) + len(clean) > _TABLE:
            yield out()
    yield out()


def _runs_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(run, texts): texts that have a run of letters, summed within the task."""
    texts: Counter = Counter()

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(texts), pa.string()), pa.array(list(texts.values()), pa.int64())], ["run", "texts"])
        texts.clear()
        return batch

    for (text,) in rows_of(batches):
        texts.update(set().union(*map(letter_runs, set(_WORDS.findall(text.lower())))))
        if len(texts) > _TABLE:
            yield out()
    yield out()


def select_features(sample: DataFrame) -> list[str]:
    """The letter runs most associated with toxic texts, best first."""
    contexts = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(_contexts, "word string, before string, after string, toxic int")
    contexts = contexts.select("word", F.xxhash64("before", "after").alias("context"), "toxic")
    words = contexts.groupBy("word", "context").agg(F.max("toxic").alias("toxic")).groupBy("word").agg(
        F.sum((F.col("toxic") > 0).cast("long")).alias("toxic"), F.sum((F.col("toxic") <= 0).cast("long")).alias("clean")
    )
    words = written(words, "words")
    all_toxic, all_clean = (x or 0 for x in words.agg(F.sum("toxic"), F.sum("clean")).first())
    if not all_toxic:
        return []
    runs = words.mapInArrow(_run_counts, "run string, toxic long, clean long").groupBy("run").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = all_toxic / (all_toxic + all_clean)
    t, c = F.col("t").cast("double"), F.col("c").cast("double")
    both = t + c

    def part(x, expected):
        return F.when(x > 0, x * F.log(x / expected)).otherwise(F.lit(0.0))

    ratio = 2 * (part(t, both * share) + part(c, both * (1 - share)))
    good = (t >= LEAST_CONTEXTS) & (t / both >= F.lit(max(LEAST_SHARE, min(1.0, 2 * share)))) & (ratio >= LEAST_RATIO)
    several = sample.filter("toxic > 0").select("text").mapInArrow(_runs_of_texts, "run string, texts long").groupBy("run").agg(F.sum("texts").alias("texts"))
    good_runs = written(runs.filter(good).select("run", ratio.alias("ratio")), "runs")
    best = good_runs.join(several.filter(F.col("texts") >= LEAST_TEXTS), "run").select("run", "ratio").orderBy(F.desc("ratio"), "run").limit(FEATURES)
    return [row.run for row in best.collect()]


class _Words(dict):
    """Word -> numbers of its known letter runs, found when first wanted; emptied when it is full."""

    def __init__(self, features: list[str]):
        super().__init__()
        self.numbers = {run: i for i, run in enumerate(features)}
        self.starts = {run[:3] for run in features}

    def __missing__(self, word: str) -> tuple[int, ...]:
        marked = f"^{word}$"
        starts = [i for i in range(len(marked) - 2) if marked[i : i + 3] in self.starts]
        runs = {marked[i : i + n] for i in starts for n in range(3, 7)}
        runs.add(marked)
        if len(self) >= _TABLE:
            self.clear()
        found = self[word] = tuple(sorted(self.numbers[run] for run in runs if run in self.numbers))
        return found


class Scorer:
    """Sentences of a text with known features, and their weights once fitted."""

    def __init__(self, features: list[str], weights: np.ndarray | None = None, bias: float = 0.0):
        self.words = _Words(features)
        self.weights, self.bias = weights, bias

    def sentences(self, text: str) -> tuple[int, list[tuple[int, int, tuple[int, ...]]]]:
        """The number of sentences without a feature, and (start, end, features) of the others."""
        lower = text.lower()
        if len(lower) != len(text):  # a letter whose lower case is longer would move positions
            lower = "".join(map(lambda x: x.lower()[0], text))
        words = list(set(_WORDS.findall(lower)))
        some = set(compress(words, map(self.words.__getitem__, words)))
        plain, found = 0, []
        for sentence in _SENTENCES.finditer(lower):
            part = sentence[0]
            features: set[int] = set()
            if some:
                for word in some.intersection(_WORDS.findall(part)):
                    features.update(self.words[word])
            if features:
                found.append((sentence.start(), sentence.end(), tuple(sorted(features))))
            elif not part.isspace():
                plain += 1
        return plain, found

    def score(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The document's probability, and (start, end, probability) of its offending sentences."""
        plain, found = self.sentences(text)
        if not found:
            return float(-np.expm1(-plain * np.logaddexp(0.0, self.bias))), []
        logits = self.bias + np.array([self.weights[list(features)].sum() for *_, features in found])
        log_clean = -plain * np.logaddexp(0.0, self.bias) - np.logaddexp(0.0, logits).sum()
        p = 1 / (1 + np.exp(-logits))
        offending = [(start, end, float(q)) for (start, end, _), q in zip(found, p) if q >= THRESHOLD]
        return float(min(1.0, max(0.0, -np.expm1(log_clean)))), offending


def fit(bags: list[tuple[int, int, list[list[int]]]], n_features: int, rounds: int = 400, rate: float = 0.1, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias that maximise the likelihood of document labels under noisy-or, by Adam on all bags.

    bags: (toxic, sentences without a feature, features of each other sentence).
    """
    label = np.array([b[0] > 0 for b in bags], float)
    plain = np.array([b[1] for b in bags], float)
    doc = np.array([i for i, b in enumerate(bags) for _ in b[2]], np.int64)
    sentences = [f for b in bags for f in b[2]]
    of = np.repeat(np.arange(len(sentences)), [len(f) for f in sentences])
    feature = np.array([x for f in sentences for x in f], np.int64)
    weights = np.full(n_features + 1, 0.1)
    weights[-1] = -6.0  # the bias
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        bias = weights[-1]
        z = bias + np.bincount(of, weights[feature], len(sentences))
        log_clean = -plain * np.logaddexp(0, bias) - np.bincount(doc, np.logaddexp(0, z), len(bags))
        clean = np.exp(np.minimum(log_clean, -1e-9))
        # d(-log likelihood)/d(log_clean): 1 side for clean documents, clean/(1 - clean) for toxic ones
        slope = np.where(label > 0, clean / (1 - clean), -1.0) / len(bags)
        by_sentence = -slope[doc] / (1 + np.exp(-z))
        gradient = np.bincount(feature, by_sentence[of], n_features + 1)
        gradient[-1] = by_sentence.sum() - (slope * plain).sum() / (1 + np.exp(-bias))
        gradient[:-1] += decay * weights[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        weights -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-9)
        weights[-1] = min(weights[-1], -3.0)
    return weights[:-1], float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, sample_size: int = SAMPLE) -> tuple[list[str], np.ndarray, float]:
    """Features, weights and bias from the labelled texts that are not held out."""
    ship(docs.sparkSession)
    sample = _sample(docs, labels, sample_size)
    features = select_features(sample)
    if not features:
        return [], np.zeros(0), -np.inf
    scorer = Scorer(features)

    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scorer.sentences(text) for text in values_of(batch.column(0))]
            columns = [batch.column(1), pa.array([plain for plain, _ in rows], pa.int64()), pa.array([[list(f) for *_, f in found] for _, found in rows], pa.list_(pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "plain", "found"])

    found = sample.select("text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(bags, "toxic int, plain long, found array<array<int>>")
    weights, bias = fit([tuple(row) for row in found.collect()], len(features))
    return features, weights, bias


def score_toxicity(docs: DataFrame, model: tuple[list[str], np.ndarray, float], into: str, text: str = "text") -> DataFrame:
    """The documents with a column `into`: score (0 to 1) and offending, an array of (start, end, score) of sentences in code points."""
    ship(docs.sparkSession)
    scorer = Scorer(*model)
    kind = pa.struct([("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))])

    @F.arrow_udf("struct<score double, offending array<struct<start int, end int, score double>>>")
    def scores(texts: pa.Array) -> pa.Array:
        rows = [scorer.score(x) if scorer.words.numbers else (0.0, []) for x in values_of(texts)]
        return pa.array([{"score": p, "offending": [dict(zip(("start", "end", "score"), s)) for s in found]} for p, found in rows], kind)

    return docs.withColumn(into, scores(text_or_empty(text)))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending."""
    scored = score_toxicity(docs.select("doc_id", "text"), train(docs, labels), "found")
    return scored.select(
        "doc_id",
        (id_remainder(FOLDS) == HELD_OUT).alias("held_out"),
        F.col("found.score").alias("score"),
        (F.col("found.score") >= THRESHOLD).cast("int").alias("predicted"),
        F.col("found.offending").alias("offending"),
    )


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of documents that are not predicted toxic, with all their columns."""
    found = free_name(docs, "toxicity")
    scored = score_toxicity(docs, train(docs, labels), found)
    return scored.filter(F.col(found)["score"] < THRESHOLD).select(*columns_of(docs))
