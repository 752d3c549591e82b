"""Mixing sources to target weights by Pareto order sampling, from DataFrame operations alone.

A source's target fixes how many copies of each of its documents are expected: the rate, target over size, or that
rate times the document's own weight. The whole part of the expectation is certain copies. The rest is an
inclusion probability p, and the documents with p > 0 are ranked by the odds of a random number over the odds of
p (Pareto order sampling). The sample is a prefix of that ranking, of fixed size in words: the one whose words come nearest
to what the certain copies leave of the target.

The prefix needs no sort of a source. Ranks are numbers below 2^48; words are counted in 4096 bins of them, the
bin in which the budget ends is counted in finer bins, and so on. A source that holds a third of all rows is 4096 counts.

Defined results: a null text has size 0 and is never taken. Sources go by code point, null last, as a source of its own. The random
number depends on seed, doc_id and text, so reruns agree, and rows that share a null or repeated doc_id are drawn one by one; only
rows of a source that are equal in both are taken together or not at all. A source without words has target 0. Further columns pass,
whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from monthmill.llm.common import WORD, columns_of, free_name, hash_bits, sized, text_or_empty, written

WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
SEED = 20240

#: Ranks have LEVELS * LEVEL_BITS bits.
LEVEL_BITS = 12
LEVELS = 4
_RANKS = 1 << (LEVEL_BITS * LEVELS)


def word_count(text: str = "text") -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def source_key(source: str = "source") -> Column:
    """A null-safe join key: the source's name marked as such, or a mark of its own for null."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source).cast("string")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(key, source_size, target) of each source from rows of (key, source, size).

    Weights repeat over the sources in order. Where a share exceeds `most` times the source's size, it stops there and the excess
    goes to the others by weight. The capped sources are those first in order of cap over weight, so the level
    of the others follows from sums over that order. There is one row per source, not per document.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    per_source = sizes.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(ordered) - 1) % len(weights) + 1
    weighed = per_source.withColumn("weight", F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), place))
    by_cap = Window.orderBy(F.col("source_size") / F.col("weight"), "key")
    everything = Window.partitionBy(F.lit(0))
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levelled = weighed.withColumn("level", left.cast("double") / open_weight)
    capped = (most * F.col("source_size")).cast("double") <= F.col("weight") * F.col("level")
    rest = F.min(F.when(~capped, F.struct("position", "level"))).over(everything)["level"]
    share = F.least((most * F.col("source_size")).cast("double"), F.col("weight") * F.coalesce(rest, F.lit(float("inf"))))
    return levelled.withColumn("position", F.row_number().over(by_cap)).select("key", "source_size", share.alias("target"))


def _expected(rate: Column, weight: str | None, most: int) -> Column:
    return F.least(F.lit(float(most)), rate * F.col(weight)) if weight else rate


def _rates(rows: DataFrame, sources: DataFrame, weight: str | None, most: int) -> DataFrame:
    """(key, source_size, target, rate): the rate at which the expected words of a source are its target."""
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = written(sources.withColumn("rate", rate), "rates")
    if weight is None:
        return sources
    # What a document's cap cuts off goes to the others of its source, until no further document meets its cap. The rate starts
    # at none and only grows, as does the number of capped documents.
    sources, before = written(sources.withColumn("rate", F.lit(0.0)), "rates"), -1
    while True:
        capped = F.col("rate") * F.col(weight) >= most
        sums = rows.join(sized(sources.select("key", "rate")), "key").groupBy("key").agg(
            F.sum(F.when(capped, most * F.col("size")).otherwise(0)).alias("capped"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("size") * F.col(weight))).alias("open"),
            F.count_if(capped).alias("n_capped"),
        )
        again = F.when(F.col("open") > 0, (F.col("target") - F.col("capped")) / F.col("open")).otherwise(F.col("rate"))
        found = written(sources.join(sums, "key").select("key", "source_size", "target", F.greatest("rate", again).alias("rate"), "n_capped"), "rates")
        sources, n = found.drop("n_capped"), found.agg(F.sum("n_capped")).first()[0] or 0
        if n == before:
            return sources
        before = n


def draw(doc_id: str, text: str, seed: int) -> Column:
    """A random number below 2^48 that a row's id and text fix."""
    own = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    return hash_bits(F.concat_ws(":", F.lit(str(seed)), own, F.md5(text_or_empty(text).cast("binary"))))


def _rank(expected: Column, drawn: Column) -> Column:
    """Random odds over inclusion odds q, as floor(q / (1 + q) * 2^48), which keeps their order; null without a fraction."""
    u = (drawn + 0.5) / float(1 << 48)
    p = expected - F.floor(expected)
    odds = (u / (1 - u)) / (p / (1 - p))
    return F.when(p > 0, F.floor(odds / (1 + odds) * float(_RANKS)).cast("long"))


def _cuts(ranked: DataFrame, sources: DataFrame) -> DataFrame:
    """(key, cut): per source the rank below which documents are taken once more, from rows of (key, size, certain, rank)."""
    certain = ranked.groupBy("key").agg(F.sum(F.col("certain") * F.col("size")).alias("certain_words"))
    open_rows = ranked.filter(F.col("rank").isNotNull() & (F.col("size") > 0)).select("key", "rank", "size")
    at = written(
        sources.join(certain, "key").select("key", F.lit(0).cast("long").alias("base"), (F.col("target") - F.col("certain_words")).alias("budget")),
        "budgets",
    )
    done = None
    for level in range(LEVELS):
        step = 1 << (LEVEL_BITS * (LEVELS - 1 - level))
        inside = open_rows.join(sized(at), "key").filter(
            (F.col("rank") >= F.col("base")) & (F.col("rank") < F.col("base") + step * (1 << LEVEL_BITS))
        )
        bins = inside.groupBy("key", "base", "budget", F.floor((F.col("rank") - F.col("base")) / step).cast("long").alias("bin")).agg(F.sum("size").alias("words"))
        in_order = Window.partitionBy("key").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
        running = bins.withColumn("upto", F.sum("words").over(in_order))
        # The bin in which the budget ends: the first whose running words reach it. Below it, everything is taken.
        ends = running.filter((F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("words") < F.col("budget")))
        ends = ends.select("key", (F.col("base") + F.col("bin") * step).alias("base"), (F.col("budget") - (F.col("upto") - F.col("words"))).alias("budget"), "words")
        ends = written(ends, "ends")
        # Sources whose budget is none, or beyond all their words, are settled: nothing or everything of this range.
        settled = at.join(ends.select("key"), "key", "left_anti").select(
            "key", F.when(F.col("budget") <= 0, F.col("base")).otherwise(F.col("base") + step * (1 << LEVEL_BITS)).alias("cut")
        )
        done = settled if done is None else done.unionByName(settled)
        at = ends.drop("words") if level < LEVELS - 1 else ends
    # One rank is left for each: it is taken if that comes nearer to the budget.
    last = at.select("key", F.when(F.col("words") - F.col("budget") < F.col("budget"), F.col("base") + 1).otherwise(F.col("base")).alias("cut"))
    return written(done.unionByName(last), "cuts")


def _plan(narrow: DataFrame, weight: str | None, weights: tuple[int, ...], most: int) -> DataFrame:
    """(key, source_size, target, rate, cut) of each source from rows of (doc_id, key, source, size, drawn[, weight])."""
    sources = _rates(narrow, targets(narrow, weights, most), weight, most)
    expected = _expected(F.col("rate"), weight, most)
    ranked = narrow.join(sized(sources), "key").select(
        "key", "size", F.floor(expected).alias("certain"), _rank(expected, F.col("drawn")).alias("rank")
    )
    return written(sources.join(_cuts(ranked, sources), "key"), "mix")


def _narrow(docs: DataFrame, doc_id: str, text: str, source: str, weight: str | None, seed: int) -> DataFrame:
    columns = [F.col(doc_id).alias("doc_id"), source_key(source).alias("key"), F.col(source).alias("source"), word_count(text).alias("size"), draw(doc_id, text, seed).alias("drawn")]
    if weight:
        columns.append(F.greatest(F.lit(0.0), F.coalesce(F.col(weight).cast("double"), F.lit(0.0))).alias("weight"))
    return written(docs.select(*columns), "sizes")


def _copies(rate: str, cut: str, weight: str | None, drawn: Column, most: int) -> Column:
    expected = _expected(F.col(rate), weight, most)
    extra = F.coalesce(_rank(expected, drawn) < F.col(cut), F.lit(False))
    return (F.floor(expected) + extra.cast("int")).cast("int")


def mix_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None,
               weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (its words in the mix, repeats counted), copies."""
    narrow = _narrow(docs, doc_id, text, source, weight, seed)
    own = "weight" if weight else None
    plan = sized(_plan(narrow, own, weights, most))
    copies = F.when(F.col("size") > 0, _copies("rate", "cut", own, F.col("drawn"), most)).otherwise(F.lit(0))
    return narrow.join(plan, "key").withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies"
    )


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weight: str | None = None,
        weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: int = SEED) -> DataFrame:
    """The mix itself: the documents' rows with all their columns, as many of each as it takes copies."""
    plan = _plan(_narrow(docs, doc_id, text, source, weight, seed), "weight" if weight else None, weights, most)
    key, rate, cut, copy = (free_name(docs, name) for name in ("mix_key", "mix_rate", "mix_cut", "mix_copy"))
    plan = sized(plan.select(F.col("key").alias(key), F.col("rate").alias(rate), F.col("cut").alias(cut)))
    rows = docs.withColumn(key, source_key(source)).join(plan, key)
    own = None
    if weight:
        own = free_name(docs, "mix_weight")
        rows = rows.withColumn(own, F.greatest(F.lit(0.0), F.coalesce(F.col(weight).cast("double"), F.lit(0.0))))
    some = text_or_empty(text).rlike(WORD)
    copies = F.when(some, _copies(rate, cut, own, draw(doc_id, text, seed), most)).otherwise(F.lit(0))
    return rows.withColumn(copy, F.explode(F.array_repeat(F.lit(0), copies))).select(*columns_of(docs))
