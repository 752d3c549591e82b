from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from monthmill.llm import exact_dedup, mixing, sharding
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing

BLANK = " \t\n\x0b\x0c\r"


def bare(text):
    return "".join(c for c in text or "" if c not in BLANK)


def plain_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[bare(text)].append((-len(text or ""), doc_id is None, doc_id or 0))
    out = Counter()
    for doc_id, text in rows:
        group = groups[bare(text)]
        best = min(group)
        sha = hashlib.sha256(bare(text).encode()).hexdigest()
        out[doc_id, None if best[1] else best[2], len(group), sha] += 1
    return out, len(groups)


@pytest.fixture(scope="module")
def copied():
    rng = random.Random(1)
    rows = [(i, text_of(rng, 2)) for i in range(300)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(60)]
    rows += [(2000 + i, rows[i][1].replace(" ", "\n ")) for i in range(20)]
    return rows


def check_groups(df, rows):
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect())
    want, groups = plain_groups(rows)
    assert got == want
    kept = df.filter("kept").groupBy("text_sha256").count().collect()
    assert len(kept) == groups and all(r["count"] == 1 for r in kept)


def test_exact_groups(spark, copied):
    check_groups(exact_dedup.duplicate_groups(documents(spark, copied)), copied)


def test_exact_groups_odd_rows(spark):
    check_groups(exact_dedup.duplicate_groups(with_clashing(odd_documents(spark))), [r[:2] for r in odd_rows()])


def test_exact_documents(spark, copied):
    docs = with_clashing(documents(spark, copied))
    kept = exact_dedup.distinct_documents(docs)
    assert kept.columns == docs.columns
    groups = exact_dedup.duplicate_groups(docs)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in groups.filter("kept").collect())


def test_exact_documents_odd_rows(spark):
    kept = exact_dedup.distinct_documents(with_clashing(odd_documents(spark))).collect()
    assert Counter(bare(r.text) for r in kept) == Counter({bare(r[1]) for r in odd_rows()})
    assert [r.text for r in kept if bare(r.text) == "Samerowhere."] == ["Same  row\nhere."]


def test_exact_empty(spark):
    assert exact_dedup.duplicate_groups(empty_documents(spark)).count() == 0
    assert exact_dedup.distinct_documents(empty_documents(spark)).count() == 0


def test_filter_passes_unique_texts_without_a_shuffle(spark, copied):
    docs = exact_dedup.written(documents(spark, copied).select(exact_dedup.digest().alias("sha")), "test")
    bloom, words = exact_dedup.repeated_filter(docs, "sha")
    marked = exact_dedup.flagged(docs, "sha", bloom, words, "flag").groupBy("sha").agg(F.max("flag").alias("flag"), F.count("*").alias("n")).collect()
    assert all(r.flag for r in marked if r.n > 1)
    assert sum(r.flag for r in marked if r.n == 1) <= 0.1 * len(marked)


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = total - sum(capped.values())
        free = sum(weight[s] for s in names if s not in capped)
        share = {s: rest * weight[s] / free for s in names if s not in capped}
        over = {s: 3 * sizes[s] for s, x in share.items() if x > 3 * sizes[s]}
        if not over:
            return capped | share
        capped |= over


def sourced(n=900):
    rng = random.Random(3)
    sources = ["a"] * 12 + ["b"] * 2 + ["c"] + ["d"] * 3 + [None]
    return [(i, text_of(rng, rng.randint(1, 6)), rng.choice(sources)) for i in range(n)]


def test_mix_targets_and_words(spark):
    rows = sourced()
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(text.split())
    want = plain_targets(sizes)
    got = mixing.mix_report(documents(spark, rows)).collect()
    source_of = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[source_of[r.doc_id]]
        assert r.target == pytest.approx(want[source_of[r.doc_id]])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[source_of[r.doc_id]] += r.taken
    for source, target in want.items():
        assert abs(taken[source] - target) <= 72  # a document's words, at most
    assert len(got) == len(rows)


def test_mix_certain_copies_and_reruns(spark):
    docs = documents(spark, sourced())
    first, second = (sorted(map(tuple, mixing.mix_report(d).collect())) for d in (docs, docs.repartition(7)))
    assert first == second
    for r in mixing.mix_report(docs).collect():
        rate = r.target / r.source_size
        assert int(rate) <= r.copies <= int(rate) + 1


def test_mix_documents(spark):
    docs = with_clashing(documents(spark, sourced()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    want = {r.doc_id: r.copies for r in mixing.mix_report(docs).collect() if r.copies}
    assert Counter(r.doc_id for r in mixed.select("doc_id").collect()) == want


def test_mix_unequal_weights(spark):
    docs = documents(spark, sourced(2000)).withColumn("quality", F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0))
    rows = mixing.mix_report(docs, weight="quality").collect()
    by = defaultdict(lambda: [0, 0])
    for r in rows:
        by[r.source_size, r.doc_id % 2][0] += r.taken
        by[r.source_size, r.doc_id % 2][1] += r.size
    big = max(k[0] for k in by)
    even, odd = (by[big, k][0] / by[big, k][1] for k in (0, 1))
    assert 2 < even / odd < 4.5
    words, target = sum(r.taken for r in rows if r.source_size == big), next(r.target for r in rows if r.source_size == big)
    assert abs(words - target) < 80


def test_mix_odd_rows_and_empty(spark):
    docs = with_clashing(odd_documents(spark))
    report = mixing.mix_report(docs).collect()
    assert len(report) == len(odd_rows()) and all(r.taken == 0 for r in report if r.size == 0)
    assert mixing.mix(docs).count() == sum(r.copies for r in report)
    assert mixing.mix_report(empty_documents(spark)).count() == mixing.mix(empty_documents(spark)).count() == 0


def check_shards(rows, limit):
    shards = defaultdict(lambda: [0, 0])
    for r in rows:
        assert len(r.shard) == r.depth
        shards[r.shard][0] += r.n_bytes
        shards[r.shard][1] += 1
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for r in rows:
        assert (r.shard_bytes, r.shard_docs) == tuple(shards[r.shard]) and r.oversized == (r.shard_bytes > limit)
    for name, (size, docs) in shards.items():
        assert size <= limit or docs == 1
        if name:  # only an oversized bucket was split
            parent = [v for other, v in shards.items() if other.startswith(name[:-1])]
            assert sum(v[0] for v in parent) > limit


@pytest.mark.parametrize("limit", [400, 5000, 1 << 30])
def test_shards(spark, copied, limit):
    rows = sharding.shard_report(documents(spark, copied), limit).collect()
    assert len(rows) == len(copied)
    check_shards(rows, limit)


def test_shards_of_equal_ids_and_rows(spark):
    rows = [(None, f"text {i % 3}") for i in range(300)] + [(7, "the same row")] * 300
    got = sharding.shard_report(documents(spark, rows), 200).collect()
    assert len(got) == 600
    check_shards(got, 200)


def test_shard_directory_and_files(spark, copied, tmp_path):
    docs = with_clashing(documents(spark, copied))
    report = sharding.shard_report(docs, 2000)
    pointers = sharding.directory(report).collect()
    deepest = max(len(p.prefix) for p in pointers)
    assert len(pointers) == len({p.prefix for p in pointers}) == 2**deepest
    assert all(p.prefix.startswith(p.shard) for p in pointers)
    sharding.write_shards(docs, str(tmp_path / "shards"), 2000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == len(copied) and {r[0] for r in back.select(back.columns[-1]).distinct().collect()} == {"b" + r.shard for r in report.collect()}


def test_shard_ranges(spark, copied):
    """As many pointers as the directory where that is small, and one row per shard where it could not be listed."""
    report = sharding.shard_report(documents(spark, copied), 2000)
    pointers = {p.prefix: p.shard for p in sharding.directory(report).collect()}
    deepest = len(next(iter(pointers)))
    ranges = sharding.directory_ranges(report).collect()
    for prefix, shard in pointers.items():
        low = int(prefix.ljust(sharding.BITS, "0"), 2)
        assert [r.shard for r in ranges if r.first <= low <= r.last] == [shard]
    assert sum(r.last - r.first + 1 for r in ranges) == 1 << sharding.BITS and deepest > 3
    equal = sharding.shard_report(documents(spark, [(i, f"text {i}") for i in range(300)] + [(7, "the same row")] * 300), 200)
    deep = sharding.directory_ranges(equal).collect()
    assert max(r.depth for r in deep) > 40 and len(deep) == equal.select("shard").distinct().count()
    spans = sorted((r.first, r.last) for r in deep)
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    assert sharding.directory_ranges(sharding.shard_report(empty_documents(spark))).count() == 0


def test_shards_odd_rows_and_empty(spark):
    rows = sharding.shard_report(with_clashing(odd_documents(spark)), 1000).collect()
    assert len(rows) == len(odd_rows())
    check_shards(rows, 1000)
    assert sharding.shard_report(empty_documents(spark)).count() == 0
