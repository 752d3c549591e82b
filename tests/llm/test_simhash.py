from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from monthmill.llm import simhash
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << i for i in range(64) if sum(h >> i & 1 for h in hashes) * 2 > len(hashes)) if hashes else 0


def plain_components(values, most=3):
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    values = sorted(parent)
    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= most:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def check(rows, got):
    fps = [plain_fingerprint(r[1]) for r in rows]
    root = plain_components(set(fps))
    least = {}
    for (doc_id, *_), fp in zip(rows, fps):
        if doc_id is not None:
            least[root[fp]] = min(doc_id, least.get(root[fp], doc_id))
    want = Counter((r[0], f"{fp:016x}", least.get(root[fp])) for r, fp in zip(rows, fps))
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def near_rows():
    rng = random.Random(2)
    rows = []
    for i in range(60):
        text = text_of(rng, 60)
        rows.append((i, text))
        for j in range(i % 4):
            words = text.split()
            words[rng.randrange(len(words))] = "changed"
            rows.append((1000 * (j + 1) + i, " ".join(words)))
    return rows + [(5000 + i, rows[3][1]) for i in range(40)]


def test_documents_against_all_pairs(spark):
    rows = near_rows()
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    check(rows, got)
    assert len({r.component_id for r in got}) < len(set(t for _, t in rows))


def test_one_document_of_each_component_stays(spark):
    docs = with_clashing(documents(spark, near_rows()))
    kept = simhash.distinct_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.component_id for r in simhash.near_duplicates(docs).collect()})


def test_odd_rows_and_empty(spark):
    docs = with_clashing(odd_documents(spark))
    got = simhash.near_duplicates(docs).collect()
    check(odd_rows(), got)
    assert len(got) == len(odd_rows())
    fps = {plain_fingerprint(r[1]) for r in odd_rows()}
    assert simhash.distinct_documents(docs).count() == len(set(plain_components(fps).values()))
    assert simhash.near_duplicates(empty_documents(spark)).count() == simhash.distinct_documents(empty_documents(spark)).count() == 0


@pytest.mark.parametrize("half_members", [1, 3, 4096])
def test_links_of_crowded_halves(spark, half_members):
    """Fingerprints that share halves, at many distances: every size of key finds the same parts."""
    rng = np.random.default_rng(4)
    values = set()
    for _ in range(12):
        centre = int(rng.integers(0, 1 << 64, dtype=np.uint64))
        for _ in range(25):
            value = centre
            for bit in rng.choice(64, rng.integers(1, 7), replace=False):
                value ^= 1 << int(bit)
            values.add(value)
        half = int(rng.integers(0, 1 << 32))
        values |= {half << 32 | int(x) for x in rng.integers(0, 1 << 32, 8)} | {int(x) << 32 | half for x in rng.integers(0, 1 << 32, 8)}
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long").repartition(4)
    links = simhash.linked(nodes, 3, half_members)
    found = {r.node: r.component for r in simhash.components(links).collect()}
    got = {v: found.get(v, v) for v in signed}
    want = plain_components(values)
    group = lambda labels: sorted(sorted(x for x in labels if labels[x] == r) for r in set(labels.values()))
    assert group(got) == group({int(np.uint64(k).view(np.int64)): int(np.uint64(v).view(np.int64)) for k, v in want.items()})
    assert all((int(np.int64(a).view(np.uint64)) ^ int(np.int64(b).view(np.uint64))).bit_count() <= 64 for a, b in links.collect())


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    found = {r.node: r.component for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 300)}
