"""Toxicity, language model, fingerprints and personal data."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from monthmill.llm import lattice_lm, order_minhash, pii, toxicity
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing

# --- toxicity


def toxic_rows(n=700):
    rng, rows, labels = random.Random(6), [], []
    for i in range(n):
        sentences = [s + "." for s in text_of(rng, rng.randint(3, 12)).split(". ")]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(2):
                at = rng.randrange(len(sentences))
                sentences[at] = sentences[at].replace(" ", f" {rng.choice(['grobnak', 'zulfen', 'grobnaking'])} ", 1)
        rows.append((i, " ".join(sentences)))
        labels.append((i, 0, int(toxic)))
    return rows, labels


def test_toxicity_of_held_out_documents(spark):
    rows, labels = toxic_rows()
    docs = with_clashing(documents(spark, rows))
    known = spark.createDataFrame(labels + [(5000, 1, 1), (1, 0, None)], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity_report(docs, known).collect()
    label = {i: t for i, _, t in labels}
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == label[r.doc_id] for r in held]) > 0.97
    for r in held:  # the offending sentences hold the words
        text = dict(rows)[r.doc_id]
        for s in r.offending:
            assert any(w in text[s.start : s.end].lower() for w in ("grobnak", "zulfen"))
    clean = toxicity.clean_documents(docs, known)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.select("doc_id").collect()) == sorted(r.doc_id for r in got if not r.predicted)


def test_labels_of_held_out_rows_are_not_learnt(spark):
    rows, labels = toxic_rows(300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    one, two = (toxicity.train(documents(spark, rows), spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert one[0] == two[0] and np.allclose(one[1], two[1]) and one[2] == pytest.approx(two[2])


def test_toxicity_odd_rows_and_empty(spark):
    labels = spark.createDataFrame([(i, 0, i % 2) for i in range(11)] * 2, "doc_id long, quality int, toxic int")
    docs = with_clashing(odd_documents(spark))
    got = toxicity.toxicity_report(docs, labels).collect()
    assert len(got) == len(odd_rows()) and all(r.score == 0 for r in got if r.doc_id in (1, 2, 3))
    none = labels.limit(0)
    assert all(r.score == 0 for r in toxicity.toxicity_report(docs, none).collect())
    assert toxicity.clean_documents(docs, none).count() == len(odd_rows())
    assert toxicity.toxicity_report(empty_documents(spark), labels).count() == 0


@pytest.mark.parametrize("step, columns", [("_contexts", 2), ("_runs_of_texts", 1)])
def test_texts_of_a_batch_are_not_all_held(step, columns):
    """A batch of 20 MB of texts takes a worker few more."""
    batch = pa.RecordBatch.from_arrays([pa.array([f"{i:05}" * 1000 for i in range(4000)]), pa.array([0] * 4000, pa.int32())][:columns], ["text", "toxic"][:columns])
    tracemalloc.start()
    for _ in getattr(toxicity, step)(iter([batch])):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5_000_000


def test_noisy_or_fit():
    """One feature that makes toxic, one that does not: the bags' labels tell which."""
    rng = np.random.default_rng(0)
    bags = []
    for _ in range(400):
        toxic = int(rng.random() < 0.4)
        sentences = [[1]] * int(rng.integers(0, 3)) + ([[0, 1]] if toxic else [])
        bags.append((toxic, int(rng.integers(1, 20)), sentences))
    weights, bias = toxicity.fit(bags, 2)
    p = lambda z: 1 / (1 + math.exp(-z))
    assert p(bias + weights[0] + weights[1]) > 0.9 and p(bias + weights[1]) < 0.1 and p(bias) < 0.05


# --- language model


def plain_marginal(word, p):
    """Sum over all segmentations of a marked word."""
    word = "▁" + word

    @np.vectorize
    def of(end):
        return sum(p.get(word[start:end], 0) * ways[start] for start in range(max(0, end - 20), end))

    ways = [1.0]
    for end in range(1, len(word) + 1):
        ways.append(float(of(end)))
    return math.log10(ways[-1])


def test_marginals_are_sums_over_segmentations():
    pieces, prior = lattice_lm.vocabulary(lattice_lm.vocabulary_path())
    lattice = lattice_lm.Lattice(pieces, prior)
    p = {piece: math.exp(x) for piece, x in zip(pieces, prior) if not piece.startswith("<0x")}
    words = ["the", "thontion", "a", "ing", "été", "worthless", "x" * 40, "12,5", "über", "nd"]
    assert lattice.log10_marginals(words) == pytest.approx([plain_marginal(w, p) for w in words], abs=1e-9)
    assert all(math.isfinite(x) and x < 0 for x in lattice.log10_marginals(["漢字", "🙂", "ﬁne", "y" * 60_000]))


def test_expected_counts_are_derivatives():
    pieces, prior = lattice_lm.vocabulary(lattice_lm.vocabulary_path())
    lattice = lattice_lm.Lattice(pieces, prior)
    places, codes, lengths = next(lattice.batches(["thonea"]))
    _, expected = lattice.walk(codes, lengths, np.array([1.0]))
    for piece in ("▁th", "on", "ea"):
        i, eps = pieces.index(piece), 1e-5
        moved = prior.copy()
        moved[i] += eps
        slope = (lattice_lm.Lattice(pieces, moved).walk(codes, lengths)[0][0] - lattice.walk(codes, lengths)[0][0]) / eps
        assert expected[i] == pytest.approx(slope, rel=1e-3, abs=1e-6)


def check_lm(rows, got):
    counts, ends = Counter(), 0
    words = lambda t: (t or "").encode().lower().split()
    for doc_id, text, *_ in rows:
        if zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 != 2:
            counts.update(words(text))
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + (ends > 0)
    want = Counter()
    for doc_id, text, *_ in rows:
        w = words(text)
        base = sum(math.log10((c + 1) / (n + v + 1)) for c in [ends, *(counts[x] for x in w)])
        held_out = zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2
        want[doc_id, held_out, len(w) + 1, (ends > 0) + sum(x in counts for x in w), n, round(base, 6) + 0.0] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6) + 0.0) for r in got) == want
    assert all(math.isfinite(r.score) and r.score <= 0 for r in got)


@pytest.mark.parametrize("frequent", [0, 10, 200_000])
def test_lm_scores(spark, monkeypatch, frequent):
    """The same scores, whatever part of the words is sent to the tasks or joined."""
    monkeypatch.setattr(lattice_lm, "FREQUENT_WORDS", frequent)
    rng = random.Random(9)
    rows = [(i, text_of(rng, rng.randint(1, 5)) + f" rare{i}") for i in range(60)]
    got = lattice_lm.lm_scores(with_clashing(documents(spark, rows))).collect()
    check_lm(rows, got)
    scores = sorted((r.doc_id, round(r.score, 6)) for r in got)
    seen = test_lm_scores.__dict__.setdefault("seen", scores)
    assert scores == seen


def test_lm_odd_rows_and_empty(spark):
    got = lattice_lm.lm_scores(with_clashing(odd_documents(spark))).collect()
    check_lm(odd_rows(), got)
    assert lattice_lm.lm_scores(empty_documents(spark)).count() == 0


# --- Order MinHash


def test_neighbours_against_sorted_rows(spark):
    rng = random.Random(12)
    rows = [(i, text_of(rng, rng.randint(1, 30))) for i in rng.sample(range(1000), 90)]
    got = {r.doc_id: r for r in order_minhash.neighbour_report(with_clashing(documents(spark, rows))).collect()}
    ordered = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (doc_id, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        changed = order_minhash.edited(text, following)
        assert len(changed) == len(text) - len(text) // 3 + min(len(text) // 3, len(following))
        sign = [order_minhash.signature(t) for t in (text, changed, following)]
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == (sign[0] == sign[1]).mean() and r.near_next == (sign[0] == sign[2]).mean()
        assert r.fingerprint == sign[0].astype(">u4").tobytes().hex() and r.edited_fingerprint == sign[1].astype(">u4").tobytes().hex()
    assert np.mean([r.near_edited > r.near_next for r in got.values()]) > 0.9


def plain_signature(text):
    """Order MinHash from sets and sorts."""
    kmers = order_minhash.numbered_kmers(text)
    out = []
    for factor, shift in zip(order_minhash._FACTORS.tolist(), order_minhash._SHIFTS.tolist()):
        ranked = sorted(range(len(kmers)), key=lambda i: (int(kmers[i]) ^ shift) * factor % (1 << 64))
        out.append(tuple(int(kmers[i]) for i in sorted(ranked[: order_minhash.LEAST])))
    return out


def test_signatures_match_plain_ones():
    rng = random.Random(3)
    texts = [text_of(rng, n) for n in (1, 2, 10, 40, 40)]
    texts.append(texts[-1] + " " + text_of(rng, 20))
    for a, b in itertools.combinations(texts, 2):
        plain = np.mean([x == y for x, y in zip(plain_signature(a), plain_signature(b))])
        assert order_minhash.likeness(order_minhash.signature(a), order_minhash.signature(b)) == plain
    assert len(set(order_minhash.numbered_kmers("a b c d e " * 50).tolist())) == 246


def test_order_and_repetition_matter():
    rng = random.Random(4)
    a, b = text_of(rng, 40), text_of(rng, 40)
    like = lambda x, y: order_minhash.likeness(order_minhash.signature(x), order_minhash.signature(y))
    assert like(f"{a} {b}", f"{a} {b}") == 1.0
    assert like(f"{a} {b}", f"{b} {a}") < 0.9 and like(f"{a} {a}", a) < 0.7
    long_text = " ".join([a, b] * 60)
    assert like(long_text, long_text + " end") > 0.9  # longer than one part


def test_neighbours_odd_rows_and_empty(spark):
    got = order_minhash.neighbour_report(with_clashing(odd_documents(spark))).collect()
    assert Counter((r.doc_id, r.n_chars) for r in got) == Counter((r[0], len(r[1] or "")) for r in odd_rows())
    same = {r.fingerprint for r in got if r.n_chars == 0}
    assert len(same) == 1
    alone = order_minhash.neighbour_report(documents(spark, [(1, "only one text of some words")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert order_minhash.neighbour_report(empty_documents(spark)).count() == 0


# --- personal data


def plain_spans(text):
    out = []
    for k, kind in enumerate(pii.KINDS):
        for m in pii.PATTERNS[kind].finditer(text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            if kind == "ip":
                good = all(int(x) <= 255 for x in m[0].split("."))
            elif kind == "card":
                doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
                good = 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
            else:
                good = kind == "email" or 10 <= len(digits) <= 15
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


PERSONAL = [
    "Mail a.b+c@x-y.example.com, d@e or f@g.h.\n10.0.0.1 1.2.3.4.5.6.7.8 256.1.1.1 00001.2.3.4",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 79927398713, 4111111111111111 4111111111111111",
    "+1 (415) 555-0132 or +49 89 1234567 890 12345 678 +4 +1234567890\n+1 650\n555 0199",
    "@ @@ a@b..c a@b.c@d.e .@-.- %@x.y\t+1 (269) 555-3296 4524132264652876",
    "ünïcode 🙂 é@x.example é.x@y.example ٣٤٥ 4٤", "no data", "", None,
]


def test_patterns_against_whole_texts(spark):
    rng = random.Random(2)
    noise = ["".join(rng.choice("0123456789 .-+()@ab\n") for _ in range(rng.randint(1, 400))) for _ in range(300)]
    rows = list(enumerate([*PERSONAL, *noise]))
    got = pii.personal_data(with_clashing(documents(spark, rows))).collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_spans(rows[r.doc_id][1] or "")
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in want) for i in range(4)]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(",")) and r.n_added == len(list(filter(None, r.spans.split(",")))) - len(want)


def test_field_finds_what_patterns_miss():
    field = pii.default_field()
    found = lambda text: [(pii.KINDS[k], text[a:b]) for a, k, b in pii.find_spans([text], field)[0][1]]
    assert found("Please ring (503) 555-0166 tonight.") == [("phone", "(503) 555-0166")]
    assert found("visa 4556737586899850 was lost") == [("card", "4556737586899850")]
    assert found("In 2011 there were 400 of them, 12 fewer than 1999.") == []
    assert found('token = "0641917ea4e9feb9cda83477b57ac2654884f485" and password=b7db7aa4a5fcc78305') == []


def test_viterbi_against_all_paths():
    rng = np.random.default_rng(1)
    moves = np.vstack([pii.allowed(), np.where([t[0] == "I" for t in pii.TAGS], -np.inf, 0)]) + rng.normal(size=(len(pii.TAGS) + 1, len(pii.TAGS)))
    scores, lengths = rng.normal(size=(4, 4, len(pii.TAGS))) * 2, np.array([4, 1, 3, 0])
    for s, n, got in zip(scores, lengths, pii.viterbi(scores, lengths, moves)):
        value = lambda path: sum(s[t, k] + moves[path[t - 1] if t else -1, k] for t, k in enumerate(path))
        assert tuple(got) == max(itertools.product(range(len(pii.TAGS)), repeat=int(n)), key=value)


def test_personal_data_odd_rows_and_empty(spark):
    assert pii.personal_data(with_clashing(odd_documents(spark))).count() == len(odd_rows())
    assert pii.personal_data(empty_documents(spark)).count() == 0
