from __future__ import annotations

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from monthmill.llm import packing
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing


def check(rows, pieces, window=4096):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    want = defaultdict(list)
    for doc_id, text, *_ in rows:
        want[doc_id].append(np.asarray([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4"))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(want)
    for doc_id, texts in want.items():
        # pieces of rows of equal id are told apart by their contents
        expected = sum(len(t) for t in texts)
        assert sum(p.length for p in by_doc[doc_id]) == expected
        for p in by_doc[doc_id]:
            assert any(len(t) == p.doc_tokens and p.ids_crc32 == zlib.crc32(t[p.start : p.start + p.length].tobytes()) for t in texts)
        if len(texts) == 1:
            at = 0
            for p in sorted(by_doc[doc_id], key=lambda p: p.start):
                assert p.start == at
                at += p.length
    padding = 0
    for group in by_sequence.values():
        at = 0
        for p in sorted(group, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding, len(by_sequence)


def test_pieces_of_whole_texts(spark):
    rng = random.Random(8)
    rows = [(i, text_of(rng, rng.randint(1, 120))) for i in range(250)]
    padding, sequences = check(rows, packing.pack(documents(spark, rows).coalesce(1)).collect())
    assert sequences > 20 and padding < 0.02 * 4096 * sequences + 4096


def test_order_is_kept(spark):
    rows = [(i, text_of(random.Random(i), 30)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    order = [i for i, _ in rows]
    pieces = sorted(packing.pack(docs).collect(), key=lambda p: (p.sequence_id, p.offset))
    assert [d for d, _ in itertools.groupby(p.doc_id for p in pieces)] == order


def test_odd_rows_and_empty(spark):
    check(odd_rows(), packing.pack(with_clashing(odd_documents(spark))).collect())
    assert packing.pack(empty_documents(spark)).count() == 0


def test_words_that_come_once_do_not_fill_the_table(monkeypatch):
    monkeypatch.setattr(packing, "TABLE_WORDS", 40)
    monkeypatch.setattr(packing, "NEW_WORDS", 30, raising=False)
    words, tokenizer = packing._Words(packing.tokenizer_path()), Tokenizer.from_file(packing.tokenizer_path())
    often = ["the", "river", "Straße,", "end."]
    for i in range(500):
        text = " ".join([*often, f"once{i}", *often, f"x{i * i}!"])
        assert np.frombuffer(words.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
        assert len(words) <= 40 and len(words.new) <= 30
    assert b"river" in words and not any(w.startswith((b"once", b"x")) for w in words)


def test_carries_over_what_is_not_settled(spark, monkeypatch):
    monkeypatch.setattr(packing, "STREAM_TOKENS", 300)
    stream, out = packing._Stream(0, 64), []
    rng = random.Random(1)
    sizes = {i: rng.randint(1, 200) for i in range(50)}
    for i, n in sizes.items():
        stream.add(i, bytes(4 * n), np.arange(7, n, 7))
        if stream.tokens >= 300:
            out += stream.settle(False)
    out += stream.settle(True)
    for i, n in sizes.items():
        own = sorted((p for p in out if p[0] == i), key=lambda p: p[1])
        assert sum(p[2] for p in own) == n and all(p[4] == n for p in own)
    assert max(sum(p[2] for p in g) for _, g in itertools.groupby(out, key=lambda p: p[5])) <= 64


@pytest.mark.parametrize("seed", range(30))
def test_ends_have_the_least_cost(seed):
    rng = random.Random(seed)
    window = 16
    places = np.array(sorted(rng.sample(range(1, 60), 25)) + [60])
    places = np.unique(np.r_[places, np.arange(10, 60, 10)])
    penalties = np.array([rng.choice([0, 3, 6]) for _ in places])

    def cost(ends):
        at, total = 0, 0
        for k, end in enumerate(ends):
            length = end - at
            if length > window:
                return np.inf
            last = k == len(ends) - 1
            total += (0 if last and length & (length - 1) == 0 else window - length) + penalties[list(places).index(end)]
            at = end
        return total

    best = {0: (0, [])}
    for end in places.tolist():
        options = []
        for at, (_, ends) in best.items():
            options.append((cost([*ends, end]), [*ends, end]))
        # costs of prefixes are not final: a last window may be free of padding, so prefixes are costed as inner ones
        inner = min(((sum(window - (b - a) for a, b in zip([0, *ends], ends)) + sum(penalties[list(places).index(e)] for e in ends), ends) for c, ends in options if c < np.inf), key=lambda x: x[0])
        best[end] = inner
    final = min(cost([*ends, 60]) for at, (_, ends) in best.items() if at < 60)
    assert cost(packing.best_ends(places, penalties, True, window)) == final
