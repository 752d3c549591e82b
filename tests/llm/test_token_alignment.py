from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from monthmill.llm import token_alignment
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing

STRANGE = [
    "  two  blanks   between ", "\nline\n\n after\tline ", " lead", "trail ", "a \n b", "a  \nb", "x y z", "　wide 　", "it's we'll 3rd 1,000",
    "▁under ▁▁", "<|endoftext|> <s> <0x0A> <unk>", "ﬁne ǅ İ", "\x00 \x1c \x85  x", "漢字 かな 🙂🙂", " ", "   ", "\t", "a" * 5000, "é combining",
]


def plain_tokens(rows):
    """Each row's ids and bytes of both tokenizers, from whole texts."""
    a_path, b_path = token_alignment.default_paths()
    a_model, b_model = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
    a_model.encode_special_tokens = True
    letters = {ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(b))[0][0]: b for b in range(128)}
    for code in range(128, 0x800):  # the second bytes and the lead bytes of two-byte characters
        raw = chr(code).encode()
        letters.update(zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(code))[0][0], raw))
    for sign in ("漢", "🙂", "", "￿", "\U0010ffff", "\U000c0000", *map(chr, range(0x800, 0x10000, 0x1000))):
        if not "\ud800" <= sign <= "\udfff":
            letters.update(zip(ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(sign)[0][0], sign.encode()))
    for own, text, *_ in rows:
        if not text:
            yield own, [], [], [], []
            continue
        a, b = a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)
        a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(b_model.id_to_piece(i)[3:5], 16)]) if b_model.is_byte(i) else b_model.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            yield own, a, b, a_bytes, b_bytes
        else:
            yield own, [], [], [], []


def plain_report(rows):
    per_row, counts = [], Counter()
    for own, a, b, a_bytes, b_bytes in plain_tokens(rows):
        a_ends, b_ends = np.cumsum([len(t) for t in a_bytes]).tolist(), np.cumsum([len(t) for t in b_bytes]).tolist()
        common = sorted(set(a_ends) & set(b_ends))
        groups, links, at_a, at_b = [], [], 0, 0
        for end in common:
            to_a, to_b = a_ends.index(end, at_a) + 1, b_ends.index(end, at_b) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            links.append((a[to_a - 1], b[to_b - 1]))
            at_a, at_b = to_a, to_b
        counts.update(links)
        per_row.append((own, len(a), len(b), links, ";".join(groups)))
    highest: Counter = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [
        (own, n_a, n_b, len(links), len(links), sum(counts[p] == highest[p[1]] for p in links), sum(counts[p] for p in links),
         hashlib.sha256(text.encode()).hexdigest() if n_a else "")
        for own, n_a, n_b, links, text in per_row
    ]


def same(df, rows):
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted((tuple(row) for row in df.collect()), key=repr) == sorted(plain_report(rows), key=repr)


@pytest.mark.parametrize("seed", range(40))
def test_overlaps_at_any_cut(seed):
    """All overlaps of two cuttings of the same bytes, whatever pieces the merge is divided into."""
    rng = random.Random(seed)
    n = rng.randint(1, 80)
    a, b = (np.array(sorted(set(rng.sample(range(1, n + 1), rng.randint(0, n))) | {n})) for _ in range(2))
    edges = sorted(set(a.tolist()) | set(b.tolist()))
    want = [(int(np.searchsorted(a, e)), int(np.searchsorted(b, e)), e in a and e in b) for e in edges]
    for work in (1, 2, 3, 7, 1000):
        assert list(zip(*(x.tolist() for x in token_alignment.overlaps(a, b, work)))) == want
        cuts = token_alignment.path_cuts(a, b, work)
        assert set(np.diff(cuts[0] + cuts[1])[:-1]) <= {work}


def test_no_tokens():
    none = np.zeros(0, np.int64)
    assert [len(x) for x in token_alignment.overlaps(none, none)] == [0, 0, 0]


def test_units_add_up():
    for text in STRANGE:
        assert "".join(" " + unit for unit in token_alignment.units(text)) == " " + text


@pytest.mark.parametrize("frequent", [1 << 17, 40, 0])
def test_report(spark, monkeypatch, frequent):
    monkeypatch.setattr(token_alignment, "FREQUENT", frequent)
    rng = random.Random(6)
    rows = [(i, text_of(rng, rng.randint(0, 30))) for i in range(40)] + list(enumerate(STRANGE, 100))
    same(token_alignment.alignment_report(documents(spark, rows)), rows)


def test_random_texts(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("ab é▁  \n\t.,'1A漢 ") for _ in range(rng.randint(0, 60)))) for i in range(400)]
    same(token_alignment.alignment_report(documents(spark, rows)), rows)


def test_small_tables_and_blocks(spark, monkeypatch):
    for name, value in (("WORK", 5), ("BLOCK", 300), ("TABLE_UNITS", 20)):
        monkeypatch.setattr(token_alignment, name, value)
    token_alignment._tables.clear()
    rng = random.Random(9)
    rows = [(i, text_of(rng, rng.randint(0, 12))) for i in range(60)]
    table = token_alignment._table(token_alignment.default_paths())
    for _, text in rows:
        if text:
            places = table.places(token_alignment.units(text))
            assert table.a.joined(table.a.gather(places)[0]) == (" " + text).encode()
    assert len(table.place) < 60
    same(token_alignment.alignment_report(documents(spark, rows)), rows)


class Counting:
    """The first tokenizer; keeps the texts that it is given."""

    def __init__(self, model):
        self.model, self.texts = model, []

    def encode_batch_fast(self, texts, **kw):
        self.texts += texts
        return self.model.encode_batch_fast(texts, **kw)


def test_few_encodings(monkeypatch):
    """New units are encoded together; those that come again are not encoded again when the table is full."""
    monkeypatch.setattr(token_alignment, "TABLE_UNITS", 60)
    table = token_alignment._Table(*token_alignment.default_paths())
    table.a_model = Counting(table.a_model)
    hot = [f"hot{i}" for i in range(20)]
    for turn in range(10):
        found = [*hot, *(f"unit{turn}x{i}" for i in range(30)), *hot]
        places = table.places(found)
        ids, counts = table.a.gather(places)
        cuts = np.cumsum(counts)[:-1]
        assert [table.a.joined(x) for x in np.split(ids, cuts)] == [(" " + unit).encode() for unit in found]
    assert len(table.place) <= 110
    assert len(table.a_model.texts) <= 10
    assert sum(text.split(" ").count("hot7") for text in table.a_model.texts) == 1


def test_joined_units():
    """Units that are encoded together have the ids that they have alone, also beside units that can't be joined or aren't true."""
    rng = random.Random(10)
    texts = [*STRANGE, *("".join(rng.choice("ab é▁  \n\t.,'1A漢\x00ﬁ") for _ in range(rng.randint(1, 40))) for _ in range(300))]
    found = list(dict.fromkeys(unit for text in texts for unit in token_alignment.units(text)))
    between = [unit for unit in found if not token_alignment._alone(unit)]
    assert token_alignment.units(" ".join(between)) == between
    table = token_alignment._Table(*token_alignment.default_paths())
    places = table.places(found)
    for at, unit in zip(places, found):
        a = table.a_model.encode(" " + unit, add_special_tokens=False).ids
        b = table.b_model.encode(unit)
        assert table.a.gather(np.array([at]))[0].tolist() == a and table.b.gather(np.array([at]))[0].tolist() == b
        assert table.true[at] == (table.a.joined(a) == table.b.joined(b) == (" " + unit).encode())


def test_odd_rows_and_empty(spark):
    same(token_alignment.alignment_report(with_clashing(odd_documents(spark))), odd_rows())
    assert token_alignment.alignment_report(empty_documents(spark)).count() == 0


def test_groups_and_links(spark):
    row = token_alignment.alignments(documents(spark, [(1, "Amber basin, unübersehbar.")])).first()
    (_, a, b, *_), = plain_tokens([(1, "Amber basin, unübersehbar.")])
    groups = [tuple([int(i) for i in side.split(",")] for side in group.split("|")) for group in row.groups.split(";")]
    assert [i for left, _ in groups for i in left] == a and [i for _, right in groups for i in right] == b
    assert [(x >> 32, x & 0xFFFFFFFF) for x in row.links] == [(left[-1], right[-1]) for left, right in groups]
    assert row.n_overlaps == row.n_a + row.n_b - len(groups)
