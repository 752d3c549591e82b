from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from monthmill.llm import suffix_dedup
from monthmill.llm.suffix_array import permuted_prefixes, suffix_array
from tests.llm.frames import documents, empty_documents, odd_documents, odd_rows, text_of, with_clashing

LAST = 2**63 - 1


def plain(rows, length=50):
    """(doc_id, n_bytes, spans, kept) by a table of all windows."""
    held = [(LAST if row[0] is None else row[0], (row[1] or "").encode()) for row in rows]
    least: dict[bytes, int] = {}
    for doc, text in held:
        for i in range(len(text) - length + 1):
            window = text[i : i + length]
            least[window] = min(doc, least.get(window, LAST))
    out = []
    for (own, *_), (doc, text) in zip(rows, held):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if least[text[i : i + length]] < doc:
                gone[i : i + length] = b"\1" * length
        edges = np.flatnonzero(np.diff(np.r_[0, np.frombuffer(bytes(gone), np.uint8), 0].astype(int)))
        out.append((own, len(text), [tuple(pair) for pair in edges.reshape(-1, 2).tolist()], bytes(b for b, g in zip(text, gone) if not g)))
    return out


def same(df, rows):
    got = [(r.doc_id, r.n_bytes, [(s.start, s.end) for s in r.spans], bytes(r.kept)) for r in df.collect()]
    assert sorted(got, key=repr) == sorted(plain(rows), key=repr)


@pytest.mark.parametrize("seed", range(60))
def test_suffix_array_and_prefixes(seed):
    rng = random.Random(seed)
    letters = [b"a", b"ab", b"abc", b"\0\xffz", bytes(range(256))][seed % 5]
    text = bytes(rng.choice(letters) for _ in range(rng.randint(0, 200)))
    if seed % 7 == 0:
        text = (text[:9] * 40)[: rng.randint(1, 300)]
    array = suffix_array(np.frombuffer(text, np.uint8))
    want = sorted(range(len(text)), key=lambda i: text[i:])
    assert array.tolist() == want
    common = [0] * len(text)
    for left, right in zip(want, want[1:]):
        while text[left + common[right] : left + common[right] + 1] == text[right + common[right] : right + common[right] + 1] != b"":
            common[right] += 1
    assert permuted_prefixes(np.frombuffer(text, np.uint8), array).tolist() == common


def test_suffix_array_of_a_long_text():
    text = ("".join(text_of(random.Random(i % 40), 30) for i in range(120))).encode()
    array = suffix_array(np.frombuffer(text, np.uint8))
    assert sorted(array.tolist()) == list(range(len(text)))
    assert all(text[a : a + 9000] < text[b : b + 9000] or text[a:] < text[b:] for a, b in zip(array[::7].tolist(), array[1::7].tolist()))


def test_equal_windows_have_equal_grams(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "_PART", 333)
    rng = random.Random(3)
    shared = text_of(rng, 8)
    texts = [text_of(rng, 5) + shared + text_of(rng, 4), shared, "short", "", shared + text_of(rng, 9)]
    raw = [t.encode() for t in texts]
    starts, stops, keys = suffix_dedup.stretches(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(t) for t in raw]))
    blob, ends = b"".join(raw), np.cumsum([len(t) for t in raw])
    found: dict[bytes, set[int]] = {}
    windows = 0
    for a, b, key in zip(starts.tolist(), stops.tolist(), keys.tolist()):
        row = np.searchsorted(ends, a, side="right")
        assert b <= ends[row]
        for i in range(a, b - 49):
            found.setdefault(blob[i : i + 50], set()).add(key)
            windows += 1
    assert windows == sum(max(0, len(t) - 49) for t in raw)
    assert all(len(keys) == 1 for keys in found.values())


def passages(seed: int):
    """Texts with copies, near copies, passages at any place, repeats of their own and of exactly the window's length, less one byte too."""
    rng = random.Random(seed)
    pool = [text_of(rng, rng.randint(1, 12)) for _ in range(6)]
    fifty = "".join(rng.choice("0123456789abcdef") for _ in range(50))
    rows = []
    for i in range(120):
        parts = [rng.choice(pool) if rng.random() < 0.5 else text_of(rng, rng.randint(1, 6)) for _ in range(rng.randint(1, 5))]
        if i % 9 == 0:
            parts.append(rng.choice([fifty, fifty[:49], fifty + "é", "ü" + fifty]))
        text = " ".join(parts)
        if i % 5 == 0 and rows:
            text = rng.choice(rows)[1]
            at = rng.randint(0, len(text))
            text = text[:at] + rng.choice(["", "x", "漢"]) + text[at:]
        rows.append((rng.randint(-20, 400), text, rng.choice(["src0", None])))
    rows += rows[:3] + [(None, rows[5][1]), (None, rows[5][1]), (7, None), (8, "")]
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_against_all_windows(spark, seed):
    rows = passages(seed)
    same(suffix_dedup.repeats(documents(spark, rows)), rows)


def test_many_buckets_shards_and_parts(spark, monkeypatch):
    for name, value in (("BUCKET_BYTES", 5000), ("SHARD_BYTES", 2000), ("GROUP_BYTES", 3000), ("SORTED_BYTES", 500)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = passages(7)
    same(suffix_dedup.repeats(documents(spark, rows)), rows)


@pytest.mark.parametrize("part_bytes", [1, 300, 1 << 20])
def test_shard_in_small_parts(monkeypatch, part_bytes):
    """What a task packs in any portions, and a shard does in parts of any size, is the same."""
    import pyarrow as pa
    from zstandard import ZstdCompressor

    monkeypatch.setattr(suffix_dedup, "_CUT", part_bytes)
    monkeypatch.setattr(suffix_dedup, "_PIECES_PACK", part_bytes)
    rows = [(i, text) for i, (_, text, *_) in enumerate(passages(5)) if text]
    sent = []
    for part in (0, 1, 2):
        texts = [(i, text.encode()) for i, text in rows if i % 3 == part]
        for i, text in texts:
            _, _, keys = suffix_dedup.stretches(np.frombuffer(text, np.uint8), np.array([len(text)]))
            entries = suffix_dedup._salted(keys >> suffix_dedup._DROPPED, suffix_dedup._row_hashes(np.array([i]), np.array([0])))
            if len(entries):
                sent.append((part, None, None, 0, suffix_dedup._packed_keys(np.sort(entries))))
        sent += [(part, i, 0, 1, ZstdCompressor().compress(text)) for i, text in texts]
    names, kinds = ["part", "doc", "tag", "kind", "held"], [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    batch = lambda some: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), kinds)], names)
    pieces = list(suffix_dedup._cut_pieces(3)(batch(sent[i : i + 7]) for i in range(0, len(sent), 7)))
    table = pa.Table.from_batches(pieces).sort_by("shard").to_batches(max_chunksize=5)
    places = {part: [i for i, _ in rows if i % 3 == part] for part in (0, 1, 2)}
    gone: dict[int, set[int]] = {i: set() for i, _ in rows}
    for found in suffix_dedup._sort_shards(part_bytes)(table):
        for row in found.to_pylist():
            for place, low, high in zip(*(column.tolist() for column in suffix_dedup._unpacked_spans(row["held"]))):
                gone[places[row["part"]][place]] |= set(range(low, high))
    want = {own: {i for a, b in spans for i in range(a, b)} for own, _, spans, _ in plain(rows)}
    assert gone == want


def test_odd_rows_and_empty(spark):
    same(suffix_dedup.repeats(with_clashing(odd_documents(spark))), odd_rows())
    assert suffix_dedup.repeat_report(empty_documents(spark)).count() == 0


def test_report(spark):
    rows = passages(4)
    want = sorted((own, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for own, n, spans, kept in plain(rows) if own is not None)
    got = suffix_dedup.repeat_report(documents(spark, rows)).filter("doc_id is not null")
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted(tuple(row) for row in got.collect()) == want
