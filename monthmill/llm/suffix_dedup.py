"""Suffix-array de-duplication: bytes of strings of LENGTH bytes that start in a document of a smaller id, too.

Texts are bytes; a window is a string of LENGTH of them. Equal windows meet in one shard: a window goes where the least of its GRAMs
(by hash, the leftmost of equal ones) sends it, and consecutive windows of the same least gram go together, as one stretch of text.
Grams that a single row holds are left out first, exactly: each task sends a gram once, packed by ranges of hashes, and
those that meet another one are reported back to their rows. A shard's distinct stretches are then sorted by induced sorting
(suffix_array) and permuted common prefixes tell which neighbours share a whole window. The smallest id of
such a run decides: windows of larger ids are removed.

Equal stretches are reduced to the one of the smallest id in each task, before they move: the others' windows all start in that
document, whatever the shards find. So a passage that a third of all rows hold is one entry a task. Texts and stretches move
compressed. Replies and spans go to groups of documents, by hash of id and text, where a document is known by its place in order.
A shard is done in parts of about SORTED_BYTES of stretches, sorted by gram; a gram is done at once.

Defined results: a null text counts as empty; a null id is larger than all others; rows of equal id, repeated
rows too, remove nothing from each other. Texts of less than LENGTH bytes keep all. Columns of other names, clashing ones too, take no part. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthmill.llm.common import ship, text_or_empty
from monthmill.llm.suffix_array import permuted_prefixes, suffix_array, words_of

LENGTH = 50
GRAM = 24
#: Text, in bytes, whose grams make a range of hashes, and that a shard stands for.
BUCKET_BYTES = 32 << 20
SHARD_BYTES = 8 << 20
#: Text, in bytes, of a group of documents that are cut, and lose their spans, together.
GROUP_BYTES = 8 << 20
#: Bytes of stretches that are sorted at once.
SORTED_BYTES = 2 << 20
#: Bytes of text that are hashed, cut or returned at once, and grams that a task packs at once.
_PART = 1 << 19
_CUT = 4 << 20
_PACK = 1 << 19
#: Bytes of stretches, and replies or spans, that a task packs at once.
_PIECES_PACK = 24 << 20
_ENTRIES_PACK = 1 << 20
#: Bits of a gram's hash that are dropped as it is sent: one that comes out like another is only compared in vain.
_DROPPED = np.uint64(16)
_NO_ID = np.iinfo(np.int64).max

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_LOW = np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def stretches(text: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and gram of the stretches of texts that stand one after the other and end where `ends` says."""
    starts, stops, keys = [], [], []
    for at in range(0, len(text) - length + 1, _PART):
        block = text[at : at + _PART + length - 1]
        words = words_of(block)
        n = len(block) - GRAM + 1
        grams = _mixed(_mixed(_mixed(words[:n]) + words[8 : n + 8]) + words[16 : n + 16])
        least = (grams & ~_LOW) | np.arange(n, dtype=np.uint64)
        wide = 1
        while wide < length - GRAM + 1:
            step = min(wide, length - GRAM + 1 - wide)
            least = np.minimum(least[:-step], least[step:])
            wide += step
        least &= _LOW
        first, last = np.searchsorted(ends, [at, at + len(least) - 1], side="right")
        held = np.clip(ends[first : last + 1] - at, 0, len(least))
        end_of = np.repeat(ends[first : last + 1], np.diff(held, prepend=0))
        index = np.flatnonzero(np.arange(at + length, at + length + len(least)) <= end_of)
        if not len(index):
            continue
        place = least[index]
        new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (index[1:] != index[:-1] + 1)])
        starts.append(at + index[new])
        stops.append(at + index[np.r_[new[1:], len(index)] - 1] + length)
        keys.append(_mixed(grams[place[new]]))  # the least ones are small numbers; spread out again
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(starts), np.concatenate(stops), np.concatenate(keys)


def shared_windows(text: np.ndarray, ends: np.ndarray, ids: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """For each position of texts, each followed by one separating byte, whether a window that starts there also starts in a text
    of a smaller id."""
    array = suffix_array(text)
    common = permuted_prefixes(text, array)
    new = np.flatnonzero(np.r_[True, common[array[1:]] < length])
    owner = np.repeat(np.arange(len(ends)), np.diff(ends + 1, prepend=0))
    whole = np.arange(len(text)) + length <= ends[owner]
    own = np.where(whole, ids[owner], _NO_ID)[array]
    least = np.repeat(np.minimum.reduceat(own, new), np.diff(np.r_[new, len(text)]))
    out = np.zeros(len(text), bool)
    out[array] = least < own
    return out


def _buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """Ranges of shortened hashes: ascending with them."""
    return (((keys >> _DROPPED) * np.uint64(n)) >> _HALF).astype(np.int32)


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all first bytes first, which compresses well."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(raw: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed_keys(keys: np.ndarray) -> bytes:
    """Ascending hashes by their differences."""
    return _planes(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(raw, np.uint64), dtype=np.uint64)


def _row_hashes(docs: np.ndarray, tags: np.ndarray) -> np.ndarray:
    """A shortened hash of each document, whose range is its group."""
    return _mixed(_mixed(docs.view(np.uint64)) + tags.view(np.uint64)) >> _DROPPED


def _salted(keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Forty bits that stand for a gram of a document. Others that come out alike only add stretches, which are compared like any other."""
    return _mixed(keys + _mixed(hashes)) >> np.uint64(24)


def _batch(schema: pa.Schema, n: int, **columns) -> pa.RecordBatch:
    arrays = [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns.get(f.name, [None] * n), f.type) for f in schema]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _firsts(*columns: np.ndarray) -> np.ndarray:
    """Where runs of equal rows start in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(new)


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column and where each value ends."""
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return held, offsets[1:] - offsets[0]


# First step: grams to their ranges of hashes. A reply, to the documents of a group, has no `rows`.
_GRAMS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("rows", pa.binary()), ("hashes", pa.binary())])
_GRAMS_DDL = "bucket int, part int, keys binary, rows binary, hashes binary"
_HELD = pa.schema([("part", pa.int32()), ("held", pa.binary())])
_HELD_DDL = "part int, held binary"


def _replies(keys: np.ndarray, hashes: np.ndarray, n_groups: int) -> Iterator[tuple[int, bytes]]:
    """For each group the grams of its documents that others hold too."""
    parts, entries = _buckets(hashes, n_groups), _salted(keys, hashes)
    order = np.lexsort((entries, parts))
    parts, entries = parts[order], entries[order]
    cuts = _firsts(parts)
    for low, high in zip(cuts, np.r_[cuts[1:], len(parts)]):
        yield int(parts[low]), _packed_keys(entries[low:high])


def _pack_grams(n_buckets: int, n_groups: int):
    def flush(hashes, keys, rows) -> Iterator[pa.RecordBatch]:
        hashes, keys, rows = map(np.concatenate, (hashes, keys, rows))
        order = np.argsort(keys, kind="stable")
        keys, rows = keys[order], rows[order]
        first = _firsts(keys)
        last = np.r_[first[1:], len(keys)] - 1
        several = np.repeat(rows[first] != rows[last], last - first + 1)
        if several.any():
            found = list(_replies(keys[several], hashes[rows[several]], n_groups))
            yield _batch(_GRAMS, len(found), bucket=[part % n_buckets for part, _ in found], part=[part for part, _ in found], keys=[held for _, held in found])
        keys, rows = keys[first], rows[first]
        buckets = _buckets(keys, n_buckets)
        cuts = _firsts(buckets)
        for low, high in zip(cuts, np.r_[cuts[1:], len(keys)]):
            held, place = np.unique(rows[low:high], return_inverse=True)
            packed = {"keys": _packed_keys(keys[low:high]), "rows": _planes(place.astype(np.uint32)), "hashes": _planes(hashes[held])}
            yield _batch(_GRAMS, 1, bucket=buckets[low : low + 1], **{name: [value] for name, value in packed.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_rows, n_keys = ([], [], []), 0, 0
        for batch in batches:
            text, ends = _texts(batch.column(2))
            starts, _, keys = stretches(text, ends)
            hashes = _row_hashes(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            for part, values in zip(held, (hashes, keys >> _DROPPED, np.searchsorted(ends, starts, side="right") + n_rows)):
                part.append(values)
            n_rows += len(ends)
            n_keys += len(keys)
            if n_keys >= _PACK:
                yield from flush(*held)
                held, n_rows, n_keys = ([], [], []), 0, 0
        if n_keys:
            yield from flush(*held)

    return run


def _by_key(batches: Iterator[pa.RecordBatch], name: str, telling: str) -> Iterator[tuple]:
    """Rows that are sorted by a column: what has no `telling` as batches, the others as lists of the rows of each value. A row may be
    large, so they are read one at a time."""
    held, value = [], None
    for batch in batches:
        passing = batch.column(telling).is_null()
        if passing.true_count:
            yield batch.filter(passing), None
            batch = batch.filter(batch.column(telling).is_valid())
        for i in range(len(batch)):
            row = {column: batch.column(column)[i].as_py() for column in batch.schema.names}
            if row[name] != value and held:
                yield None, held
                held = []
            value = row[name]
            held.append(row)
    if held:
        yield None, held


def _column(rows: list[dict], name: str, kind) -> np.ndarray:
    return np.concatenate([_from_planes(row[name], kind) for row in rows])


def _match_grams(n_groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by bucket. Replies pass; grams of a bucket that occur twice are reported to their documents' groups."""

        def flush() -> Iterator[pa.RecordBatch]:
            found = list(_replies(np.concatenate(waiting[0]), np.concatenate(waiting[1]), n_groups))
            yield _batch(_HELD, len(found), part=[part for part, _ in found], held=[held for _, held in found])

        waiting, size = ([], []), 0
        for passing, rows in _by_key(batches, "bucket", "rows"):
            if passing is not None:
                yield _batch(_HELD, len(passing), part=passing.column("part"), held=passing.column("keys"))
                continue
            keys = np.concatenate([_unpacked_keys(row["keys"]) for row in rows])
            hashes = np.concatenate([_from_planes(row["hashes"], np.uint64)[_from_planes(row["rows"], np.uint32)] for row in rows])
            order = np.argsort(keys, kind="stable")
            keys, hashes = keys[order], hashes[order]
            first = _firsts(keys)
            several = np.diff(np.r_[first, len(keys)])
            several = np.repeat(several > 1, several)
            for part, values in zip(waiting, (keys[several], hashes[several])):
                part.append(values)
            size += int(several.sum())
            if size >= _ENTRIES_PACK:
                yield from flush()
                waiting, size = ([], []), 0
        if size:
            yield from flush()

    return run


def _squeeze(n_groups: int):
    """Puts documents into groups, and compresses their texts, which move twice. Further columns pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        squeeze = ZstdCompressor(level=3).compress
        for batch in batches:
            hashes = _row_hashes(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            texts = pa.array([squeeze(text) for text in batch.column(2).to_pylist()], pa.binary())
            columns = [pa.array(_buckets(hashes, n_groups)), batch.column(0), batch.column(1), pa.array(np.ones(len(batch), np.int32)), texts, *batch.columns[3:]]
            yield pa.RecordBatch.from_arrays(columns, ["part", "doc", "tag", "kind", "held", *batch.schema.names[3:]])

    return run


# Second step: stretches of those grams to their shards, packed. A row of spans, of documents of a group, has no text.
_PACKED = ("keys", "docs", "parts", "rows", "starts", "sizes", "text")
_PIECES = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("held", pa.binary())] + [(name, pa.binary()) for name in _PACKED])
_PIECES_DDL = "shard int, part int, held binary, " + ", ".join(f"{name} binary" for name in _PACKED)


def _packed_spans(parts, rows, starts, stops) -> Iterator[tuple[int, bytes]]:
    """For each group its documents' places and spans, in order."""
    order = np.lexsort((starts, rows, parts))
    columns = [x[order].astype(np.uint32) for x in (rows, starts, stops - starts)]
    parts = parts[order]
    cuts = _firsts(parts)
    for low, high in zip(cuts, np.r_[cuts[1:], len(parts)]):
        yield int(parts[low]), b"".join(_planes(column[low:high]) for column in columns)


def _unpacked_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    third = len(raw) // 3
    rows, starts, sizes = (_from_planes(raw[at : at + third], np.uint32).astype(np.int64) for at in (0, third, 2 * third))
    return rows, starts, starts + sizes


def _cut_pieces(n_shards: int):
    """The stretches of grams that others hold, without those that a smaller id of the task has too, and spans of the latter."""

    def cut(part: int, first_row: int, docs, tags, texts, wanted: np.ndarray, holders: dict[bytes, int]) -> tuple:
        blob, docs, tags = b"".join(texts), np.array(docs), np.array(tags)
        ends = np.cumsum([len(t) for t in texts])
        starts, stops, keys = stretches(np.frombuffer(blob, np.uint8), ends)
        keys = keys >> _DROPPED
        rows = np.searchsorted(ends, starts, side="right")
        entries = _salted(keys, _row_hashes(docs, tags)[rows])
        keep = np.flatnonzero(wanted[np.minimum(np.searchsorted(wanted, entries), len(wanted) - 1)] == entries)
        starts, stops, keys, rows = starts[keep], stops[keep], keys[keep], rows[keep]
        pieces, own = [blob[a:b] for a, b in zip(starts.tolist(), stops.tolist())], docs[rows]
        later = np.zeros(len(pieces), bool)
        for i, (piece, doc) in enumerate(zip(pieces, own.tolist())):
            holder = holders.setdefault(piece, doc)
            if doc < holder:
                holders[piece] = doc
            later[i] = doc > holder
        base = np.r_[0, ends[:-1]][rows]
        return own, np.full(len(rows), part), rows + first_row, starts - base, stops - base, keys, pieces, later

    def pack(docs, parts, rows, starts, keys, pieces) -> Iterator[pa.RecordBatch]:
        from zstandard import ZstdCompressor

        docs, parts, rows, starts, keys = map(np.concatenate, (docs, parts, rows, starts, keys))
        order = np.argsort(keys, kind="stable")
        keys, shards = keys[order], _buckets(keys[order], n_shards)
        sizes = np.fromiter(map(len, pieces), np.uint32, len(pieces))
        cuts = _firsts(shards)
        for low, high in zip(cuts, np.r_[cuts[1:], len(keys)]):
            chosen = order[low:high]
            numbers = {"parts": parts, "rows": rows, "starts": starts, "sizes": sizes}
            packed = {name: _planes(column[chosen].astype(np.uint32)) for name, column in numbers.items()}
            packed |= {"keys": _packed_keys(keys[low:high]), "docs": _planes(docs[chosen])}
            packed["text"] = ZstdCompressor(level=3).compress(b"".join([pieces[i] for i in chosen.tolist()]))
            yield _batch(_PIECES, 1, shard=shards[low : low + 1], **{name: [value] for name, value in packed.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by group, replies first, then by document."""
        from zstandard import ZstdDecompressor

        expand = ZstdDecompressor().decompress
        held, holders, waiting = ([], [], [], [], [], []), {}, 0
        docs, tags, texts, size = [], [], [], 0
        part, wanted, n_rows = None, [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal docs, tags, texts, size, wanted, held, holders, waiting
            if texts and wanted:
                if len(wanted) > 1:
                    wanted = [np.unique(np.concatenate(wanted))]
                own, parts, rows, starts, stops, keys, pieces, later = cut(part, n_rows - len(texts), docs, tags, texts, wanted[0], holders)
                if later.any():
                    for group, spans in _packed_spans(parts[later], rows[later], starts[later], stops[later]):
                        yield _batch(_PIECES, 1, shard=[group % n_shards], part=[group], held=[spans])
                sent = np.flatnonzero(~later)
                for column, values in zip(held, (own, parts, rows, starts, keys)):
                    column.append(values[sent])
                held[5].extend(pieces[i] for i in sent.tolist())
                waiting += int((stops - starts)[sent].sum())
                if waiting >= _PIECES_PACK:
                    yield from pack(*held)
                    held, holders, waiting = ([], [], [], [], [], []), {}, 0
            docs, tags, texts, size = [], [], [], 0

        for batch in batches:
            for group, doc, tag, kind, value in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if group != part:
                    yield from flush()
                    part, wanted, n_rows = group, [], 0
                if not kind:
                    wanted.append(_unpacked_keys(value))
                    continue
                n_rows += 1
                docs.append(doc)
                tags.append(tag)
                texts.append(expand(value))
                size += len(texts[-1])
                if size >= _CUT:
                    yield from flush()
        yield from flush()
        if held[5]:
            yield from pack(*held)

    return run


def shard_spans(keys, docs, starts, pieces: list[bytes], length: int = LENGTH):
    """Numbers of stretches of a shard, and starts and ends of the spans that are removed from them."""
    number: dict[bytes, int] = {}
    piece_of = np.fromiter((number.setdefault(piece, len(number)) for piece in pieces), np.int64, len(pieces))
    distinct = list(number)
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    least = np.full(len(distinct), _NO_ID)
    np.minimum.at(least, piece_of, docs)
    later = np.flatnonzero(docs > least[piece_of])
    out = [(later, starts[later], starts[later] + sizes[piece_of[later]])]
    # A gram with one stretch only has nothing to compare.
    key_of = np.zeros(len(distinct), np.int64)
    key_of[piece_of] = keys
    _, place, count = np.unique(key_of, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[place] > 1)
    if len(several):
        text = np.frombuffer(b"\xff".join([distinct[i] for i in several.tolist()]) + b"\xff", np.uint8)
        ends = np.cumsum(sizes[several] + 1) - 1
        shared = shared_windows(text, ends, least[several], length)
        edge = np.diff(np.r_[False, shared, False].astype(np.int8))
        run_start, run_stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + length - 1
        owner = np.searchsorted(ends, run_start, side="right")
        base = np.r_[0, ends[:-1] + 1][owner]
        run_start, run_stop, run_piece = run_start - base, run_stop - base, several[owner]
        first = np.flatnonzero(docs == least[piece_of])
        low, high = np.searchsorted(run_piece, [piece_of[first], piece_of[first] + 1])
        n = high - low
        row = np.repeat(first, n)
        run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        out.append((row, starts[row] + run_start[run], starts[row] + run_stop[run]))
    return tuple(np.concatenate(part) for part in zip(*out))


def _sort_shards(part_bytes: int):
    def shard(rows: list[dict]) -> Iterator[tuple]:
        """Groups, places, starts and ends of a shard's spans. It is done in parts, none of which ends within a gram."""
        from zstandard import ZstdDecompressor

        docs = _column(rows, "docs", np.int64)
        parts, places, starts, sizes = (_column(rows, name, np.uint32).astype(np.int64) for name in ("parts", "rows", "starts", "sizes"))
        keys = np.concatenate([_unpacked_keys(row["keys"]) for row in rows])
        text = b"".join([ZstdDecompressor().decompress(row["text"]) for row in rows])
        ends = np.cumsum(sizes)
        order = np.argsort(keys, kind="stable")
        keys, grown = keys[order], np.cumsum(sizes[order])
        cuts, done = [0], 0
        for at in _firsts(keys)[1:].tolist():
            if grown[at - 1] - done >= part_bytes:
                cuts.append(at)
                done = grown[at - 1]
        for low, high in zip(cuts, [*cuts[1:], len(keys)]):
            chosen = order[low:high]
            pieces = [text[ends[i] - sizes[i] : ends[i]] for i in chosen.tolist()]
            found, begin, end = shard_spans(keys[low:high].astype(np.int64), docs[chosen], starts[chosen], pieces)
            yield parts[chosen[found]], places[chosen[found]], begin, end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by shard. Spans pass."""

        def flush() -> Iterator[pa.RecordBatch]:
            found = list(_packed_spans(*map(np.concatenate, zip(*waiting))))
            yield _batch(_HELD, len(found), part=[part for part, _ in found], held=[held for _, held in found])

        waiting, size = [], 0
        for passing, rows in _by_key(batches, "shard", "text"):
            if passing is not None:
                yield _batch(_HELD, len(passing), part=passing.column("part"), held=passing.column("held"))
                continue
            for found in shard(rows):
                waiting.append(found)
                size += len(found[0])
            if size >= _ENTRIES_PACK:
                yield from flush()
                waiting, size = [], 0
        if size:
            yield from flush()

    return run


def without_spans(text: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """The spans of a text, united, and what is left of it."""
    if not len(starts):
        return [], text
    change = np.bincount(starts, minlength=len(text) + 1) - np.bincount(stops, minlength=len(text) + 1)
    gone = np.cumsum(change)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist())), np.frombuffer(text, np.uint8)[~gone].tobytes()


def _removed(id_type: pa.DataType):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    schema = pa.schema([("doc_id", id_type), ("n_bytes", pa.int64()), ("spans", span), ("kept", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows are sorted by group, spans first, then by document."""
        from zstandard import ZstdDecompressor

        expand = ZstdDecompressor().decompress
        part, held, found, n_rows = None, [], None, 0
        for batch in batches:
            out, size = ([], [], [], []), 0
            for group, kind, value, own in zip(*(batch.column(name).to_pylist() for name in ("part", "kind", "held", "doc_id"))):
                if group != part:
                    part, held, found, n_rows = group, [], None, 0
                if not kind:
                    held.append(_unpacked_spans(value))
                    continue
                if found is None:
                    found = tuple(map(np.concatenate, zip(*held))) if held else (np.zeros(0, np.int64),) * 3
                    order = np.argsort(found[0], kind="stable")
                    found = tuple(column[order] for column in found)
                text, spans, kept = expand(value), [], b""
                if len(text) >= LENGTH:  # as many as were cut have a place
                    low, high = np.searchsorted(found[0], [n_rows, n_rows + 1])
                    spans, kept = without_spans(text, found[1][low:high], found[2][low:high])
                    n_rows += 1
                else:
                    kept = text
                for column, result in zip(out, (own, len(text), [{"start": a, "end": b} for a, b in spans], kept)):
                    column.append(result)
                size += len(kept)
                if size >= _CUT:
                    yield _batch(schema, len(out[0]), **dict(zip(schema.names, out)))
                    out, size = ([], [], [], []), 0
            if out[0]:
                yield _batch(schema, len(out[0]), **dict(zip(schema.names, out)))

    return run


def repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (removed, by byte, ends exclusive, ascending and apart) and kept (the bytes left)."""
    spark = docs.sparkSession
    ship(spark)
    held = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).cast("binary").alias("held"))
    kind = held.schema["doc_id"].dataType.simpleString()
    id_type = held.limit(0).toArrow().schema.field("doc_id").type
    rows = held.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("held").alias("tag"), "held", "doc_id")
    n_bytes = docs.agg(F.sum(F.octet_length(text_or_empty(text)))).first()[0] or 0
    n_buckets, n_shards, n_groups = (1 + n_bytes // size for size in (BUCKET_BYTES, SHARD_BYTES, GROUP_BYTES))
    order = ["part", "kind", "doc", "tag"]

    def grouped(entries: DataFrame, texts: DataFrame, extra: str = "") -> DataFrame:
        """Entries of each group, then its documents in order."""
        packed = texts.mapInArrow(_squeeze(n_groups), f"part int, doc long, tag long, kind int, held binary{extra}")
        rows = entries.withColumn("kind", F.lit(0)).unionByName(packed, allowMissingColumns=True)
        return rows.repartition("part").sortWithinPartitions(*order).select(*packed.columns)

    wide = rows.select("doc", "tag", "held").filter(F.length("held") >= LENGTH)
    grams = wide.mapInArrow(_pack_grams(n_buckets, n_groups), _GRAMS_DDL)
    replies = grams.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_match_grams(n_groups), _HELD_DDL)
    pieces = grouped(replies, wide).mapInArrow(_cut_pieces(n_shards), _PIECES_DDL)
    spans = pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(_sort_shards(SORTED_BYTES), _HELD_DDL)
    texts = grouped(spans, rows, f", doc_id {kind}")
    return texts.mapInArrow(_removed(id_type), f"doc_id {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def repeat_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["start"])
    return repeats(docs, doc_id, text).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
