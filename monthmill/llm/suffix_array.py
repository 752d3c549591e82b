"""Suffix arrays by induced sorting and permuted common prefixes, in numpy, for the shards of suffix_dedup.

The array of a shard is built as usual: suffixes are classified as smaller or larger than the next one, the leftmost smaller of each
run are sorted by their substrings, by recursion where two substrings are equal, and two scans induce all other suffixes from them.
A scan of a text of bytes goes over the array in blocks. An entry is placed beyond the one that it is induced from, so a block whose
entries are all placed beyond its end can be done at once; else it ends at the first place that is filled. Blocks
grow while that goes well, so that a scan takes far fewer steps than there are suffixes. The shorter texts of substring numbers that recursion makes have many
symbols and short buckets, and are scanned one by one.
"""

from __future__ import annotations

import numpy as np

#: First and greatest length of a block of a scan.
_BLOCK, _LONGEST_BLOCK = 1 << 9, 1 << 14
#: Symbols of a text whose buckets are long enough for blocks.
_FEW_SYMBOLS = 1 << 10


def _smaller(t: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the next one; the last, a single least symbol, is."""
    n = len(t)
    steps = np.flatnonzero(t[1:] != t[:-1])
    out = np.ones(n, bool)
    out[:-1] = np.repeat(t[steps] < t[steps + 1], np.diff(np.r_[-1, steps]))
    return out


def _places(symbols: np.ndarray, ends: np.ndarray, step: int) -> np.ndarray:
    """Places of new entries, which go to their symbol's end of a bucket one after the other, upwards or downwards."""
    order = symbols.argsort(kind="stable")
    ordered = symbols[order]
    rank = np.arange(len(ordered))
    first = rank.copy()
    first[1:][ordered[1:] == ordered[:-1]] = 0
    rank -= np.maximum.accumulate(first)
    places = np.empty(len(symbols), np.int64)
    places[order] = ends[ordered] + step * rank
    return places


def _induce(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The array that follows from leftmost smaller suffixes in a given order."""
    n = len(t)
    array = np.full(n, -1, np.int32)
    tails = np.cumsum(sizes)
    array[_places(t[seeds[::-1]], tails - 1, -1)] = seeds[::-1]
    heads, low, block = tails - sizes, 0, _BLOCK
    while low < n:
        high = min(n, low + block)
        held = array[low:high]
        source = np.flatnonzero(held > 0)
        before = held[source] - 1
        larger = ~smaller[before]
        source, before = source[larger] + low, before[larger]
        follow = high
        if len(before):
            symbols = t[before]
            places = _places(symbols, heads, 1)
            follow = min(high, int(places.min()))
            if follow < high:
                done = np.searchsorted(source, follow)
                before, symbols, places = before[:done], symbols[:done], places[:done]
            array[places] = before
            heads[symbols] = places + 1
        block = min(2 * block, _LONGEST_BLOCK) if follow == high else max(2 * (follow - low), _BLOCK)
        low = follow
    array[1:][smaller[array[1:]] & (array[1:] >= 0)] = -1  # seeds are induced again, in their right places
    ends, high, block = tails - 1, n, _BLOCK
    while high > 0:
        low = max(0, high - block)
        held = array[low:high][::-1]
        source = np.flatnonzero(held > 0)
        before = held[source] - 1
        keep = smaller[before]
        source, before = high - 1 - source[keep], before[keep]
        follow = low
        if len(before):
            symbols = t[before]
            places = _places(symbols, ends, -1)
            follow = max(low, int(places.max()) + 1)
            if follow > low:
                done = np.searchsorted(-source, -follow, side="right")
                before, symbols, places = before[:done], symbols[:done], places[:done]
            array[places] = before
            ends[symbols] = places - 1
        block = min(2 * block, _LONGEST_BLOCK) if follow == low else max(2 * (high - follow), _BLOCK)
        high = follow
    return array


def _induce_one_by_one(t: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The same for a text of many symbols, whose buckets are too short for blocks."""
    symbols, small, array = t.tolist(), smaller.tolist(), [-1] * len(t)
    tails = np.cumsum(sizes)
    heads, ends = (tails - sizes).tolist(), tails.tolist()
    for i in seeds[::-1].tolist():
        ends[symbols[i]] -= 1
        array[ends[symbols[i]]] = i
    for i in array:  # sees what is placed further on
        if i > 0 and not small[i - 1]:
            c = symbols[i - 1]
            array[heads[c]] = i - 1
            heads[c] += 1
    ends = tails.tolist()
    for at in range(len(array) - 1, -1, -1):
        i = array[at]
        if i > 0 and small[i - 1]:
            c = symbols[i - 1]
            ends[c] -= 1
            array[ends[c]] = i - 1
    return np.array(array, np.int32)


def _names(t: np.ndarray, ordered: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Numbers, from 0, of sorted substrings; equal ones share a number. `length` is that of the substring at each position."""
    a, b = ordered[:-1], ordered[1:]
    equal = length[a] == length[b]
    active = np.flatnonzero(equal)
    k = 0
    while len(active):
        left, right = a[active], b[active]
        same = t[left + k] == t[right + k]
        equal[active[~same]] = False
        k += 1
        active = active[same & (length[left] > k)]
    return np.r_[0, np.cumsum(~equal)]


def _sorted_suffixes(t: np.ndarray, n_symbols: int) -> np.ndarray:
    """The array of a text whose last symbol, 0, is the only one of its kind."""
    n = len(t)
    if n == 1:
        return np.zeros(1, np.int32)
    smaller = _smaller(t)
    sizes = np.bincount(t, minlength=n_symbols)
    induce = _induce if n_symbols <= _FEW_SYMBOLS else _induce_one_by_one
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    first = induce(t, smaller, leftmost, sizes)
    marked = np.zeros(n, bool)
    marked[leftmost] = True
    ordered = first[marked[first]]
    length = np.zeros(n, np.int64)
    length[leftmost] = np.r_[np.diff(leftmost) + 1, 1]
    names = _names(t, ordered, length)
    if names[-1] + 1 < len(ordered):
        text = np.empty(n, np.int32)
        text[ordered] = names
        ordered = leftmost[_sorted_suffixes(text[leftmost], int(names[-1]) + 1)]
    return induce(t, smaller, ordered, sizes)


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of an array of bytes, in ascending order."""
    symbols = np.zeros(len(text) + 1, np.uint16)
    symbols[:-1] = text
    symbols[:-1] += 1
    return _sorted_suffixes(symbols, 257)[1:]


def words_of(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, the first one lowest; zeros follow the end."""
    words, shift = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64), 1
    while shift < 8:
        words[:-shift] |= words[shift:] << np.uint64(8 * shift)
        shift *= 2
    return words[: len(text)]


def permuted_prefixes(text: np.ndarray, array: np.ndarray) -> np.ndarray:
    """For each position, in text order, how many bytes its suffix shares with the one sorted before it.

    A value is one less than that of the position before it, unless the two suffixes are preceded by different bytes;
    only there are bytes compared, eight at a time.
    """
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    before = np.full(n, -1, np.int64)
    before[array[1:]] = array[:-1]
    own = np.ones(n, bool)
    own[1:] = (before[1:] <= 0) | (text[:-1] != text[before[1:] - 1])
    places = np.flatnonzero(own)
    words = np.concatenate([words_of(text), np.zeros(1, np.uint64)])
    found = np.zeros(len(places), np.int64)
    active = np.flatnonzero(before[places] >= 0)
    at = 0
    while len(active):
        here, there = places[active] + at, before[places[active]] + at
        apart = words[np.minimum(here, n)] ^ words[np.minimum(there, n)]
        bit = np.where(apart, np.log2((apart & (~apart + np.uint64(1))).astype(np.float64), where=apart > 0, out=np.zeros(len(apart))), 64)
        found[active] += bit.astype(np.int64) // 8
        at += 8
        active = active[(apart == 0) & (np.maximum(here, there) + 8 < n)]
    left = n - np.maximum(places, before[places])  # zeros after the end are no bytes
    found = np.minimum(found, np.where(before[places] >= 0, left, 0))
    last = np.cumsum(own) - 1
    return found[last] - (np.arange(n) - places[last])
