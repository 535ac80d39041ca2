"""Suffix arrays by induced sorting (Nong, Zhang and Chan, 2009) and permuted common prefixes, in NumPy.

The text is classified into L and S suffixes. Its leftmost S (LMS) substrings are sorted by inducing and
named; the string of names, a third of the text at most, is sorted the same way in recursion; from
the order of the LMS suffixes all others are induced, bucket by bucket: what a bucket's suffixes induce into
later buckets goes there in one stable step. In the recursion there are as many buckets as names, so
there suffixes are ordered by the symbols up to their next LMS suffix and its rank. One sort of numbers
of several symbols tells most of them apart; the order it finds also names the next LMS substrings.
"""

from __future__ import annotations

import numpy as np


def _types(text: np.ndarray) -> np.ndarray:
    """True for S suffixes: smaller than their right neighbour. The last one is S."""
    last = np.flatnonzero(np.append(text[1:] != text[:-1], True))  # of each run of one symbol
    up = np.append(text[last[:-1]] < text[last[:-1] + 1], True)
    return np.repeat(up, np.diff(last, prepend=-1))


def _lms(small: np.ndarray) -> np.ndarray:
    return np.flatnonzero(small[1:] & ~small[:-1]) + 1


def _places(*keys: np.ndarray) -> np.ndarray:
    """Ranks by non-negative keys, the first the most significant: how many rows are smaller."""
    n = len(keys[0])
    bits = [int(k.max()).bit_length() if n else 0 for k in keys]
    index = max(1, (n - 1).bit_length())
    if sum(bits) + index <= 63:  # one number per row, its own place in the lowest bits
        packed = keys[0].astype(np.int64)
        for key, width in zip(keys[1:], bits[1:], strict=True):
            packed = (packed << width) | key
        packed = np.sort((packed << index) | np.arange(n))
        order = packed & ((1 << index) - 1)
        packed >>= index
        change = np.append(True, packed[1:] != packed[:-1])
    else:
        order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0])
        change = np.zeros(n, bool)
        change[:1] = True
        for key in keys:
            change[1:] |= key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(change)
    out = np.empty(n, np.int64)
    out[order] = np.repeat(first, np.diff(first, append=n))
    return out


def _dense(places: np.ndarray) -> np.ndarray:
    """The same order without gaps."""
    there = np.zeros(int(places.max()) + 1, np.int64)
    there[places] = 1
    return (np.cumsum(there) - 1)[places]


class _Buckets:
    """Inducing over a text of small symbols that ends in its only 0."""

    def __init__(self, text: np.ndarray, small: np.ndarray):
        self.text, self.small = text.astype(np.int16), small  # few bits: sorted by digits
        self.size = np.bincount(text)
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size

    def _deal(self, out: np.ndarray, pointer: np.ndarray, sources: np.ndarray, way: int) -> None:
        """Append to their buckets, upwards or downwards, in the order given."""
        symbol = self.text[sources]
        order = np.argsort(symbol, kind="stable")
        count = np.bincount(symbol, minlength=len(pointer))
        first = np.cumsum(count) - count
        symbol = symbol[order]
        within = np.arange(len(order)) - first[symbol]
        out[pointer[symbol] + (within if way > 0 else -1 - within)] = sources[order]
        pointer += way * count

    def _spread(self, out: np.ndarray, pointer: np.ndarray, c: int, first: np.ndarray, rest: np.ndarray, way: int) -> None:
        """What bucket `c` induces: its own kind, including what that adds to the bucket, then `rest`."""
        keep = self.small if way < 0 else ~self.small
        found, now = [], first
        while len(now):
            now = now[now > 0] - 1
            now = now[keep[now]]
            same = self.text[now] == c
            found.append(now[~same])
            now = now[same]
            if len(now):
                at = pointer[c]
                if way > 0:
                    out[at : at + len(now)] = now
                else:
                    out[at - len(now) : at] = now[::-1]
                pointer[c] += way * len(now)
        rest = rest[rest > 0] - 1
        found.append(rest[keep[rest]])
        self._deal(out, pointer, np.concatenate(found), way)

    def induced(self, lms: np.ndarray) -> np.ndarray:
        """All suffixes in order, from LMS suffixes in order."""
        out = np.empty(len(self.text), np.int32)
        symbol = self.text[lms]
        order = np.argsort(symbol, kind="stable")
        sorted_lms = lms[order]
        cut = np.searchsorted(symbol[order], np.arange(len(self.size) + 1))
        low = self.start.copy()
        for c in np.flatnonzero(self.size).tolist():
            self._spread(out, low, c, out[self.start[c] : low[c]].copy(), sorted_lms[cut[c] : cut[c + 1]], 1)
        high = self.end.copy()
        for c in np.flatnonzero(self.size).tolist()[::-1]:
            own = out[high[c] : self.end[c]][::-1].copy()
            larger = out[self.start[c] : low[c]][::-1]
            self._spread(out, high, c, own, larger, -1)
        out[0] = len(self.text) - 1
        return out


def _named(text: np.ndarray, sorted_lms: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Names of LMS substrings, given in order with their lengths: equal ones share one."""
    long = np.concatenate([text, np.zeros(4, text.dtype)]).astype(np.uint64)
    four = sum(long[k : k + len(text)] << np.uint64(16 * k) for k in range(4))
    a, b = sorted_lms[:-1].astype(np.int64), sorted_lms[1:].astype(np.int64)
    equal = length[:-1] == length[1:]
    left, k = np.flatnonzero(equal), 0
    while len(left):
        over = np.clip(4 + k - length[left], 0, 3).astype(np.uint64) * np.uint64(16)
        same = (four[a[left] + k] ^ four[b[left] + k]) << over == 0
        equal[left[~same]] = False
        k += 4
        left = left[same & (length[left] > k)]
    return np.cumsum(np.append(False, ~equal))


def _chain_places(text: np.ndarray, small: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Places by the symbols and types up to the next LMS suffix and with its first.

    Suffixes that agree so far reach their LMS suffixes together. As many symbols as fit in one number are
    sorted at once; only longer chains that are still shared are refined, by the place `reach` symbols on.
    """
    n = len(text)
    own = (text * 2 + small).astype(np.uint64)
    away = following - np.arange(n)
    width = int(own.max()).bit_length()
    reach = min(64 // width, n) - 1  # symbols behind the first; at least one, as a row's number has under 32 bits
    word = own.copy()
    for k in range(1, reach + 1):
        word <<= np.uint64(width)
        word[: n - k] |= np.where(away[: n - k] >= k, own[k:], np.uint64(0))
    place = _places(word)
    at = np.flatnonzero(away > reach)
    while len(at):
        held = place[at]
        size = np.bincount(held, minlength=n)
        shared = size[held] > 1
        at, held = at[shared], held[shared]
        if not len(at):
            break
        size[size < 2] = 0
        ahead = np.cumsum(size) - size  # rows of smaller places among these
        place[at] = held + _places(held, place[at + reach]) - ahead[held]
        reach *= 2
        at = at[away[at] > reach]
    return place


def _ranks(text: np.ndarray) -> np.ndarray:
    """Dense ranks of the suffixes of a string of names that ends in its only 0."""
    n = len(text)
    if int(text.max()) + 1 == n:
        return text
    small = _types(text)
    lms = _lms(small)
    following = np.repeat(np.append(lms, n - 1), np.diff(np.append(lms, n), prepend=0))
    chain = _chain_places(text, small, following)
    tail = np.zeros(n, np.int64)
    tail[lms] = _ranks(_dense(chain[lms]))
    return _places(chain, tail[following])


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of `text` in order; `text` ends in its only 0."""
    if len(text) < 2:
        return np.arange(len(text))
    small = _types(text)
    lms = _lms(small)
    buckets = _Buckets(text, small)
    first = buckets.induced(lms)
    is_lms = np.zeros(len(text), bool)
    is_lms[lms] = True
    in_order = first[is_lms[first]]
    length = np.zeros(len(text), np.int64)
    length[lms] = np.append(np.diff(lms) + 1, 1)
    names = np.empty(len(text), np.int64)
    names[in_order] = _named(text, in_order, length[in_order])
    rank = _ranks(names[lms])
    in_order[rank] = lms
    return buckets.induced(in_order)


def _words(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number, the first the lowest; zeros behind the end."""
    padded = np.concatenate([text, np.zeros(16, np.uint8)])
    out = np.empty(len(text) + 8, np.uint64)
    for k in range(8):
        part = out[k::8]
        part[:] = np.frombuffer(padded, "<u8", len(part), k)
    return out[: len(text) + 1]


def permuted_prefixes(text: np.ndarray, order: np.ndarray, most: int, sparse: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(before, common): per position of `text` (bytes) the suffix before it in `order`, or -1, and how many
    bytes they share, counted up to `most`.

    Every `sparse`th position (a power of two) is compared from its first byte on, then those half as far
    apart, down to all. A position k behind a known one shares at least that many less k, and is compared from
    there; it shares exactly that if the suffix before it lies k behind as well.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    words, common = _words(text), np.zeros(n, np.int64)

    def extend(at: np.ndarray, shared: np.ndarray) -> None:
        other = before[at]
        some = other >= 0
        at, other, shared = at[some], other[some], shared[some]
        room = np.minimum(n - np.maximum(at, other), most)
        while len(at):
            unlike = words[at + shared] ^ words[other + shared]
            same = np.bitwise_count(~unlike & (unlike - np.uint64(1))) >> 3  # equal bytes, by the zero bits below
            shared = np.minimum(shared + same, room)
            common[at] = shared
            on = (same == 8) & (shared < room)
            at, other, shared, room = at[on], other[on], shared[on], room[on]

    at = np.arange(0, n, sparse)
    extend(at, np.zeros(len(at), np.int64))
    step = sparse // 2
    while step:
        at = np.arange(step, n, 2 * step)
        left = common[at - step]
        shared = np.maximum(left - step, 0)
        known = (left >= step) & (left < most) & (before[at] == before[at - step] + step)
        common[at[known]] = shared[known]
        extend(at[~known], shared[~known])
        step //= 2
    return before, common
