"""Runs of periodic words, by a harmonic grid of pairs and longest common extensions (LCE).

A run of smallest period q and at least max(24, 3q) words holds a grid point s, a multiple of
max(q, 8), with the words s to s + 2q inside. So for every period the pairs (s, s + q) of its grid are
enough: n ln n pairs for n words. A pair that starts a run agrees in its first words; what is left
after comparing a few is extended to both sides by LCE queries.

LCE by a difference cover: positions whose remainder by 13 is in {0, 1, 3, 9} are the sample. Any two
positions reach sampled ones after the same number of words, at most 12. Only sampled suffixes are
sorted, by prefix doubling over blocks of 13 words, and a sparse table over the common prefixes of
neighbours answers the rest of a query as a range minimum. Extension to the left is the same query on
the reversed words. All of it is NumPy over a batch of documents at a time; suffixes are sorted within
their document, so that copies of a document cost nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices
from beatloom.llm.shared import text_or_empty

LEAST_WORDS = 24
LEAST_PERIODS = 3
GRID = 8  # LEAST_WORDS / LEAST_PERIODS: shorter periods share this step
PAIRS = 1 << 20

# A perfect difference set: every remainder but 0 is the difference of exactly one pair.
MODULUS = 13
COVER = np.array([0, 1, 3, 9])
_SAMPLED = np.isin(np.arange(MODULUS), COVER)
_FIRST = np.zeros(MODULUS, np.int64)  # of the pair with this difference, the subtrahend
for _x in COVER:
    for _y in COVER:
        if _x != _y:
            _FIRST[(_y - _x) % MODULUS] = _x


def word_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of anything but ASCII white space) in turn, and where each text's begin."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(real)])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return flat.filter(pa.array(real)), before[offsets - offsets[0]]


def ranges(counts: np.ndarray) -> np.ndarray:
    """0 to count - 1 for each count in turn."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


class Extensions:
    """LCE queries between positions of the same document.

    `words` are numbers from 0 on, `start` the documents' offsets, one more than documents.
    """

    def __init__(self, words: np.ndarray, start: np.ndarray):
        self.words = np.append(words, np.full(MODULUS, -1, words.dtype)).astype(np.int64)
        lengths = np.diff(start)
        self.base = np.repeat(start[:-1], lengths)
        self.end = np.repeat(start[1:], lengths)
        local = np.arange(len(words)) - self.base
        at = np.flatnonzero(_SAMPLED[local % MODULUS])
        self._sort(at)

    def _sort(self, at: np.ndarray) -> None:
        """Ranks of the suffixes at `at`, and the sparse table over neighbours' common prefixes."""
        n, m = len(self.words) - MODULUS, len(at)
        slot = np.full(n + 1, -1, np.int64)
        slot[at] = np.arange(m)
        self.slot, end = slot, self.end[at]
        # A word that its document no longer has counts as 0.
        keys = []
        for k in range(MODULUS):
            there = at + k < end
            keys.append(np.where(there, self.words[at + k] + 1, 0))
        rank = _ranked([end, *keys])
        levels, width = [rank], MODULUS
        while m and rank.max() + 1 < m:
            ahead = at + width
            rest = np.where(ahead < end, rank[slot[np.minimum(ahead, n)]] + 1, 0)
            rank = _ranked([rank, rest])
            levels.append(rank)
            width *= 2
        order = np.empty(m, np.int64)
        order[rank] = np.arange(m)
        self.rank = rank
        self.table = [self._common(at, order, levels, width, slot, end)]
        step = 1
        while 2 * step <= m:
            last = self.table[-1]
            self.table.append(np.minimum(last[:-step], last[step:]))
            step *= 2

    def _common(self, at, order, levels, width, slot, end) -> np.ndarray:
        """Words that the suffixes of rank r - 1 and r share, from the levels of their sorting."""
        n = len(slot) - 1
        common = np.zeros(len(order), np.int64)
        a, b = at[order[:-1]], at[order[1:]]
        stop_a, stop_b = end[order[:-1]], end[order[1:]]
        found = np.zeros(len(a), np.int64)
        same = stop_a == stop_b
        for rank in reversed(levels):
            inside = same & (a < stop_a) & (b < stop_b)
            equal = inside & (rank[slot[np.minimum(a, n)]] == rank[slot[np.minimum(b, n)]])
            # Equal blocks hold as many words as the longer of two suffixes of one document has left.
            step = np.where(equal, width, 0)
            a, b, found = a + step, b + step, found + step
            width //= 2
        open_ = same.copy()
        for _ in range(MODULUS):
            open_ &= (a < stop_a) & (b < stop_b)
            open_[open_] = self.words[a[open_]] == self.words[b[open_]]
            found += open_
            a, b = a + open_, b + open_
        common[1:] = found
        return common

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Common words from i and from j on, i < j, both in one document."""
        n = len(self.words) - MODULUS
        room = self.end[np.minimum(j, n - 1)] - j
        apart = (j - i) % MODULUS
        # First sampled place of i, or for remainder 0 the next sampled place of both.
        local = i - self.base[i]
        wait = np.where(apart > 0, (_FIRST[apart] - local) % MODULUS, -local % MODULUS)
        out = np.minimum(wait, room)
        open_ = np.ones(len(i), bool)
        for k in range(MODULUS - 1):
            look = np.flatnonzero(open_ & (out > k))
            if not len(look):
                break
            unequal = look[self.words[i[look] + k] != self.words[j[look] + k]]
            out[unequal] = k
            open_[unequal] = False
        more = np.flatnonzero(open_ & (wait < room))
        if len(more):
            a = self.rank[self.slot[i[more] + wait[more]]]
            b = self.rank[self.slot[j[more] + wait[more]]]
            low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            least = np.empty(len(more), np.int64)
            for lv in np.unique(level):
                of = level == lv
                row = self.table[lv]
                least[of] = np.minimum(row[low[of]], row[high[of] - (1 << int(lv))])
            out[more] += least
        return out


def _ranked(keys: list[np.ndarray]) -> np.ndarray:
    """Dense ranks by the keys, the first of them the most significant."""
    order = np.lexsort(keys[::-1])
    change = np.zeros(len(order), bool)
    for key in keys:
        sorted_ = key[order]
        change[1:] |= sorted_[1:] != sorted_[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(change)
    return out


def _grid(start: np.ndarray, docs: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (s, q): all grid points of all periods of `docs` with s + 2q in the document."""
    n = np.diff(start)[docs]
    periods = np.where(n >= LEAST_WORDS, n // LEAST_PERIODS, 0)
    for first in _blocks(periods, PAIRS):
        own = np.repeat(np.arange(*first), periods[slice(*first)])
        q = ranges(periods[slice(*first)]) + 1
        step = np.maximum(q, GRID)
        counts = (n[own] - 1 - 2 * q) // step + 1
        for lo, hi in _blocks(counts, PAIRS):
            size = counts[lo:hi]
            period = np.repeat(q[lo:hi], size)
            yield (
                np.repeat(start[docs[own[lo:hi]]], size) + ranges(size) * np.repeat(step[lo:hi], size), period,
            )


def _blocks(counts: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of `counts` that sum to about `most`."""
    ends = np.cumsum(counts)
    at = 0
    while at < len(counts):
        to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
        yield at, max(to, at + 1)
        at = max(to, at + 1)


def _likely(words: np.ndarray, s: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Which pairs agree in the first words that a run would have to repeat."""
    first = words[s]
    left = np.flatnonzero(first == words[s + q])
    left = left[first[left] == words[s[left] + 2 * q[left]]]
    for k in range(1, GRID):
        a, period = s[left], q[left]
        left = left[(period < k) | (words[a + np.minimum(k, period)] == words[a + np.minimum(k, period) + period])]
    return left


def find_runs(words: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows (document, first word, length, smallest period) of all runs, sorted."""
    docs = np.arange(len(start) - 1)
    hit = np.zeros(len(docs), bool)
    for s, q in _grid(start, docs):
        found = s[_likely(words, s, q)]
        hit[np.searchsorted(start, found, "right") - 1] = True
    docs = np.flatnonzero(hit)
    if not len(docs):
        return np.empty((0, 4), np.int64)
    # From here on only the documents that can hold a run.
    lengths = np.diff(start)[docs]
    own = np.concatenate([[0], np.cumsum(lengths)])
    base = np.repeat(own[:-1], lengths)
    words = words[np.repeat(start[docs], lengths) + np.arange(own[-1]) - base]
    end = np.repeat(own[1:], lengths)
    ahead = Extensions(words, own)
    back = Extensions(words[base + end - 1 - np.arange(own[-1])], own)
    rows = []
    for s, q in _grid(own, np.arange(len(docs))):
        keep = _likely(words, s, q)
        s, q = s[keep], q[keep]
        to = s + q + ahead(s, s + q)
        before = np.zeros(len(s), np.int64)
        inner = np.flatnonzero(s > base[s])
        if len(inner):
            a = s[inner]
            turned = base[a] + end[a]  # position x of the words is turned - 1 - x reversed
            before[inner] = back(turned - a - q[inner], turned - a)
        at = s - before
        keep = to - at >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        found = np.stack([at, to - at, q], axis=1)[keep]
        rows.append(_smallest(found))
    found = _smallest(np.concatenate(rows))
    doc = np.searchsorted(own, found[:, 0], "right") - 1
    return np.column_stack([docs[doc], found[:, 0] - own[doc], found[:, 1], found[:, 2]])


def _smallest(found: np.ndarray) -> np.ndarray:
    """Each stretch once, with its smallest period: grids of its multiples find it as well."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[first]


def planted(words: np.ndarray, start: np.ndarray, doc_ids: list[int | None]) -> np.ndarray:
    """`words` with the repeated tails that crc32 of the decimal doc_id calls for; none without an id."""
    out = words.copy()
    for i, doc_id in enumerate(doc_ids):
        n = int(start[i + 1] - start[i])
        if doc_id is None or not n:
            continue
        h = zlib.crc32(b"%d" % doc_id)
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            tail = words[start[i] + a : start[i] + a + p]
            out[start[i] + a : start[i + 1]] = np.resize(tail, n - a)
    return out


_NOTHING = hashlib.sha256(b"").hexdigest()
SCHEMA = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long,"
    " runs_sha256 string, collapsed_sha256 string"
)


def _batch(doc_ids: pa.Array, texts: pa.Array, tails: bool) -> pa.RecordBatch:
    flat, start = word_lists(texts)
    coded = flat.dictionary_encode()
    words = coded.indices.to_numpy().astype(np.int64)
    ids = doc_ids.to_pylist()
    if tails:
        words = planted(words, start, ids)
    runs = find_runs(words, start)
    n = len(ids)
    number = np.bincount(runs[:, 0], minlength=n)
    # Below 2**26 words, different ratios have different doubles and equal ones the same.
    order = np.lexsort((runs[:, 3], runs[:, 1], -(runs[:, 2] / runs[:, 3]), runs[:, 0]))
    best = {int(r[0]): r for r in runs[order][::-1].tolist()}
    first = np.searchsorted(runs[:, 0], np.arange(n + 1))
    lines = [_NOTHING] * n
    for i in np.flatnonzero(number).tolist():
        text = "".join("%d,%d,%d\n" % (s, size, q) for _, s, size, q in runs[first[i] : first[i + 1]].tolist())
        lines[i] = hashlib.sha256(text.encode()).hexdigest()

    cover = np.zeros(len(words) + 1, np.int64)
    from_ = start[runs[:, 0]] + runs[:, 1]
    np.add.at(cover, from_ + runs[:, 3], 1)
    np.add.at(cover, from_ + runs[:, 2], -1)
    kept = np.cumsum(cover)[:-1] == 0
    offsets = np.concatenate([[0], np.cumsum(kept)])[start]
    left = coded.dictionary.take(pa.array(words[kept]))
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), left), " ")
    hashes = [hashlib.sha256(t.as_buffer()).hexdigest() for t in joined]

    def of(k: int) -> pa.Array:
        return pa.array([best[i][k] if i in best else None for i in range(n)], pa.int64())

    thousandths = [1000 * best[i][2] // best[i][3] if i in best else None for i in range(n)]
    return pa.RecordBatch.from_arrays(
        [
            doc_ids, pa.array(number, pa.int64()), of(1), of(2), of(3), pa.array(thousandths, pa.int64()),
            pa.array(lines), pa.array(hashes),
        ],
        ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    )


def periodic_runs(docs: DataFrame, tails: bool = False) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent, and digests of all runs and of the collapsed text.

    A run is a stretch of at least max(24, 3q) words with smallest period q that cannot be extended.
    `runs_sha256` is over `start,length,period` lines by start, then period; `collapsed_sha256` over the
    words, joined by one space, that no run holds after its first q words. `tails` first repeats the tails of a tenth
    of the documents, chosen by crc32 of their id. NULL and empty texts have no words, no runs, four
    NULLs and digests of nothing; a NULL id gets no tail. Repeated rows are documents of their own;
    other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            yield _batch(part.column("doc_id"), part.column("text"), tails)

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(found, SCHEMA)
