"""Alignment of two tokenizers' tokens over the same bytes, as a monoid of text fragments.

A (byte-level BPE, tokenizers) and B (SentencePiece) cut a space and the text into tokens; byte offsets
where tokens of both end cut them into groups. A fragment is what a byte range says about that: the
tokens up to its first common end (open prefix), the groups between its common ends, and the tokens behind
the last (open suffix); a range without a common end is all open. Fragments of neighbouring ranges compose
associatively: the suffix on the left and the prefix on the right make one more group.

* No token of either crosses a space behind a character that is not white space. What lies between two
  such spaces is a unit: a fragment that is closed on both sides, made once per worker as long as it is
  remembered. A document of up to `long_bytes` bytes is the product of its units.
* A longer document is cut into byte ranges, dealt out to tasks with the units that reach into them
  (a range does not end in a unit of more than `reach` bytes), and its fragments are composed eight at a
  time in rounds of Spark tasks. Token ends tell which range a token belongs to.

Documents are kept in blocks, a row each with the distinct id pairs of the block, so that corpus-wide
counts are summed over one row per block and pair, and each block gets only the counts of its own pairs
back. No dictionary of the whole corpus is ever in one place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices
from beatloom.llm.shared import text_or_empty, written

FILE_A = "byte_bpe_50k.json"
FILE_B = "piece_bpe_32k.model"
LONG_BYTES = 1 << 16
RANGE_BYTES = 1 << 15
REACH = 4096
FAN_IN = 8
CACHE_BYTES = 24 << 20
SLICE_BYTES = 1 << 19

_CUT = re.compile(r"(?<=\S) ")
_B_BITS = 24
_AT_ONCE = 512


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(FILE_A), public_tokenizers.path(FILE_B)


def units_of(text: str) -> list[str]:
    """`text` cut at each space behind a character that is not white space, without that space."""
    units = _CUT.split(text)
    if len(units) > 1 and not units[-1]:  # a space at the end is no unit of its own
        units.pop()
        units[-1] += " "
    return units


def _byte_of() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable ones stand for themselves,
    the others in turn for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = sorted(set(range(256)).difference(own))
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = _byte_of()
        vocab = self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            plain = all(c in byte_of for c in token)
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if plain else token.encode()
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.len_a = np.array([len(x) for x in self.bytes_a])
        self.len_b = np.array([len(x) for x in self.bytes_b])

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        """Ids of both, and whether the bytes of both are a space and `text`."""
        ids_a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        ids_b = self.b.encode(text)
        whole = b" " + text.encode()
        same = b"".join([self.bytes_a[i] for i in ids_a]) == whole == b"".join([self.bytes_b[i] for i in ids_b])
        return np.array(ids_a, np.int64), np.array(ids_b, np.int64), same


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """The tokenizers of this worker."""
    return Pair(path_a, path_b)


# --- groups ---------------------------------------------------------------------------------


def group_text(a: list[int], b: list[int]) -> bytes:
    return f"{','.join(map(str, a))}|{','.join(map(str, b))}".encode()


def _distinct(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, how often) for the distinct ids of every group, in their order."""
    key, count = np.unique((group << _B_BITS) | ids, return_counts=True)
    return key >> _B_BITS, key & ((1 << _B_BITS) - 1), count


def links(group_a: np.ndarray, a: np.ndarray, group_b: np.ndarray, b: np.ndarray, groups: int):
    """(group, pair code, how often) of the linked ids, groups numbered from 0. Occurrences are
    multiplied, never listed."""
    ga, ia, na = _distinct(group_a, a)
    gb, ib, nb = _distinct(group_b, b)
    first = np.searchsorted(gb, np.arange(groups + 1))
    size = np.diff(first)[ga]
    left = np.repeat(np.arange(len(ga)), size)
    ends = np.cumsum(size)
    right = first[ga[left]] + np.arange(len(left)) - np.repeat(ends - size, size)
    return ga[left], (ia[left] << _B_BITS) | ib[right], na[left] * nb[right]


def summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order with the sums of their `times`."""
    out, of = np.unique(codes, return_inverse=True)
    return out, np.bincount(of, times, len(out)).astype(np.int64)


# --- fragments ------------------------------------------------------------------------------


def _none() -> np.ndarray:
    return np.empty(0, np.int64)


@dataclass
class Fragment:
    """A byte range's open prefix, closed groups and open suffix; `cut`: it has a common end."""

    cut: bool = False
    bad: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pre_a: np.ndarray = field(default_factory=_none)
    pre_b: np.ndarray = field(default_factory=_none)
    suf_a: np.ndarray = field(default_factory=_none)
    suf_b: np.ndarray = field(default_factory=_none)
    groups: bytes = b""
    codes: np.ndarray = field(default_factory=_none)
    times: np.ndarray = field(default_factory=_none)

    def __mul__(self, other: Fragment) -> Fragment:
        """This range and the next one as one; the empty fragment is neutral."""
        out = Fragment(
            self.cut or other.cut, self.bad or other.bad, self.n_a + other.n_a, self.n_b + other.n_b,
            pre_a=self.pre_a, pre_b=self.pre_b, suf_a=other.suf_a, suf_b=other.suf_b,
        )
        open_a, open_b = np.append(self.suf_a, other.pre_a), np.append(self.suf_b, other.pre_b)
        parts = [self, other]
        if not self.cut:  # all of it is open: in front of the other's prefix
            out.pre_a, out.pre_b = np.append(self.pre_a, other.pre_a), np.append(self.pre_b, other.pre_b)
        elif not other.cut:
            out.suf_a, out.suf_b = open_a, open_b
        else:
            parts = [self, _closed(open_a, open_b), other]
        out.n_groups = sum(p.n_groups for p in parts)
        out.n_links = sum(p.n_links for p in parts)
        out.groups = b";".join([p.groups for p in parts if p.n_groups])
        out.codes, out.times = summed(
            np.concatenate([p.codes for p in parts]), np.concatenate([p.times for p in parts])
        )
        return out

    def whole(self) -> Fragment:
        """A whole document: its first group is closed by the beginning. Empty if the bytes differ."""
        if self.bad or not self.cut or len(self.suf_a) or len(self.suf_b):
            return Fragment(bad=True)
        edge = Fragment(cut=True)
        return edge * self


def _closed(a: np.ndarray, b: np.ndarray) -> Fragment:
    """One group; none of its tokens is counted, they are where they were open."""
    zero = np.zeros
    _, codes, times = links(zero(len(a), np.int64), a, zero(len(b), np.int64), b, 1)
    codes, times = summed(codes, times)
    return Fragment(
        n_groups=1, n_links=len(a) * len(b), groups=group_text(a.tolist(), b.tolist()), codes=codes, times=times
    )


def range_fragment(both: Pair, units: list[str], base: int, low: int, high: int) -> Fragment:
    """The fragment of bytes low to high. `units` reach over both ends and begin at byte `base`."""
    found = [both.encode(u) for u in units]
    a = np.concatenate([f[0] for f in found])
    b = np.concatenate([f[1] for f in found])
    end_a, end_b = base + np.cumsum(both.len_a[a]), base + np.cumsum(both.len_b[b])
    in_a, in_b = (end_a > low) & (end_a <= high), (end_b > low) & (end_b <= high)
    a, b, end_a, end_b = a[in_a], b[in_b], end_a[in_a], end_b[in_b]
    out = Fragment(bad=not all(f[2] for f in found), n_a=len(a), n_b=len(b))
    common = np.intersect1d(end_a, end_b)
    if out.bad or not len(common):
        out.pre_a, out.pre_b = a, b
        return out
    out.cut = True
    # Group 0 is the open prefix, the last one the open suffix.
    of_a, of_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
    out.pre_a, out.pre_b = a[of_a == 0], b[of_b == 0]
    out.suf_a, out.suf_b = a[of_a == len(common)], b[of_b == len(common)]
    inner_a, inner_b = (of_a > 0) & (of_a < len(common)), (of_b > 0) & (of_b < len(common))
    _, codes, times = links(of_a[inner_a], a[inner_a], of_b[inner_b], b[inner_b], len(common))
    out.codes, out.times = summed(codes, times)
    cut_a, cut_b = np.searchsorted(of_a, np.arange(len(common) + 1)), np.searchsorted(of_b, np.arange(len(common) + 1))
    out.n_groups = len(common) - 1
    out.n_links = int((np.diff(cut_a)[1:] * np.diff(cut_b)[1:]).sum())
    list_a, list_b = a.tolist(), b.tolist()
    out.groups = b";".join(
        group_text(list_a[cut_a[g] : cut_a[g + 1]], list_b[cut_b[g] : cut_b[g + 1]]) for g in range(1, len(common))
    )
    return out


# --- short documents: products of units -----------------------------------------------------

# What Python's \s holds; RE2 has only the ASCII part of it.
_ENDS_WHITE = (
    r"^$|[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]$"
)


def split_units(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(units, number of the unit at each place, where each text's places begin).

    Texts are split at all spaces in Arrow; those where a space stands first, last or behind white space
    are cut by `units_of`. The units may hold repeats.
    """
    lists = pc.split_pattern(texts, " ")
    coded = lists.flatten().dictionary_encode()
    number, units = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    cuts = lists.offsets.to_numpy().astype(np.int64)
    cuts = cuts - cuts[0]
    odd = pc.match_substring_regex(units, _ENDS_WHITE).to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(odd[number])])[cuts]
    again = np.flatnonzero(np.diff(before))
    if not len(again):
        return units, number, cuts
    own = [units_of(t) if t else [] for t in (texts[int(i)].as_py() for i in again)]
    sizes = np.diff(cuts)
    place = np.repeat(np.isin(np.arange(len(texts)), again), sizes)
    sizes[again] = [len(u) for u in own]
    new = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(new[-1], np.int64)
    of_own = np.repeat(np.isin(np.arange(len(texts)), again), sizes)
    out[~of_own] = number[~place]
    out[of_own] = len(units) + np.arange(of_own.sum())
    return pa.concat_arrays([units, pa.array([u for list_ in own for u in list_], pa.string())]), out, new


@dataclass
class Facts:
    """Closed fragments of units, a row each: `numbers` are bad, n_a, n_b, n_groups, n_links and how many
    of `codes` and `times` are the row's."""

    numbers: np.ndarray
    text: pa.Array
    codes: np.ndarray
    times: np.ndarray

    @staticmethod
    def none() -> Facts:
        return Facts(np.empty((0, 6), np.int64), pa.array([], pa.string()), _none(), _none())

    @staticmethod
    def joined(parts: list[Facts]) -> Facts:
        return Facts(
            np.concatenate([p.numbers for p in parts]), pa.concat_arrays([p.text for p in parts]),
            np.concatenate([p.codes for p in parts]), np.concatenate([p.times for p in parts]),
        )

    def links_of(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of `row`, place in codes and times) of all their links."""
        size = self.numbers[row, 5]
        of = np.repeat(np.arange(len(row)), size)
        ends = np.cumsum(size)
        start = np.cumsum(self.numbers[:, 5]) - self.numbers[:, 5]
        return of, start[row[of]] + np.arange(len(of)) - np.repeat(ends - size, size)

    def take(self, row: np.ndarray) -> Facts:
        _, at = self.links_of(row)
        return Facts(self.numbers[row], self.text.take(pa.array(row)), self.codes[at], self.times[at])


def _lists(values: pa.Array, cuts: np.ndarray, by: str) -> pa.Array:
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), values), by)


def _stands(unit: str) -> bool:
    """Whether another unit may follow it: one that ends in white space ends its text."""
    return bool(unit) and not unit[-1].isspace()


class Units:
    """Fragments of units. Those that come twice in a batch are remembered, up to `most` bytes."""

    def __init__(self, both: Pair, most: int = CACHE_BYTES):
        self.both, self.most = both, most
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.known, self.held = Facts.none(), 0

    def facts(self, units: pa.Array, uses: np.ndarray) -> tuple[Facts, np.ndarray]:
        """Facts, and the row in them of each of `units`, which come `uses` times in the batch."""
        names = units.to_pylist()
        row = np.fromiter((self.number.get(u, -1) for u in names), np.int64, len(names))
        fresh = np.flatnonzero((row < 0) & (uses > 0))
        if not len(fresh):
            return self.known, row
        # Units that stand side by side first: the order in which `_encoded` returns them.
        stands = np.array([_stands(names[i]) for i in fresh.tolist()])
        fresh = np.concatenate([fresh[stands], fresh[~stands]])
        found = self._encoded([names[i] for i in fresh.tolist()], int(stands.sum()))
        row[fresh] = len(self.number) + np.arange(len(fresh))
        both = Facts.joined([self.known, found])
        self._remember(names, fresh, found, uses)
        return both, row

    def _remember(self, names: list[str], fresh: np.ndarray, found: Facts, uses: np.ndarray) -> None:
        if self.held > self.most:
            self._forget()
        often = np.flatnonzero(uses[fresh] > 1)
        for i in fresh[often].tolist():
            self.number.setdefault(names[i], len(self.number))
        kept = found.take(often)
        if len(self.number) != len(self.known.numbers) + len(often):  # a unit that came twice
            self._forget()
            return
        self.known = Facts.joined([self.known, kept])
        self.held = (
            sum(2 * len(names[i]) + 200 for i in fresh[often].tolist()) + self.held
            + kept.numbers.nbytes + kept.text.nbytes + 2 * kept.codes.nbytes
        )

    def _encoded(self, units: list[str], stand: int) -> Facts:
        parts = [
            part for at in range(0, stand, _AT_ONCE) for part in self._side_by_side(units[at : min(stand, at + _AT_ONCE)])
        ]
        return Facts.joined(parts + [part for u in units[stand:] for part in self._side_by_side([u])])

    def _side_by_side(self, units: list[str]) -> list[Facts]:
        """Facts of units encoded together; one by one where that shows something odd."""
        a, b, same = self.both.encode(" ".join(units))
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        end_a, end_b = np.cumsum(self.both.len_a[a]), np.cumsum(self.both.len_b[b])
        common = np.intersect1d(end_a, end_b)
        if not same or not np.isin(ends, common).all():
            if len(units) > 1:
                return [part for u in units for part in self._side_by_side([u])]
            return [Facts(np.array([[1, 0, 0, 0, 0, 0]]), pa.array([""]), _none(), _none())]
        of_a, of_b = np.searchsorted(common, end_a), np.searchsorted(common, end_b)
        groups = np.arange(len(common) + 1)
        cut_a, cut_b = np.searchsorted(of_a, groups), np.searchsorted(of_b, groups)
        first = np.searchsorted(np.searchsorted(ends, common), np.arange(len(units) + 1))  # group of a unit
        group, code, time = links(of_a, a, of_b, b, len(common))
        text = pc.binary_join_element_wise(
            _lists(pa.array(a).cast(pa.string()), cut_a, ","), _lists(pa.array(b).cast(pa.string()), cut_b, ","), "|"
        )
        linked = np.concatenate([[0], np.cumsum(np.diff(cut_a) * np.diff(cut_b))])
        numbers = np.column_stack([
            np.zeros(len(units), np.int64), np.diff(cut_a[first]), np.diff(cut_b[first]), np.diff(first),
            np.diff(linked[first]), np.diff(np.searchsorted(group, first)),
        ])
        return [Facts(numbers, _lists(text, first, ";"), code, time)]


@lru_cache(maxsize=2)
def remembered(path_a: str, path_b: str) -> Units:
    """The units of this worker."""
    return Units(pair(path_a, path_b))


_DOC = "doc_id n_a n_b n_groups n_links".split()
BLOCK = (
    "block long, codes array<long>, held array<int>, doc_id array<long>, n_a array<long>, n_b array<long>,"
    " n_groups array<long>, n_links array<long>, sha array<string>, cuts array<int>, links binary, times binary"
)


def _times_bytes(times: np.ndarray) -> bytes:
    """One byte of width, then the numbers at that width."""
    width = 1 if not len(times) or times.max() < 1 << 8 else 4 if times.max() < 1 << 32 else 8
    return bytes([width]) + times.astype(f"<u{width}").tobytes()


def _one_list(values: list | np.ndarray | pa.Array) -> pa.Array:
    flat = values if isinstance(values, pa.Array) else pa.array(values, pa.int64())
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _block_row(
    block: int, doc: np.ndarray, codes: np.ndarray, times: np.ndarray, facts: list, sha: list[str]
) -> pa.RecordBatch:
    """One block: (doc, code) rows sorted by both, `facts` in the order of `_DOC`."""
    known, number, held = np.unique(codes, return_inverse=True, return_counts=True)
    cuts = np.searchsorted(doc, np.arange(len(sha) + 1))
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [
            pa.array([block], pa.int64()), pa.array([known], longs), pa.array([held.astype(np.int32)], ints),
            *[_one_list(f) for f in facts], pa.array([sha], pa.list_(pa.string())),
            pa.array([cuts.astype(np.int32)], ints), pa.array([number.astype("<u4").tobytes()]),
            pa.array([_times_bytes(times)]),
        ],
        ["block", "codes", "held", *_DOC, "sha", "cuts", "links", "times"],
    )


def _sha(text: bytes | pa.Buffer) -> str:
    return hashlib.sha256(text).hexdigest()


def _aligned_slice(known: Units, part: pa.RecordBatch) -> tuple:
    """(doc_id, sums by document, digests, document, code and times of every distinct link)."""
    units, number, cuts = split_units(part.column("text"))
    n = part.num_rows
    facts, row = known.facts(units, np.bincount(number, minlength=len(units)))
    unit = row[number]
    doc = np.repeat(np.arange(n), np.diff(cuts))
    bad = np.bincount(doc, facts.numbers[unit, 0], n) > 0
    ok = ~bad[doc]
    sums = [np.bincount(doc[ok], facts.numbers[unit[ok], k], n).astype(np.int64) for k in range(1, 5)]
    texts = _lists(facts.text.take(pa.array(unit)), cuts, ";")
    sha = [
        _sha(text.as_buffer()) if there else ""
        for text, there in zip(texts, (~bad & (np.diff(cuts) > 0)).tolist(), strict=True)
    ]
    # Each unit of a document once, with how often it occurs there.
    of, uses = np.unique((doc[ok] << 32) | unit[ok], return_counts=True)
    own, at = facts.links_of(of & 0xFFFFFFFF)
    links = _per_document(of[own] >> 32, facts.codes[at], facts.times[at] * uses[own])
    return part.column("doc_id"), sums, sha, *links


def _joined_block(block: int, held: list[tuple]) -> pa.RecordBatch:
    ids, sums, shas, docs, codes, times = zip(*held, strict=True)
    before = np.cumsum([0, *map(len, shas)])
    return _block_row(
        block, np.concatenate([d + b for d, b in zip(docs, before)]), np.concatenate(codes), np.concatenate(times),
        [pa.concat_arrays(ids), *[np.concatenate(s) for s in zip(*sums, strict=True)]], [s for sha in shas for s in sha],
    )


def short_blocks(docs: DataFrame, paths: tuple[str, str], block_bytes: int) -> DataFrame:
    """Blocks of whole documents (doc_id, text)."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 32
        known = remembered(*paths)
        held: list[tuple] = []
        size = 0
        for part in byte_slices(batches, "text", min(SLICE_BYTES, block_bytes)):
            held.append(_aligned_slice(known, part))
            size += part.nbytes
            if size >= block_bytes:
                yield _joined_block(block, held)
                block, held, size = block + 1, [], 0
        if held:
            yield _joined_block(block, held)

    return docs.select("doc_id", "text").mapInArrow(made, BLOCK)


def _per_document(doc: np.ndarray, code: np.ndarray, times: np.ndarray):
    """(document, code) pairs once, sorted, with the sums of their times."""
    known, number = np.unique(code, return_inverse=True)
    key, of = np.unique(doc * max(1, len(known)) + number, return_inverse=True)
    total = np.bincount(of, times, len(key)).astype(np.int64)
    return key // max(1, len(known)), known[key % max(1, len(known))], total


# --- long documents: ranges composed in rounds ----------------------------------------------

_RANGE = "row long, doc_id long, at int, base long, low long, high long, text string"
_FRAGMENT = (
    "row long, doc_id long, at int, cut boolean, bad boolean, n_a long, n_b long, n_groups long, n_links long,"
    " pre_a binary, pre_b binary, suf_a binary, suf_b binary, groups binary, codes binary, times binary"
)
_NUMBERS = ("pre_a", "pre_b", "suf_a", "suf_b", "codes", "times")
_PARTS = ("cut", "bad", "n_a", "n_b", "n_groups", "n_links", "pre_a", "pre_b", "suf_a", "suf_b", "groups", "codes", "times")


def cut_ranges(text: str, width: int, reach: int) -> Iterator[tuple[int, int, int, str]]:
    """(base, low, high, units) of a text: byte ranges of about `width`, counted with the space in
    front, and the text of the units that reach into them."""
    units = units_of(text)
    ends = np.cumsum([len(u.encode()) + 1 for u in units])
    starts = np.append(0, ends[:-1])
    bounds = np.arange(width, int(ends[-1]), width)
    inside = np.searchsorted(ends, bounds, "left")
    bounds = [0, *bounds[(ends - starts)[inside] <= reach].tolist(), int(ends[-1])]
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        first = int(np.searchsorted(ends, low, "right"))
        last = int(np.searchsorted(ends, high, "left"))
        yield int(starts[first]), low, high, " ".join(units[first : last + 1])


def _to_batch(keys: list[tuple], found: list[Fragment]) -> pa.RecordBatch:
    columns = [pa.array([k[i] for k in keys], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32()))]
    for name in _PARTS:
        values = [getattr(f, name) for f in found]
        if name in _NUMBERS:
            values = [v.astype("<i8").tobytes() for v in values]
        kind = pa.bool_() if name in ("cut", "bad") else pa.binary() if name in (*_NUMBERS, "groups") else pa.int64()
        columns.append(pa.array(values, kind))
    return pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "at", *_PARTS])


def _from_row(row: dict) -> Fragment:
    return Fragment(**{p: np.frombuffer(row[p], "<i8") if p in _NUMBERS else row[p] for p in _PARTS})


def fragments(docs: DataFrame, paths: tuple[str, str], width: int, reach: int) -> DataFrame:
    """A row per byte range of every document (doc_id, text): its fragment, `at` counting from 0."""

    def ranged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text")), strict=True):
                rows = [
                    (row.as_py(), doc_id.as_py(), at, *found)
                    for at, found in enumerate(cut_ranges(text.as_py(), width, reach))
                ]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                    ["row", "doc_id", "at", "base", "low", "high", "text"],
                )

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(*paths)
        for part in byte_slices(batches, "text", 1 << 20):
            rows = part.to_pylist()
            yield _to_batch(
                [(r["row"], r["doc_id"], r["at"]) for r in rows],
                [range_fragment(both, units_of(r["text"]), r["base"], r["low"], r["high"]) for r in rows],
            )

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    dealt = numbered.mapInArrow(ranged, _RANGE).repartition("row", "at")
    return written(dealt.mapInArrow(encoded, _FRAGMENT), "fragments")


def composed(found: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """One fragment per document from its ranges' fragments, `fan_in` neighbours at a time."""

    def product(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["at"])
        out = Fragment()
        for row in rows:
            out = out * _from_row(row)
        key = (rows[0]["row"], rows[0]["doc_id"], rows[0]["at"] // fan_in)
        return pa.Table.from_batches([_to_batch([key], [out])])

    most = found.agg(F.max("at")).first()[0] or 0
    while most:
        found = found.groupBy("row", F.expr(f"at div {fan_in}")).applyInArrow(product, _FRAGMENT)
        most //= fan_in
    return found


def long_blocks(found: DataFrame) -> DataFrame:
    """A block per whole document."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                f = _from_row(row).whole()
                sha = _sha(f.groups) if f.n_groups else ""
                yield _block_row(
                    -1 - row["row"], np.zeros(len(f.codes), np.int64), f.codes, f.times,
                    [[row["doc_id"]], [f.n_a], [f.n_b], [f.n_groups], [f.n_links]], [sha],
                )

    return found.mapInArrow(made, BLOCK)


# --- corpus-wide counts ---------------------------------------------------------------------

RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long,"
    " groups_sha256 string"
)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """id_a, id_b, n_documents, best: in how many documents each pair is linked, and whether no other
    pair of its A id is in more."""
    return _judged(_pairs(blocks)).select(
        F.shiftright("code", _B_BITS).alias("id_a"), (F.col("code") % (1 << _B_BITS)).alias("id_b"),
        F.col("n").alias("n_documents"), "best",
    )


def _pairs(blocks: DataFrame) -> DataFrame:
    return blocks.select("block", F.inline(F.arrays_zip(F.col("codes").alias("code"), F.col("held").alias("held"))))


def _judged(pairs: DataFrame) -> DataFrame:
    counts = pairs.groupBy("code").agg(F.sum("held").alias("n")).withColumn("a", F.shiftright("code", _B_BITS))
    best = counts.groupBy("a").agg(F.max("n").alias("top"))
    # An A id has at most as many rows here as the vocabulary of B.
    return counts.join(best, "a").select("code", "n", (F.col("n") == F.col("top")).alias("best"))


def token_blocks(
    docs: DataFrame, paths: tuple[str, str] | None = None, long_bytes: int = LONG_BYTES,
    range_bytes: int = RANGE_BYTES, reach: int = REACH, block_bytes: int = 2 << 20,
) -> DataFrame:
    """The written blocks of all documents."""
    paths = paths or default_paths()
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    is_long = F.octet_length("text") > long_bytes
    short = short_blocks(texts.filter(~is_long), paths, block_bytes)
    found = fragments(texts.filter(is_long), paths, range_bytes, reach)
    return written(short.unionByName(long_blocks(composed(found))), "alignment-blocks")


def aligned_tokens(docs: DataFrame, paths: tuple[str, str] | None = None, **sizes: int) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document.

    A pair's count is the number of documents that hold it linked; repeated rows are documents of
    their own. Texts NULL, empty or whose tokens' bytes are not a space and the text have no tokens:
    zeros and an empty digest. Other columns are ignored; an empty table gives no rows.
    """
    blocks = token_blocks(docs, paths, **sizes)
    pairs = _pairs(blocks)
    own = F.sort_array(F.collect_list(F.struct("code", "n", "best")))
    # Per block its own pairs, in the order of its codes.
    counts = pairs.join(_judged(pairs), "code").groupBy("block").agg(own.alias("own"))
    counts = counts.select("block", F.col("own.n").alias("n"), F.col("own.best").alias("best"))
    rows = blocks.drop("codes", "held").join(counts, "block", "left")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield _scores(batch, i)

    return rows.mapInArrow(scored, RESULT)


def _scores(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
    def values(name: str) -> pa.Array:
        return batch.column(name)[i].values

    raw = batch.column("times")[i].as_py()
    times = np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)
    link = np.frombuffer(batch.column("links")[i].as_py(), "<u4")
    cuts = values("cuts").to_numpy()
    n = len(cuts) - 1
    doc = np.repeat(np.arange(n), np.diff(cuts))
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(link):
        count, top = values("n").to_numpy(), values("best").to_numpy(zero_copy_only=False)
        np.add.at(best, doc, times * top[link])
        np.add.at(total, doc, times * count[link])
    return pa.RecordBatch.from_arrays(
        [*[values(c) for c in _DOC], pa.array(best), pa.array(total), values("sha")],
        [*_DOC, "n_best", "count_sum", "groups_sha256"],
    )
