"""Best-fit packing of token pieces after a Martello-Toth dominance reduction.

Pieces of one length are interchangeable, so the packing is planned on the histogram of lengths (at
most `capacity` numbers, whatever the size of the corpus) and then dealt out to the pieces:

1. Tokenising tasks write one small row per piece, with its number among the pieces of its length in
   that task. Nothing is sorted or grouped by length, so a hot length is no hot task.
2. Counts per (task, length) become running offsets, which number all pieces of a length.
3. The plan: sets of at most three lengths that provably dominate every other set holding their
   largest member are fixed for good (reduction); what is left is packed best-fit decreasing. Equal
   sequences are planned together, as a pattern and how often it occurs.
4. A piece's length and number give its sequence and place by binary search in the plan.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices
from beatloom.llm.shared import text_or_empty, written
from beatloom.llm.wordbpe import END_ID, default_path, word_bpe

CAPACITY = 4096
_END = np.array([END_ID], "<u4").tobytes()

Pattern = tuple[int, ...]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Written: doc_id, piece, start, length, ids_crc32, task, number (in task and length)."""
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"
    )
    path = path or default_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        encoder = word_bpe(path)
        for part in byte_slices(batches, "text"):
            rows: list[tuple] = []
            encoded = encoder.encode(part.column("text"))
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                raw = ids + _END
                for n, at in enumerate(range(0, len(raw), 4 * capacity)):
                    body = raw[at : at + 4 * capacity]
                    length = len(body) // 4
                    rows.append((doc_id, n, at // 4, length, zlib.crc32(body), task, int(seen[length])))
                    seen[length] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names
            )

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return written(texts.mapInArrow(cut, schema), "pieces")


class _Lengths:
    """How many pieces of each length are left, with the lengths in order."""

    def __init__(self, counts: dict[int, int]):
        self.count = {k: n for k, n in counts.items() if n}
        self.order = sorted(self.count)

    def take(self, pattern: Pattern, times: int) -> None:
        for length in pattern:
            self.count[length] -= times
            if not self.count[length]:
                del self.count[length]
                self.order.pop(bisect_left(self.order, length))

    def most(self, limit: int, used: Pattern) -> int:
        """The largest length up to `limit` of which a piece is left beside those in `used`."""
        at = bisect_right(self.order, limit) - 1
        while at >= 0 and self.count[self.order[at]] <= used.count(self.order[at]):
            at -= 1
        return self.order[at] if at >= 0 else 0

    def least(self, used: Pattern, number: int, above: int = 0) -> list[int]:
        """The `number` smallest pieces longer than `above` left beside those in `used`."""
        found: list[int] = []
        for length in self.order[bisect_right(self.order, above) :]:
            free = self.count[length] - used.count(length)
            found.extend([length] * min(free, number - len(found)))
            if len(found) == number:
                break
        return found

    def best_pair(self, limit: int, used: Pattern) -> tuple[int, int]:
        """Two pieces left beside `used` with the largest sum up to `limit`; (0, 0) if none fit."""
        best, low, high = (0, 0), 0, bisect_right(self.order, limit) - 1
        while low <= high:
            a, b = self.order[low], self.order[high]
            if a + b > limit or self.count[b] <= used.count(b):
                high -= 1
                continue
            if self.count[a] - used.count(a) >= (2 if a == b else 1) and a + b > sum(best):
                best = (a, b)
                if a + b == limit:
                    break
            low += 1
        return best


def dominating_set(left: _Lengths, capacity: int, first: int) -> Pattern | None:
    """A feasible set with `first` that dominates every other feasible set with it, if one of at
    most three pieces is known to (criteria of Martello and Toth, 1990).

    With x the largest piece that fits beside `first`: nothing fits; x fills the sequence; no two
    others fit, so x replaces whichever one is used; no three fit and x is at least as long as the
    longest two together; or no three fit, a is the largest that fits beside x, and no two pieces
    longer than a fit, so that x and a replace the longer and the shorter of any two.
    """
    room = capacity - first
    x = left.most(room, (first,))
    if not x:
        return (first,)
    if x == room or sum(left.least((first,), 2)) > room or len(left.least((first,), 2)) < 2:
        return (first, x)
    three = left.least((first,), 3)
    if len(three) == 3 and sum(three) <= room:
        return None
    if x >= sum(left.best_pair(room, (first,))):
        return (first, x)
    a = left.most(room - x, (first, x))
    rivals = left.least((first,), 2, above=a)
    if a and (len(rivals) < 2 or sum(rivals) > room):
        return (first, x, a)
    return None


def reduce_by_dominance(left: _Lengths, capacity: int) -> list[tuple[Pattern, int]]:
    """Fix dominating sets from the longest pieces down, as often as all their members allow."""
    fixed: list[tuple[Pattern, int]] = []
    for first in sorted(left.order, reverse=True):
        while left.count.get(first):
            pattern = dominating_set(left, capacity, first)
            if pattern is None:
                break
            times = min(left.count[n] // pattern.count(n) for n in set(pattern))
            left.take(pattern, times)
            fixed.append((pattern, times))
    return fixed


def best_fit_decreasing(left: _Lengths, capacity: int) -> list[tuple[Pattern, int]]:
    """Best-fit decreasing over the lengths that are left; equal open sequences go together."""
    open_: dict[int, list[tuple[Pattern, int]]] = {}
    rooms: list[int] = []

    def put(pattern: Pattern, times: int) -> None:
        room = capacity - sum(pattern)
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((pattern, times))

    for length in reversed(left.order):
        todo = left.count[length]
        while todo:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                room, base, there = capacity, (), todo
            else:
                room = rooms[at]
                base, there = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    rooms.pop(at)
            # Best fit stays with the sequence it has just filled further, until no more fits.
            each = room // length
            full = min(there, todo // each)
            if full:
                put((*base, *[length] * each), full)
            todo -= full * each
            there -= full
            if there and 0 < todo < each:
                put((*base, *[length] * todo), 1)
                todo, there = 0, there - 1
            if there and base:
                put(base, there)
    return [group for groups in open_.values() for group in groups]


def plan_packing(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and how often each occurs, together holding `counts[n]` pieces of every length n."""
    left = _Lengths(counts)
    fixed = reduce_by_dominance(left, capacity)
    return fixed + best_fit_decreasing(left, capacity)


def _slots(plan: list[tuple[Pattern, int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first number, first sequence, offset): its pieces in the order of the plan.

    From `first number` on, one piece goes to each of the pattern's sequences in turn.
    """
    slots: dict[int, list[tuple[int, int, int]]] = {}
    given: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        offset = 0
        for length in pattern:
            slots.setdefault(length, []).append((given.get(length, 0), sequence, offset))
            given[length] = given.get(length, 0) + times
            offset += length
        sequence += times
    return {n: np.array(rows, np.int64) for n, rows in slots.items()}


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    NULL texts count as empty: one piece, the end id. Repeated rows and NULL ids are documents of
    their own. Only documents of more than `capacity` ids are cut. Other columns are ignored; an
    empty table gives no rows.
    """
    cut = pieces(docs, capacity, path)
    per_task = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    ahead = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_task.select(
        "task", "length", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")
    )
    # At most `capacity` rows, one per length.
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(plan_packing(histogram, capacity))
    numbered = cut.join(offsets, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("number") + F.col("before")).alias("number")
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long,"
        " sequence_id long, offset long"
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy() for c in ("length", "number"))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(length[order]) != 0, True]) if len(order) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                at = order[lo:hi]
                table = slots[int(length[at[0]])]
                row = table[np.searchsorted(table[:, 0], number[at], "right") - 1]
                sequence[at] = row[:, 1] + number[at] - row[:, 0]
                offset[at] = row[:, 2]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return numbered.mapInArrow(place, schema)
