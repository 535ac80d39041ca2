"""Arrow batch helpers for `mapInArrow` functions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ROWS = 512
BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    """Pieces of at most `rows` rows, so that what is made from one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def byte_slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = BYTES
) -> Iterator[pa.RecordBatch]:
    """Pieces whose values of `column` have about `most` bytes; a longer value makes its own piece."""
    for batch in batches:
        values = batch.column(column)
        ends = np.cumsum(pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right"))
            to = max(to, at + 1)
            yield batch.slice(at, to - at)
            at = to


def whole_groups(
    batches: Iterable[pa.RecordBatch], keys: list[str]
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """From rows sorted by `keys` (no NULLs): tables of whole groups and the offsets of the groups.

    Only the group that is still open at a batch's end is carried over.
    """
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        cuts = _starts(table, keys)
        rest = table.slice(int(cuts[-1]))
        if len(cuts) > 1:
            yield table.slice(0, int(cuts[-1])).combine_chunks(), cuts
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks(), np.array([0, rest.num_rows])


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        value = table.column(key).to_numpy()
        change[1:] |= value[1:] != value[:-1]
    return np.flatnonzero(change)


def binary_rows(values: list[np.ndarray]) -> pa.Array:
    return pa.array([v.tobytes() for v in values], pa.binary())
