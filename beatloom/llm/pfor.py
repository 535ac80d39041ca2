"""Token ids in patched frame-of-reference blocks, in ascending doc_id order.

A segment is one self-contained byte string:

    magic (8 bytes), block size, blocks, ids (3 x u64), block index (u32 start of each block), blocks

A block subtracts its minimum and packs the rest at the bit width that holds the chosen percentile
of its values. Longer values are exceptions: their low bits are packed with the others, and
position and whole value stand in the block's exception list. All numbers are little-endian.

    block: minimum u32, width u8, zero u8, exceptions u16, packed bits, positions u16[], values u32[]

Segments are rows of a Parquet table on shared storage (Spark commits whole task outputs, so a lost
executor leaves no torn file), with the documents they hold and their place in the shard. Shards
are ranges of doc_id; `write_file` and `read_file` put one segment into a plain file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices, slices
from beatloom.llm.shared import text_or_empty, written
from beatloom.llm.wordbpe import END_ID, default_path, word_bpe

MAGIC = b"BLPFOR01"
BLOCK = 256
PERCENTILE = 90
SEGMENT_IDS = 1 << 18

_HEAD = struct.Struct("<8s3Q")
_BLOCK_HEAD = np.dtype([("least", "<u4"), ("width", "u1"), ("zero", "u1"), ("exceptions", "<u2")])
_END = np.array([END_ID], "<u4").tobytes()


def _bit_length(values: np.ndarray) -> np.ndarray:
    """Bits of unsigned values below 2**32; a float64 exponent is exact there."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of `width`-bit values as rows of bytes, lowest bit first: 64 values make `width` words.

    Works down the 64 places of a word group, on all groups at once.
    """
    groups = np.ascontiguousarray(values.reshape(-1, 64).T).astype(np.uint64)
    words = np.zeros((width, groups.shape[1]), np.uint64)
    for k in range(64):
        at, shift = divmod(k * width, 64)
        words[at] |= groups[k] << np.uint64(shift)
        if shift + width > 64:
            words[at + 1] |= groups[k] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).astype("<u8").view(np.uint8).reshape(len(values), -1)


def _unpack(body: np.ndarray, width: int, block: int) -> np.ndarray:
    """The reverse of `_pack`."""
    words = np.ascontiguousarray(body.view("<u8").reshape(-1, width).T).astype(np.uint64)
    groups = np.empty((64, words.shape[1]), np.uint32)
    mask = np.uint64((1 << width) - 1)
    for k in range(64):
        at, shift = divmod(k * width, 64)
        value = words[at] >> np.uint64(shift)
        if shift + width > 64:
            value |= words[at + 1] << np.uint64(64 - shift)
        groups[k] = value & mask
    return np.ascontiguousarray(groups.T).reshape(-1, block)


def pack_ids(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One segment of unsigned 32-bit ids; none make a segment without blocks.

    `block` is a multiple of 64.
    """
    ids = np.asarray(ids, np.uint32)
    count = -(-len(ids) // block)
    if not count:
        return _HEAD.pack(MAGIC, block, 0, 0)
    fill = count * block - len(ids)
    # The last block is filled up with its last id, which never widens it.
    rows = np.concatenate([ids, np.full(fill, ids[-1], np.uint32)]).reshape(count, block)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = min(block - 1, int(np.ceil(block * percentile / 100)) - 1)
    width = _bit_length(np.partition(rest, at, axis=1)[:, at])
    long = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    heads = np.zeros(count, _BLOCK_HEAD)
    heads["least"], heads["width"], heads["exceptions"] = least, width, long.sum(axis=1)

    packed: list[bytes] = [b""] * count
    for w in np.unique(width):
        of = np.flatnonzero(width == w)
        if w:
            low = np.uint32((1 << int(w)) - 1)
            body, size = _pack(rest[of] & low, int(w)).tobytes(), int(w) * block // 8
            for k, i in enumerate(of.tolist()):
                packed[i] = body[k * size : (k + 1) * size]
    block_of, position = np.nonzero(long)
    values = rest[block_of, position].astype("<u4")
    cuts = np.searchsorted(block_of, np.arange(count + 1)).tolist()
    position = position.astype("<u2")

    out, starts, at = [], np.empty(count, "<u4"), 0
    raw = heads.tobytes()
    for i in range(count):
        lo, hi = cuts[i], cuts[i + 1]
        parts = (raw[8 * i : 8 * i + 8], packed[i], position[lo:hi].tobytes(), values[lo:hi].tobytes())
        starts[i] = at
        at += sum(map(len, parts))
        out.extend(parts)
    return b"".join([_HEAD.pack(MAGIC, block, count, len(ids)), starts.tobytes(), *out])


def unpack_ids(segment: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids of a segment; with `first` and `last`, of those blocks only, found by the index."""
    magic, block, count, total = _HEAD.unpack_from(segment)
    if magic != MAGIC:
        raise ValueError("not a segment of packed ids")
    last = count if last is None else min(last, count)
    if first >= last:
        return np.empty(0, np.uint32)
    starts = np.frombuffer(segment, "<u4", count, _HEAD.size)[first:last].astype(np.int64)
    raw = np.frombuffer(segment, np.uint8, offset=_HEAD.size + 4 * count)
    heads = raw[starts[:, None] + np.arange(8)].reshape(-1).view(_BLOCK_HEAD)
    rows = np.zeros((last - first, block), np.uint32)
    size = heads["width"].astype(np.int64) * block // 8
    for w in np.unique(heads["width"]):
        of = np.flatnonzero(heads["width"] == w)
        if w:
            body = raw[starts[of][:, None] + 8 + np.arange(int(w) * block // 8)]
            rows[of] = _unpack(body, int(w), block)
    # Patch the exceptions: entry k of block i, for all blocks at once.
    number = heads["exceptions"].astype(np.int64)
    block_of = np.repeat(np.arange(last - first), number)
    within = np.arange(len(block_of)) - np.repeat(np.cumsum(number) - number, number)
    at = (starts + 8 + size)[block_of]
    position = raw[(at + 2 * within)[:, None] + np.arange(2)].reshape(-1).view("<u2")
    value_at = at + 2 * number[block_of] + 4 * within
    rows[block_of, position] = raw[value_at[:, None] + np.arange(4)].reshape(-1).view("<u4")
    rows += heads["least"][:, None]
    return rows.reshape(-1)[: total - first * block]


def write_file(path: str, ids: np.ndarray) -> None:
    Path(path).write_bytes(pack_ids(ids))


def read_file(path: str) -> np.ndarray:
    return unpack_ids(Path(path).read_bytes())


def write_segments(docs: DataFrame, path: str | None = None, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """The written segment table of all documents, in ascending (doc_id, text), NULL ids first.

    shard, first (ids of the shard before the segment), n_ids, doc_ids, lengths, body. A segment
    ends with the document that fills it. Ranges are cut by a hash beside doc_id, so that even
    one id on a third of all rows is spread.
    """
    schema = (
        "shard int, first long, n_ids long, doc_ids array<long>, lengths array<long>, body binary"
    )
    path = path or default_path()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard, first = TaskContext.get().partitionId(), 0
        encoder = word_bpe(path)
        doc_ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def flush() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(held), "<u4")
            lengths = [len(h) // 4 for h in held]
            columns = [[shard], [first], [len(ids)], [list(doc_ids)], [lengths], [pack_ids(ids)]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                ["shard", "first", "n_ids", "doc_ids", "lengths", "body"],
            )

        for part in byte_slices(batches, "text"):
            encoded = encoder.encode(part.column("text"))
            for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                doc_ids.append(doc_id)
                held.append(ids + _END)
                size += len(ids) // 4 + 1
                if size >= segment_ids:
                    yield flush()
                    first, size = first + size, 0
                    doc_ids, held = [], []
        if held:
            yield flush()

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    ranged = texts.repartitionByRange("doc_id", F.xxhash64("text"))
    ordered = ranged.sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    return written(ordered.mapInArrow(packed, schema), "token-segments")


def read_segments(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the stored blocks alone."""
    schema = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long"

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, 8):
            rows: list[tuple] = []
            for row in part.to_pylist():
                raw = unpack_ids(row["body"]).astype("<u4").tobytes()
                at = 0
                for doc_id, length in zip(row["doc_ids"], row["lengths"], strict=True):
                    crc = zlib.crc32(raw[4 * at : 4 * (at + length)])
                    rows.append((doc_id, row["shard"], row["first"] + at, length, crc))
                    at += length
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                ["doc_id", "shard", "at", "n_tokens", "ids_crc32"],
            )

    # One row per shard, that is per task of the writing job; its size does not follow the texts.
    shards = segments.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    found = segments.mapInArrow(opened, schema).join(F.broadcast(before), "shard")
    return found.select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def packed_tokens(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode, write and read back: doc_id, start, n_tokens, ids_crc32 per document.

    NULL texts count as empty: one id, the end id. NULL doc_ids come first; repeated rows are
    documents of their own, equal ids in the order of their texts. Other columns are ignored; an
    empty table gives no rows.
    """
    return read_segments(write_segments(docs, path))
