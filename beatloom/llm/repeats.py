"""Removal of repeated byte strings, corpus-wide, by suffix arrays of shards.

Every byte goes that a string of `span` bytes covers which starts anywhere else as well. Windows of that
many bytes are brought together by their anchor: of the `GRAM`-byte strings in a window, the one with
the smallest hash, the leftmost of equals. Equal windows have equal anchors at equal places.

1. Documents are written in blocks of bounded bytes, bucketed by block, so that texts are shuffled no more.
2. Consecutive windows with one anchor form a segment. Anchors seen once in the corpus end here; blocks
   send each of their anchors once.
3. Segments with repeated anchors are sent as bytes, equal ones of a block once, and merged over blocks
   with how often they occur; a passage in a third of all documents is a few rows per block.
4. Segments are dealt by anchor into shards of bounded size. A shard's suffix array is made by induced
   sorting, its permuted common prefixes tell which windows have an equal neighbour; a segment that
   occurs twice is its own neighbour.
5. The blocks get their windows back, unite the bytes they cover and hash what is left.

An anchor with more than `hot` different segments makes no shard: its windows are counted one by one by
their 128-bit digest, map-side combined, which has the same result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices
from beatloom.llm.shared import scratch_path, text_or_empty, written
from beatloom.llm.suffixes import permuted_prefixes, suffix_array

SPAN = 200
GRAM = 32
BLOCK_BYTES = 16 << 20
SHARD_BYTES = 1 << 20
HOT = 5_000

# Positions within a chunk share a number with the hash. Texts are taken chunk by chunk, so that the numbers of
# a chunk stay in the processor's cache; where chunks meet a segment is two, which changes no window.
_PLACE_BITS = 24
_CHUNK = 1 << 17
_SEPARATOR = 0xFF  # no byte of UTF-8
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


# --- anchors and segments -------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    n = len(data) - GRAM + 1
    words = np.empty(len(data) - 7, np.uint64)
    for k in range(8):
        part = words[k::8]
        part[:] = np.frombuffer(data, "<u8", len(part), k)
    out = np.zeros(n, np.uint64)
    for k in range(0, GRAM, 8):
        out += words[k : k + n]
        out *= _MIX[1]
        out ^= out >> np.uint64(29)
    out *= _MIX[2]
    out ^= out >> np.uint64(32)
    return out


def _chunk_anchors(data: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, place) of the anchor of the window at each position."""
    hashes = _gram_hashes(data)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, span - GRAM + 1
    while width < wanted:  # minima over windows of doubled width
        step = min(width, wanted - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    place = (least & low).astype(np.int64)
    return hashes[place], place


def segments(data: np.ndarray, start: np.ndarray, span: int = SPAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash) of all segments of the texts data[start[i]:start[i + 1]].

    A window lies within its text. Segments of a text cover its windows in order.
    """
    found = []
    for at in range(0, max(len(data) - span + 1, 0), _CHUNK):
        part = data[at : at + _CHUNK + span - 1]
        anchor, place = _chunk_anchors(part, span)
        n = len(anchor)
        # Windows that begin near a text's end reach into the next text.
        inside = np.zeros(n + 1, np.int64)
        near = start[np.searchsorted(start, at, "right") - 1 : np.searchsorted(start, at + n) + 1] - at
        lows, highs = np.clip(near[:-1], 0, n), np.clip(near[1:] - span + 1, 0, n)
        some = highs > lows
        np.add.at(inside, lows[some], 1)
        np.add.at(inside, highs[some], -1)
        valid = np.cumsum(inside[:-1]) > 0
        change = np.ones(n, bool)
        change[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1]) | (inside[1:-1] != 0)
        first = np.flatnonzero(change)
        count = np.diff(first, append=n)
        keep = valid[first]
        found.append((first[keep] + at, count[keep], anchor[first[keep]]))
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 of all texts in a row, and where each begins."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body else np.empty(0, np.uint8)
    return data, offsets - offsets[0]


# --- tables ---------------------------------------------------------------------------------


def blocked(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The written documents (block, at, doc_id, text), bucketed by block; `at` counts within it."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block, at, size = TaskContext.get().partitionId() << 32, 0, 0
        for part in byte_slices(batches, "text", 1 << 20):
            if size > block_bytes:
                block, at, size = block + 1, 0, 0
            n = part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(at, at + n), pa.int32()), *part.columns],
                ["block", "at", "doc_id", "text"],
            )
            at, size = at + n, size + part.nbytes

    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    rows = texts.mapInArrow(numbered, "block long, at int, doc_id long, text string")
    name = f"blocked_{uuid.uuid4().hex}"
    # A task's blocks are few, so it writes few files; later reads by block need no shuffle.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows.write.bucketBy(buckets, "block").option("path", scratch_path(spark, name)).option(
        "compression", "zstd"
    ).saveAsTable(name)
    return spark.table(name)


def _block_anchors(blocks: DataFrame, span: int) -> DataFrame:
    """(block, anchor, uses): the anchors of every block with the number of their segments."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "text"):
            block = part.column("block").to_numpy()
            cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1])).tolist() + [len(block)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                _, _, anchor = segments(*_bytes_of(part.column("text").slice(lo, hi - lo)), span)
                once, uses = np.unique(anchor.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(once), block[lo])), pa.array(once), pa.array(uses.astype(np.int32))],
                    ["block", "anchor", "uses"],
                )

    return blocks.select("block", "text").mapInArrow(found, "block long, anchor long, uses int")


def _repeated_anchors(blocks: DataFrame, span: int) -> DataFrame:
    """(block, anchor) of anchors with two segments or more in the corpus."""
    same = Window.partitionBy("anchor")
    counted = _block_anchors(blocks, span).withColumn("n", F.sum("uses").over(same))
    return counted.filter("n > 1").select("block", "anchor")


_SEGMENT = "block long, c1 long, c2 long, uses long, anchor long, n int, body binary, places binary"


def _by_position(table: pa.Table) -> pa.Table:
    return table.sort_by("at").combine_chunks()


def _block_slices(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Table]]:
    """(data, start, at, rows) of a block's documents, a few MB at a time."""
    for part in byte_slices(_by_position(table).to_batches(), "text"):
        data, start = _bytes_of(part.column("text"))
        yield data, start, part.column("at").to_numpy(), part


def candidate_segments(blocks: DataFrame, span: int = SPAN) -> DataFrame:
    """Written: each block's different segments with repeated anchors, their bytes and their places.

    c1 and c2 are the 128-bit digest of the bytes. A place is (at, first window, times): so many equal
    segments one behind the other.
    """

    def chosen(key, texts: pa.Table, anchors: pa.Table) -> pa.Table:
        wanted = np.sort(anchors.column("anchor").to_numpy())
        known: dict[bytes, list] = {}
        for data, start, at, _ in _block_slices(texts):
            first, count, anchor = segments(data, start, span)
            signed = anchor.view(np.int64)
            if not len(wanted):
                continue
            spot = np.minimum(np.searchsorted(wanted, signed), len(wanted) - 1)
            keep = wanted[spot] == signed
            first, count, signed = first[keep], count[keep], signed[keep]
            doc = np.searchsorted(start, first, "right") - 1
            local, owner = (first - start[doc]).tolist(), at[doc].tolist()
            view, ends = memoryview(np.ascontiguousarray(data)), (first + count + span - 1).tolist()
            rows = zip(first.tolist(), ends, signed.tolist(), owner, local, count.tolist(), strict=True)
            for low, high, mark, place, window, n in rows:
                body = view[low:high]
                digest = xxhash.xxh3_128_digest(body)
                held = known.get(digest)
                if held is None:
                    known[digest] = [1, mark, bytes(body), [[place, window, 1]]]
                    continue
                held[0] += 1
                last = held[3][-1]
                if last[0] == place and last[1] + last[2] * n == window:
                    last[2] += 1
                else:
                    held[3].append([place, window, 1])
        codes = np.frombuffer(b"".join(known), "<i8").reshape(-1, 2) if known else np.empty((0, 2), np.int64)
        values = list(known.values())
        block = key[0].as_py()
        return pa.table(
            {
                "block": pa.array([block] * len(values), pa.int64()), "c1": pa.array(codes[:, 0]),
                "c2": pa.array(codes[:, 1]), "uses": pa.array([v[0] for v in values], pa.int64()),
                "anchor": pa.array([v[1] for v in values], pa.int64()),
                "n": pa.array([len(v[2]) - span + 1 for v in values], pa.int32()),
                "body": pa.array([v[2] for v in values], pa.binary()),
                "places": pa.array([np.array(v[3], "<i4").tobytes() for v in values], pa.binary()),
            }
        )

    anchors = _repeated_anchors(blocks, span)
    # Blocks without any repeated anchor are no group of the right side, and have no segments.
    both = blocks.select("block", "at", "text").groupBy("block").cogroup(anchors.groupBy("block"))
    return written(both.applyInArrow(chosen, _SEGMENT), "segments")


_HITS = "c1 long, c2 long, hits array<int>"


def _stretches(found: np.ndarray) -> list[int]:
    """[first, end, first, end ...] of the stretches of True."""
    return np.flatnonzero(np.diff(found.astype(np.int8), prepend=0, append=0)).tolist()


def shard_hits(bodies: list[bytes], uses: np.ndarray, span: int = SPAN) -> list[list[int]]:
    """Per segment the stretches of windows that start anywhere else, by the shard's suffix array."""
    data = np.frombuffer(bytes([_SEPARATOR]).join([*bodies, b""]), np.uint8)
    sizes = np.array([len(b) + 1 for b in bodies])
    starts = np.cumsum(sizes) - sizes
    order = suffix_array(np.append(data.astype(np.int16) + 1, 0))[1:]
    before, common = permuted_prefixes(data, order, span)
    alike = common >= span
    repeated = alike.copy()
    repeated[before[alike]] = True
    return [
        [0, size - span] if n > 1 else _stretches(repeated[at : at + size - span])
        for at, size, n in zip(starts.tolist(), sizes.tolist(), uses.tolist(), strict=True)
    ]


def _shards(found: DataFrame, number: int, span: int) -> DataFrame:
    def judged(table: pa.Table) -> pa.Table:
        hits = shard_hits(table.column("body").to_pylist(), table.column("uses").to_numpy(), span)
        return pa.table([table.column("c1"), table.column("c2"), pa.array(hits, pa.list_(pa.int32()))], ["c1", "c2", "hits"])

    shard = F.pmod(F.xxhash64("anchor"), F.lit(number)).alias("shard")
    return found.groupBy(shard).applyInArrow(judged, _HITS)


def _windows_alone(found: DataFrame, span: int) -> DataFrame:
    """The same by the digest of every window, for anchors with too many segments for a shard."""
    schema = "c1 long, c2 long, k int, uses long, w1 long, w2 long"

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in byte_slices(batches, "body", 1 << 18):
            rows, raw = [], []
            for row in part.to_pylist():
                body = row["body"]
                for k in range(len(body) - span + 1):
                    rows.append((row["c1"], row["c2"], k, row["uses"]))
                    raw.append(xxhash.xxh3_128_digest(body[k : k + span]))
            codes = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                 pa.array(codes[:, 0]), pa.array(codes[:, 1])],
                ["c1", "c2", "k", "uses", "w1", "w2"],
            )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            hits = [[x for k in row for x in (k, k + 1)] for row in part.column("ks").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("c1"), part.column("c2"), pa.array(hits, pa.list_(pa.int32()))], ["c1", "c2", "hits"]
            )

    windows = written(found.select("c1", "c2", "uses", "body").mapInArrow(listed, schema), "windows")
    twice = windows.groupBy("w1", "w2").agg(F.sum("uses").alias("n")).filter("n > 1").drop("n")
    # A window in very many segments is a skewed join with one row, which Spark splits at run time.
    hit = windows.join(twice, ["w1", "w2"]).groupBy("c1", "c2").agg(F.sort_array(F.collect_list("k")).alias("ks"))
    return hit.mapInArrow(joined, _HITS)


def repeated_windows(
    found: DataFrame, span: int = SPAN, shard_bytes: int = SHARD_BYTES, hot: int = HOT
) -> DataFrame:
    """(c1, c2, hits) of the segments with windows that start anywhere else."""
    merged = written(
        found.groupBy("c1", "c2").agg(
            F.sum("uses").alias("uses"), F.first("anchor").alias("anchor"), F.first("body").alias("body")
        ),
        "merged",
    )
    size = merged.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    heavy = written(merged.groupBy("anchor").count().filter(F.col("count") > hot).select("anchor"), "hot-anchors")
    hits = _shards(merged.join(heavy, "anchor", "left_anti"), 1 + size // shard_bytes, span)
    if heavy.isEmpty():
        return hits
    return hits.unionByName(_windows_alone(merged.join(heavy, "anchor", "left_semi"), span))


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _cover(places: list[bytes], hits: list[list[int]], counts: list[int], span: int) -> dict[int, list[tuple[int, int]]]:
    """Removed byte ranges per document of a block."""
    out: dict[int, list[tuple[int, int]]] = {}
    for raw, found, n in zip(places, hits, counts, strict=True):
        for at, window, times in np.frombuffer(raw, "<i4").reshape(-1, 3).tolist():
            ranges = out.setdefault(at, [])
            if times > 1 and found == [0, n]:
                ranges.append((window, window + times * n + span - 1))
                continue
            for t in range(times):
                base = window + t * n
                ranges += [(base + a, base + b + span - 1) for a, b in zip(found[::2], found[1::2], strict=True)]
    return out


def _left(body: memoryview, ranges: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(bytes removed, spans, digest of the rest)."""
    digest, at, removed, spans, end = hashlib.sha256(), 0, 0, 0, -1
    for low, high in sorted(ranges):
        if low > end:
            digest.update(body[at:low])
            spans += 1
        low = max(low, end, 0)
        if high > low:
            removed += high - low
            at = end = high
    digest.update(body[at:])
    return removed, spans, digest.hexdigest()


def remove_repeats(
    docs: DataFrame, span: int = SPAN, block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES, hot: int = HOT
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document.

    Texts are judged as UTF-8 bytes as they came in; strings do not reach over a document's end. Repeated
    rows are documents of their own, so long ones go whole. NULL texts count as empty: nothing to remove,
    the digest of nothing. Other columns are ignored; an empty table gives no rows.
    """
    blocks = blocked(docs, block_bytes)
    found = candidate_segments(blocks, span)
    hits = repeated_windows(found, span, shard_bytes, hot).filter(F.size("hits") > 0)
    marks = found.select("block", "c1", "c2", "places", "n").join(hits, ["c1", "c2"]).drop("c1", "c2")

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def result(texts: pa.Table, marks: pa.Table) -> pa.Table:
        covered = _cover(
            marks.column("places").to_pylist(), marks.column("hits").to_pylist(), marks.column("n").to_pylist(), span
        )
        parts = []
        for data, start, at, rows in _block_slices(texts):
            view, cuts = memoryview(np.ascontiguousarray(data)), start.tolist()
            left = [
                _left(view[cuts[i] : cuts[i + 1]], covered.get(doc, [])) for i, doc in enumerate(at.tolist())
            ]
            removed, spans, digest = zip(*left, strict=True)
            parts.append(
                pa.table(
                    [rows.column("doc_id"), pa.array(np.diff(start)), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.int64()), pa.array(digest)],
                    names,
                )
            )
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
        none = pa.table([pa.array([], k) for k in kinds], names)
        return pa.concat_tables([none, *parts])

    return blocks.groupBy("block").cogroup(marks.groupBy("block")).applyInArrow(result, _RESULT)
