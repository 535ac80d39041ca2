"""Token counts of whole texts, huge ones by overlap resynchronisation.

A text of more than `chunk` characters is encoded in overlapping chunks with offsets. Two chunks
are spliced at a position in their overlap where both start a token right after white space and
agree on every token from there to the end of the overlap: no split of the file's pipeline reaches
across white space and no special token holds any, so both encodings are the whole text's from there
on. If the overlap has no such position it is widened, up to the whole left chunk, and then one chunk
of twice the length takes over. Counting needs the splice points only, so memory stays at two chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import byte_slices
from beatloom.llm.shared import text_or_empty
from beatloom.llm.wordbpe import WordBpe, default_path, word_bpe

CHUNK = 16_384
OVERLAP = 256
LIMIT = 2048

_WHITE = frozenset(" \t\n\x0b\x0c\r")


class _Chunk:
    """Tokens of text[start:end]: ids and absolute start positions."""

    def __init__(self, library, text: str, start: int, end: int):
        encoding = library.encode(text[start:end], add_special_tokens=False)
        self.start, self.end = start, end
        self.ids = np.array(encoding.ids, np.int64)
        offsets = encoding.offsets
        self.at = np.fromiter((a for a, _ in offsets), np.int64, len(offsets)) + start

    def count(self, low: int, high: int) -> int:
        return int(np.searchsorted(self.at, high) - np.searchsorted(self.at, low))


def splice_point(text: str, left: _Chunk, right: _Chunk, low: int) -> int | None:
    """A position above `low` from which both chunks provably hold the whole text's tokens.

    The last white space of the overlap bounds what is compared: tokens behind it may be cut.
    """
    end = left.end
    while end > right.start and text[end - 1] not in _WHITE:
        end -= 1
    mine = left.at[(left.at >= right.start) & (left.at < end)]
    theirs = right.at[right.at < end]
    for p in np.intersect1d(mine, theirs).tolist():
        if p > low and text[p - 1] in _WHITE:
            a, b = np.searchsorted(left.at, [p, end]), np.searchsorted(right.at, [p, end])
            if np.array_equal(left.ids[a[0] : a[1]], right.ids[b[0] : b[1]]):
                return p
    return None


def count_huge(encoder: WordBpe, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> tuple[int, int, int]:
    """(tokens, chunks, widened overlaps) of one text."""
    library, total, chunks, widened = encoder.library, 0, 1, 0
    left, low = _Chunk(library, text, 0, min(chunk, len(text))), 0
    while left.end < len(text):
        chunks += 1
        width, end = overlap, min(left.end - overlap + chunk, len(text))
        while True:
            start = max(left.start, left.end - width)
            right = _Chunk(library, text, start, max(end, left.end + 1))
            p = splice_point(text, left, right, low)
            if p is not None:
                total += left.count(low, p)
                left, low = right, p
                break
            widened += 1
            if start == left.start:  # nothing to splice at: one chunk, twice as long, takes over
                longer = min(left.start + 2 * (left.end - left.start), len(text))
                left = _Chunk(library, text, left.start, longer)
                break
            width *= 4
    return total + left.count(low, len(text)), chunks, widened


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, n_chunks, n_widened per row.

    NULL texts count as empty, with no tokens; repeated rows are counted each; other columns are
    ignored; an empty table gives no rows. Nothing is shuffled. With a tokenizer file of another
    pipeline no splice is proven, and every text is encoded as one chunk.
    """
    schema = (
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean, n_chunks int, n_widened int"
    )
    path = path or default_path()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_bpe(path)
        for part in byte_slices(batches, "text"):
            texts = part.column("text")
            huge = pc.greater(pc.utf8_length(texts), chunk).to_numpy(zero_copy_only=False) & encoder.splits
            _, cuts = encoder.encode_batch(texts.filter(pa.array(~huge)))
            short = iter(np.diff(cuts).tolist())
            found = [
                count_huge(encoder, texts[i].as_py(), chunk, overlap) if h else (next(short), 1, 0)
                for i, h in enumerate(huge.tolist())
            ]
            tokens, chunks, widened = zip(*found, strict=True)
            n = pa.array(tokens, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("n_bytes"), n,
                    pa.array([t > limit for t in tokens]),
                    pa.array(chunks, pa.int32()), pa.array(widened, pa.int32()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit", "n_chunks", "n_widened"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long"), F.octet_length(text_or_empty()).cast("long").alias("n_bytes"),
        text_or_empty().alias("text"),
    )
    return texts.mapInArrow(counted, schema)
