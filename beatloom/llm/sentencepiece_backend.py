"""SentencePiece models on the tokenizers library: encoding, decoding and their parity.

The model's protobuf is read with a small wire-format reader; from it the normaliser, the metaspace
marker, unigram scores or BPE merges, and byte fallback are rebuilt as a `tokenizers` pipeline, whose
batches run on `threads` threads of the library (a task's own processors).

If no piece of the vocabulary holds the marker behind another character, no merge and no unigram path
crosses a space, so the ids of a text are those of its words in turn. Distinct words are then encoded
once per worker, as long as they are remembered, by both libraries: parity is verified on every
word and, for texts that do not split at single spaces, on the whole text. Rows carry the ids and the
decoded text of the rebuilt pipeline; where sentencepiece differs, the row says so. Decoding is
compared on every whole text.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import slices
from beatloom.llm.shared import text_or_empty

FILE = "piece_bpe_32k.model"
MARK = "▁"
_MOST_KNOWN = 900_000
_AT_ONCE = 512

# Field numbers and types of the public sentencepiece_model.proto.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of one message: numbers for varints, bytes for all else."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind)
        if size is None:
            if kind != 2:
                raise ValueError(f"wire type {kind} in a sentencepiece model")
            size = varint()
        yield key >> 3, data[at : at + size]
        at += size


@dataclass
class Model:
    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unk_id: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    trim: bool = True
    escape: bool = True


def read_model(path: str) -> Model:
    model = Model()
    with open(path, "rb") as file:
        data = file.read()
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
            model.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
            model.kind = trainer.get(3, UNIGRAM)
            model.byte_fallback = bool(trainer.get(35, 0))
        elif number == 3:
            norm = dict(_fields(value))
            model.charsmap = norm.get(2, b"")
            model.dummy_prefix, model.trim, model.escape = (bool(norm.get(k, 1)) for k in (3, 4, 5))
    unknown = [i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN]
    model.unk_id = unknown[0] if unknown else 0
    return model


def _merges(model: Model) -> list[tuple[str, str]]:
    """Both parts of every piece, best score first: the order in which sentencepiece merges."""
    usable = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, score, kind in model.pieces:
        if kind == NORMAL:
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in usable and right in usable:
                    found.append((-score, usable[left], usable[right], left, right))
    return [(left, right) for *_, left, right in sorted(found)]


def by_words(model: Model) -> bool:
    """Whether no piece has the mark behind another character and spaces are left as they are."""
    crossing = any(MARK in p.lstrip(MARK) for p, _, kind in model.pieces if kind in (NORMAL, USER_DEFINED))
    return not crossing and not model.trim and model.dummy_prefix and model.escape and not model.charsmap


def build_tokenizer(model: Model):
    """The `tokenizers` pipeline of a unigram or BPE model."""
    from tokenizers import AddedToken, Regex, Tokenizer, decoders, normalizers, pre_tokenizers
    from tokenizers import models as kinds

    if model.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        core = kinds.BPE(
            vocab, _merges(model), unk_token=model.pieces[model.unk_id][0], fuse_unk=True,
            byte_fallback=model.byte_fallback,
        )
    elif model.kind == UNIGRAM:
        core = kinds.Unigram(
            [(p, s) for p, s, _ in model.pieces], model.unk_id, byte_fallback=model.byte_fallback
        )
    else:
        raise ValueError("only unigram and BPE models can be rebuilt")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(model.charsmap)] if model.charsmap else []
    if model.trim:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(MARK if model.escape else " "))
    if model.escape:
        steps.append(normalizers.Replace(" ", MARK))
    if steps:
        out.normalizer = normalizers.Sequence(steps)
    if by_words(model):
        out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
    own = [p for p, _, kind in model.pieces if kind == USER_DEFINED]
    if own:
        out.add_tokens([AddedToken(p, normalized=False) for p in own])
    back = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
    if model.dummy_prefix:
        back.append(decoders.Strip(" ", 1, 0))
    out.decoder = decoders.Sequence(back)
    return out


class Codec:
    """Both libraries over one model, with the words encoded so far."""

    def __init__(self, path: str):
        import sentencepiece

        model = read_model(path)
        self.rebuilt = build_tokenizer(model)
        self.original = sentencepiece.SentencePieceProcessor(model_file=path)
        self.by_words = by_words(model)
        self.marked = np.array([p.startswith(MARK) for p, _, _ in model.pieces])
        self._known: dict[str, bytes] = {}
        self._unequal: set[str] = set()

    def _both(self, texts: list[str], threads: int) -> list[tuple[bytes, bool]]:
        """Ids of the rebuilt pipeline and whether the original has the same."""
        mine = [e.ids for e in self.rebuilt.encode_batch(texts, add_special_tokens=False)]
        want = self.original.encode(texts, num_threads=threads)
        return [(np.array(a, "<u4").tobytes(), a == b) for a, b in zip(mine, want, strict=True)]

    def _learn(self, words: list[str], threads: int) -> None:
        groups = [words[at : at + _AT_ONCE] for at in range(0, len(words), _AT_ONCE)]
        joined = self._both([" ".join(g) for g in groups], threads)
        for group, (raw, equal) in zip(groups, joined, strict=True):
            starts = np.flatnonzero(self.marked[np.frombuffer(raw, "<u4")]) * 4
            if not equal or len(starts) != len(group):
                for word, (own, same) in zip(group, self._both(group, threads), strict=True):
                    self._known[word] = own
                    if not same:
                        self._unequal.add(word)
                continue
            cuts = [*starts.tolist(), len(raw)]
            for i, word in enumerate(group):
                self._known[word] = raw[cuts[i] : cuts[i + 1]]

    def encode(self, texts: list[str], threads: int = 1) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit integers, parity) of each text."""
        out: list[tuple[bytes, bool] | None] = [None] * len(texts)
        split: list[tuple[int, list[str]]] = []
        whole: list[int] = []
        for i, text in enumerate(texts):
            plain = self.by_words and text and MARK not in text and "  " not in text
            if plain and text[0] != " " and text[-1] != " " and "\0" not in text:
                split.append((i, text.split(" ")))
            else:
                whole.append(i)
        needed = set().union(*[words for _, words in split])
        new = needed.difference(self._known)
        if len(self._known) + len(new) > _MOST_KNOWN:
            self._known.clear()
            self._unequal.clear()
            new = needed
        self._learn(list(new), threads)
        ids_of = self._known.__getitem__
        for i, words in split:
            equal = not self._unequal or self._unequal.isdisjoint(words)
            out[i] = (b"".join(map(ids_of, words)), equal)
        for i, found in zip(whole, self._both([texts[i] for i in whole], threads), strict=True):
            out[i] = found
        return out


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """The codec of this worker."""
    return Codec(path)


def sentencepiece_tokens(docs: DataFrame, path: str | None = None, threads: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_crc32, parity and decode_parity per row.

    Ids and decoded texts are the rebuilt pipeline's; sentencepiece only says whether its own are
    the same. Batches are encoded by `threads`, by default as many as a task has processors.
    ids_crc32 is over the ids as little-endian unsigned 32-bit integers, decoded_crc32 over the
    UTF-8 of the text decoded from them. NULL texts count as empty (no ids); repeated rows are
    encoded each; other columns are ignored; an empty table gives no rows. Nothing is shuffled.
    """
    schema = (
        "doc_id long, n_tokens long, ids_crc32 long, decoded_crc32 long, parity boolean,"
        " decode_parity boolean"
    )
    path = path or default_path()
    threads = threads or int(docs.sparkSession.conf.get("spark.task.cpus", "1"))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        both = codec(path)
        for part in slices(batches, 256):
            found = both.encode(part.column("text").to_pylist(), threads)
            ids = [np.frombuffer(raw, "<u4").tolist() for raw, _ in found]
            decoded = both.rebuilt.decode_batch(ids, skip_special_tokens=False)
            wanted = both.original.decode(ids, num_threads=threads)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), pa.array([len(i) for i in ids], pa.int64()),
                    pa.array([zlib.crc32(raw) for raw, _ in found], pa.int64()),
                    pa.array([zlib.crc32(t.encode()) for t in decoded], pa.int64()),
                    pa.array([same for _, same in found]), pa.array([a == b for a, b in zip(decoded, wanted, strict=True)]),
                ],
                ["doc_id", "n_tokens", "ids_crc32", "decoded_crc32", "parity", "decode_parity"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(encoded, schema)
