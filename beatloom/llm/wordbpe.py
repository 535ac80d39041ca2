"""Token ids of whole texts under a word-level BPE file, made by the tokenizers library.

The file's own pipeline (NFC, white space to one space, lower case, split into letter runs, digits and
symbol runs, byte-level BPE with a word end) never looks across a split, so the ids of a text are the
ids of its pieces in turn. Texts of plain Latin letters are split here at white space and by the same
pattern, and the library encodes each distinct piece once per worker, as long as it is remembered;
every other text, and every text that holds a special token, goes to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism

END_ID = 1
FILE = "word_bpe_49k.json"

# The split pattern of the file, and the same over lower-case Latin-1.
FILE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = "a-zß-öø-ÿ"
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
# Precomposed letters only: nothing here composes, and lower case maps one to one.
_NOT_PLAIN = r"[^\t-\r -~À-ÖØ-öø-ÿ]"
CACHE_BYTES = 48 << 20
_AT_ONCE = 512


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


class _Remembered:
    """Ids of pieces under their 128-bit digest, in flat arrays: about 36 bytes a piece."""

    def __init__(self):
        self.high, self.low = np.empty(0, np.uint64), np.empty(0, np.uint64)
        self.start, self.size = np.empty(0, np.int32), np.empty(0, np.int32)
        self.ids = np.empty(0, "<u4")

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.high, self.low, self.start, self.size, self.ids))

    def __len__(self) -> int:
        return len(self.high)

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Place of each digest (rows low, high), or -1."""
        if not len(self.high):
            return np.full(len(digests), -1)
        order = np.argsort(digests[:, 1])  # in order, searches stay in the processor's cache
        asked = digests[order]
        spot = np.minimum(np.searchsorted(self.high, asked[:, 1]), len(self.high) - 1)
        same = (self.high[spot] == asked[:, 1]) & (self.low[spot] == asked[:, 0])
        at = np.empty(len(digests), np.int64)
        at[order] = np.where(same, spot, -1)
        return at

    def add(self, digests: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        order = np.argsort(digests[:, 1])
        at = np.searchsorted(self.high, digests[order, 1])
        start = len(self.ids) + np.cumsum(sizes) - sizes
        self.high = np.insert(self.high, at, digests[order, 1])
        self.low = np.insert(self.low, at, digests[order, 0])
        self.start = np.insert(self.start, at, start[order])
        self.size = np.insert(self.size, at, sizes[order])
        self.ids = np.concatenate([self.ids, ids])


def _gather(ids: np.ndarray, start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """ids[start:start + size] of all rows, one after the other."""
    ends = np.cumsum(sizes)
    at = np.arange(int(ends[-1]) if len(ends) else 0)
    at += np.repeat(start - ends + sizes, sizes)
    return ids[at]


def _digests(words: list[str]) -> np.ndarray:
    raw = b"".join([xxhash.xxh3_128_digest(w) for w in words])
    return np.frombuffer(raw, ">u8").astype(np.uint64).reshape(-1, 2)[:, ::-1]


class WordBpe:
    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer

        self.cache_bytes = cache_bytes
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.splits = self._known_pipeline(spec)
        if self.splits:
            vocab = spec["model"]["vocab"]
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            suffix = spec["model"]["end_of_word_suffix"]
            self.ends[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
        self.known = _Remembered()

    @staticmethod
    def _known_pipeline(spec: dict) -> bool:
        """Whether this is the pipeline that `_PIECE` stands for; else all texts go in whole."""
        text = json.dumps(spec.get("pre_tokenizer") or {}, ensure_ascii=False)
        norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        return (
            json.dumps(FILE_PATTERN) in text
            and norm == ["NFC", "Replace", "Lowercase"]
            and bool(spec["model"].get("end_of_word_suffix"))
        )

    def _side_by_side(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces and how many each has; a piece ends in the one token that ends a word."""
        found, sizes = [np.empty(0, "<u4")], [np.empty(0, np.int64)]
        for at in range(0, len(pieces), _AT_ONCE):
            part = pieces[at : at + _AT_ONCE]
            encoded = self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(encoded[0].ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):  # cannot happen with one word end per piece
                each = self.library.encode_batch(part, add_special_tokens=False)
                ids = np.concatenate([np.array(e.ids, "<u4") for e in each])
                cuts = np.cumsum([len(e.ids) for e in each])
            found.append(ids)
            sizes.append(np.diff(cuts, prepend=0))
        return np.concatenate(found), np.concatenate(sizes)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of distinct lower-case words: runs of letters, or several pieces."""
        names = words.to_numpy(zero_copy_only=False)
        alone = pc.utf8_is_alpha(words).to_numpy(zero_copy_only=False)
        split = [_PIECE.findall(w) for w in names[~alone]]
        pieces = [*names[alone], *chain.from_iterable(split)]
        counts = np.ones(len(names), np.int64)
        counts[~alone] = [len(s) for s in split]
        if self.known.nbytes > self.cache_bytes:
            self.known = _Remembered()
        digests = _digests(pieces)
        at = self.known.find(digests)
        new = np.flatnonzero(at < 0)
        if len(new):
            new = new[np.unique(digests[new, 1], return_index=True)[1]]
            self.known.add(digests[new], *self._side_by_side([pieces[i] for i in new.tolist()]))
            at = self.known.find(digests)
            if (at < 0).any():  # two digests that share a half: this batch without remembering
                return self._unremembered(pieces, alone, counts)
        sizes = self.known.size[at].astype(np.int64)
        ids = _gather(self.known.ids, self.known.start[at].astype(np.int64), sizes)
        return self._by_word(ids, sizes, alone, counts)

    def _unremembered(self, pieces, alone, counts):
        return self._by_word(*self._side_by_side(pieces), alone, counts)

    @staticmethod
    def _by_word(ids: np.ndarray, sizes: np.ndarray, alone: np.ndarray, counts: np.ndarray):
        """Pieces stand in the order of words of one piece, then the others."""
        order = np.concatenate([np.flatnonzero(alone), np.flatnonzero(~alone)])
        cuts = np.append(0, np.cumsum(sizes))
        first = np.append(0, np.cumsum(counts[order]))
        start, size = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        start[order] = cuts[first[:-1]]
        size[order] = cuts[first[1:]] - cuts[first[:-1]]
        return ids, start, size

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn as unsigned 32-bit integers, where each text's begin); no end ids.

        Texts are lowered, split at white space and numbered in Arrow; Python sees each distinct word once.
        """
        odd = np.ones(len(texts), bool)
        if self.splits:
            odd = pc.match_substring_regex(texts, _NOT_PLAIN).to_numpy(zero_copy_only=False).copy()
            for special in self.specials:
                odd |= pc.match_substring(texts, special).to_numpy(zero_copy_only=False)
        lists = pc.ascii_split_whitespace(pc.utf8_lower(texts.filter(pa.array(~odd))))
        coded = lists.flatten().dictionary_encode()
        ids, start, size = self._words(coded.dictionary)
        word = coded.indices.to_numpy()
        sizes = size[word]
        ids = _gather(ids, start[word], sizes)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        cuts = np.append(0, np.cumsum(sizes))[offsets - offsets[0]]
        if not odd.any():
            return ids, cuts
        parts, plain = [], iter(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True))
        for i, whole in enumerate(odd.tolist()):  # one at a time: an encoding is many times its text
            if whole:
                found = self.library.encode_batch_fast([texts[i].as_py()], add_special_tokens=False)
                parts.append(np.array(found[0].ids, "<u4"))
            else:
                low, high = next(plain)
                parts.append(ids[low:high])
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))

    def encode(self, texts: pa.Array | list[str | None]) -> list[bytes]:
        """Ids of each text (None: empty) as little-endian unsigned 32-bit integers, no end id."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([t or "" for t in texts], pa.string())
        ids, cuts = self.encode_batch(texts)
        raw, at = ids.tobytes(), (4 * cuts).tolist()
        return [raw[low:high] for low, high in zip(at[:-1], at[1:], strict=True)]


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    """The tokenizer of this worker."""
    return WordBpe(path)
