import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from beatloom.llm import boosted_quality, packing, pfor, sentencepiece_backend, token_counts, wordbpe
from beatloom.llm.wordbpe import WordBpe, default_path
from edge import EDGE, LONG, edge_rows, empty

SF = "/root/testdata/sf0.001"
ODD = [
    "I'M here's it'LL 've'd don't!!'s 12'3 a\x0bb\x1cc ÀÉ÷×ß", "'sabc 're", "<|endoftext|> x", "日本 é İx ſ",
    "a\u0085b c", "!'s", "", "''t'''m", " \n\t ", "é <|startoftext|>", "ẞŒœ ŉ", "ª º µ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_word_bpe_equals_the_library(spark, library):
    texts = ODD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert WordBpe(default_path()).encode(texts) == [raw(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_word_bpe_forgets(library):
    coder, most = WordBpe(default_path(), cache_bytes=3000), 0
    for k in range(8):
        texts = [f"alpha{k} beta, gamma! {' '.join(chr(97 + k) * n for n in range(1, 30))} {i}" for i in range(4)]
        assert coder.encode(texts) == [raw(library.encode(t, add_special_tokens=False).ids) for t in texts]
        most = max(most, coder.known.nbytes)
    assert 1000 < most < 6000  # the bound and one batch


def test_digests_that_share_a_half(library, monkeypatch):
    monkeypatch.setattr(wordbpe, "_digests", lambda words: np.array([[len(w), 7] for w in words], np.uint64).reshape(-1, 2))
    text = "one three one fourteen, x"
    assert WordBpe(default_path()).encode([text]) == [raw(library.encode(text, add_special_tokens=False).ids)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
def test_pack_ids_round_trip(n, tmp_path):
    rng = np.random.default_rng(n)
    outliers = np.where(rng.random(n) < 0.05, 2**32 - 1, rng.integers(0, 100, n))
    for ids in (rng.integers(0, 50_000, n), np.full(n, 7), outliers, rng.integers(0, 2**32, n)):
        ids = ids.astype(np.uint32)
        pfor.write_file(str(tmp_path / "ids"), ids)
        assert np.array_equal(pfor.read_file(str(tmp_path / "ids")), ids)
        assert np.array_equal(pfor.unpack_ids(pfor.pack_ids(ids), 1, 3), ids[256:768])
    with pytest.raises(ValueError):
        pfor.unpack_ids(b"x" * 40)


def test_packing_saves_room():
    ids = np.where(np.random.default_rng(1).random(10_000) < 0.05, 60_000, 100).astype(np.uint32)
    assert len(pfor.pack_ids(ids)) < len(ids) * 1.0


def test_packed_tokens(spark, library):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + EDGE
    docs = edge_rows(spark, pairs)
    segments = pfor.write_segments(docs, segment_ids=1000)
    assert segments.count() > 10
    got = sorted(pfor.read_segments(segments).collect(), key=lambda r: r.start)
    ids = {t: raw([*library.encode(t or "", add_special_tokens=False).ids, 1]) for _, t in pairs}
    key = lambda i: (i is not None, i or 0)
    assert [key(r.doc_id) for r in got] == sorted(key(i) for i, _ in pairs)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(ids[t]) // 4, zlib.crc32(ids[t])) for i, t in pairs
    )
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    assert pfor.packed_tokens(empty(spark)).count() == 0


HUGE = [
    "a" * 9000, "ab " * 900 + "x" * 5000 + " y", "<|endoftext|>" * 600, "é <|startoftext|> It's 123 " * 200,
    "日本語" * 1500, LONG[:20_000], " " * 3000 + "x", "\n".join(f"l{i}" for i in range(2000)),
]


def test_huge_counts_by_splicing(library):
    coder = WordBpe(default_path())
    for text in HUGE:
        want = len(library.encode(text, add_special_tokens=False).ids)
        for chunk, overlap in ((512, 16), (700, 64), (4096, 256)):
            n, chunks, _ = token_counts.count_huge(coder, text, chunk, overlap)
            assert n == want and (chunks > 1 or len(text) <= chunk)
    assert token_counts.count_huge(coder, "a b " * 3000, 512, 64)[2] == 0  # no overlap widened


def test_token_counts(spark, library):
    pairs = EDGE + list(enumerate(HUGE, 100))
    got = token_counts.token_counts(edge_rows(spark, pairs)).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in pairs]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and max(r.n_chunks for r in got) > 1
    assert token_counts.token_counts(empty(spark)).count() == 0


def optimum(items, capacity):
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in {b: k for k, b in enumerate(bins)}.values():
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                place(i + 1, bins)
                bins[k] -= items[i]
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


def test_reduction_never_costs_a_sequence():
    rng = random.Random(1)
    for _ in range(300):
        capacity = rng.choice([10, 20, 33])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(0, 8))]
        left = packing._Lengths(dict(Counter(items)))
        fixed = packing.reduce_by_dominance(left, capacity)
        rest = [n for n, k in left.count.items() for _ in range(k)]
        assert sum(t for _, t in fixed) + optimum(rest, capacity) == optimum(items, capacity)
        plan = packing.plan_packing(dict(Counter(items)), capacity)
        assert all(sum(p) <= capacity for p, _ in plan)
        assert sum((Counter({n: t}) for p, t in plan for n in p), Counter()) == Counter(items)


def test_plan_is_near_the_bound():
    rng = random.Random(2)
    counts = Counter(min(4096, int(rng.lognormvariate(6.5, 1)) + 1) for _ in range(50_000))
    n = sum(t for _, t in packing.plan_packing(counts))
    assert n <= 1.001 * -(-sum(a * b for a, b in counts.items()) // 4096) + 1


def test_pack_documents(spark, library):
    pairs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + EDGE
    got = packing.pack_documents(edge_rows(spark, pairs)).collect()
    want = Counter()
    for i, t in pairs:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(i, n, at, len(part), zlib.crc32(raw(part)))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places])[:-1].tolist()]
        assert sum(n for _, n in places) <= 4096
    assert packing.pack_documents(empty(spark)).count() == 0


def test_sentencepiece(spark):
    import sentencepiece

    original = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_backend.default_path())
    pairs = EDGE + list(enumerate([*ODD, "<s> x </s>", "▁mark ▁▁x", "\x00z", "  two  spaces ", " lead", "trail "], 50))
    got = sentencepiece_backend.sentencepiece_tokens(edge_rows(spark, pairs), threads=2).collect()
    want = []
    for i, t in pairs:
        ids = original.encode(t or "")
        want.append((i, len(ids), zlib.crc32(raw(ids)), zlib.crc32(original.decode(ids).encode())))
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32, r.decoded_crc32) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r.parity and r.decode_parity for r in got)
    assert sentencepiece_backend.sentencepiece_tokens(empty(spark)).count() == 0


def test_ids_come_from_the_rebuilt_pipeline(monkeypatch):
    """A faulty original changes the parity, not the ids."""
    codec = sentencepiece_backend.Codec(sentencepiece_backend.default_path())
    right = codec.encode(["a few words", "  odd one"])
    assert [same for _, same in right] == [True, True]
    other = sentencepiece_backend.Codec(sentencepiece_backend.default_path())

    class Faulty:
        def encode(self, texts, num_threads):
            return [[0] for _ in texts]

    monkeypatch.setattr(other, "original", Faulty())
    assert other.encode(["a few words", "  odd one"], threads=2) == [(ids, False) for ids, _ in right]


def _message(number, body):
    if isinstance(body, int):
        return bytes([number << 3, body])
    out, n = bytes([number << 3 | 2]), len(body)
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n]) + body


def test_unigram_model_is_rebuilt(tmp_path):
    """A hand-written unigram model with byte fallback gives the same ids in both libraries."""
    import struct

    import sentencepiece

    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    pieces += [(p, -float(i), 1) for i, p in enumerate(["▁", "▁ab", "a", "b", "ab", "c", "▁c", "bc"], 2)]
    data = b""
    for piece, score, kind in pieces:
        data += _message(1, _message(1, piece.encode()) + bytes([2 << 3 | 5]) + struct.pack("<f", score) + _message(3, kind))
    trainer = _message(3, 1) + bytes([0x98, 0x02, 1])  # model_type unigram; field 35, byte_fallback
    normalizer = _message(1, b"identity") + _message(3, 1) + _message(4, 0) + _message(5, 1)
    path = tmp_path / "uni.model"
    path.write_bytes(data + _message(2, trainer) + _message(3, normalizer))
    model = sentencepiece_backend.read_model(str(path))
    assert (model.kind, model.byte_fallback, model.trim) == (1, True, False)
    original = sentencepiece.SentencePieceProcessor(model_file=str(path))
    codec = sentencepiece_backend.Codec(str(path))
    texts = ["ab c", "abc bc a", "aéb", "  ab", ""]
    assert codec.encode(texts) == [(raw(original.encode(t)), True) for t in texts]


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = boosted_quality.quality_scores(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    both = got.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert len(held) > 40 and (held.predicted == held.quality).mean() > 0.95
    # Held-out labels have no part in the scores.
    flipped = labels.selectExpr("doc_id", "IF(pmod(crc32(cast(cast(doc_id AS string) AS binary)), 5) = 0, 1 - quality, quality) AS quality")
    again = boosted_quality.quality_scores(docs, flipped).toPandas()
    assert got.sort_values("doc_id").score.tolist() == again.sort_values("doc_id").score.tolist()


def test_classifier_on_edge_rows(spark):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    got = boosted_quality.quality_scores(edge_rows(spark, EDGE), labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in boosted_quality.quality_scores(edge_rows(spark, EDGE), labels.limit(0)).collect()} == {0.5}
    assert boosted_quality.quality_scores(empty(spark), labels).count() == 0


def test_forest_walk_equals_plain_trees():
    rng = np.random.default_rng(0)
    x = rng.random((400, 5))
    y = (x[:, 0] + x[:, 1] > 1).astype(float)
    forest = boosted_quality.fit(x, y, trees=20, depth=3)
    score = forest.score(x)
    for row, got in zip(x[:50], score[:50], strict=True):
        total = forest.base
        for feature, threshold, value in zip(forest.feature, forest.threshold, forest.value, strict=True):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += value[node - len(feature)]
        assert abs(1 / (1 + np.exp(-total)) - got) < 1e-12
    assert ((score > 0.5) == (y > 0.5)).mean() > 0.95
