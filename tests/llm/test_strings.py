"""Periodic runs, tokenizer alignment and repeated strings against brute force."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from beatloom.llm import alignment, periodic, queries, repeats, suffixes
from edge import EDGE, edge_rows, empty, rows_of

SF = "/root/testdata/sf0.001"
HAND = [
    (50, " "), (51, "a "), (52, " a  b "), (53, "a\n b  c\n\n  d"), (54, "x▁y z"), (55, "<|endoftext|> <s> <0x41> a\0b"),
    (56, "日本語" * 900), (57, "a" * 3000 + " bc"), (58, "to be or not " * 30), (59, "x " * 25 + "y " + "x " * 24),
    (60, ("lorem ipsum %s " % ("é" * 90)) * 8), (61, "b" * 199), (62, "b" * 199), (63, "c" * 200), (64, "c" * 200),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + EDGE + HAND


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


# --- periodic runs --------------------------------------------------------------------------


def brute_runs(words):
    """{(start, length): smallest period} by comparing the words with themselves at every distance."""
    codes = np.unique(np.array(words, object).astype(str), return_inverse=True)[1] if words else np.empty(0)
    best = {}
    for q in range(1, len(words) // 3 + 1):
        same = np.concatenate([[0], codes[q:] == codes[:-q], [0]]).astype(int)
        edges = np.flatnonzero(np.diff(same))
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist()):
            length = hi - lo + q
            if length >= max(24, 3 * q):
                best.setdefault((lo, length), q)
    return best


def brute_periodic(doc_id, text, tails):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if tails and doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = sorted((s, size, q) for (s, size), q in brute_runs(words).items())
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    top = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    milli = 1000 * top[1] // top[2] if runs else None
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (doc_id, len(runs), *top, milli, sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("tails", [True, False])
def test_periodic_runs(spark, pairs, tails):
    want = sorted((brute_periodic(*p, tails) for p in pairs), key=repr)
    assert [tuple(r) for r in rows_of(periodic.periodic_runs(edge_rows(spark, pairs), tails))] == want
    assert sum(w[1] > 0 for w in want) > 3
    assert periodic.periodic_runs(empty(spark)).count() == 0


def test_runs_of_random_words(monkeypatch):
    monkeypatch.setattr("beatloom.llm.periodic.PAIRS", 100)  # blocks of the grid
    rng = random.Random(1)
    for _ in range(60):
        docs = []
        for _ in range(rng.randint(1, 4)):
            words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, 120))]
            for _ in range(rng.randint(0, 2)):
                unit = [rng.randrange(50) for _ in range(rng.randint(1, 30))]
                at = rng.randint(0, len(words))
                words[at:at] = (unit * 200)[: rng.randint(20, 150)]
            docs.append(words)
        start = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        got = periodic.find_runs(np.array(sum(docs, []), np.int64), start)
        want = sorted((i, *k, q) for i, d in enumerate(docs) for k, q in brute_runs(d).items())
        assert list(map(tuple, got.tolist())) == want


def test_cover_reaches_every_difference():
    places = set(periodic.COVER.tolist())
    for i in range(13):
        for j in range(i + 1, i + 14):
            assert any((i + k) % 13 in places and (j + k) % 13 in places for k in range(13))


# --- alignment ------------------------------------------------------------------------------


def brute_alignment(rows):
    both = alignment.pair(*alignment.default_paths())
    held, found = Counter(), []
    for doc_id, text in rows:
        text = text or ""
        a = both.a.encode(" " + text, add_special_tokens=False).ids
        b = both.b.encode(text)
        raw_a, raw_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
        links, groups = Counter(), []
        if text and b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            end_a, end_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
            i = j = 0
            for cut in sorted(set(end_a) & set(end_b)):
                to_i, to_j = end_a.index(cut, i) + 1, end_b.index(cut, j) + 1
                groups.append(f"{','.join(map(str, a[i:to_i]))}|{','.join(map(str, b[j:to_j]))}")
                links.update((x, y) for x in a[i:to_i] for y in b[j:to_j])
                i, j = to_i, to_j
        held.update(links.keys())
        sizes = (len(a), len(b)) if groups else (0, 0)
        found.append((doc_id, *sizes, len(groups), links, sha(";".join(groups)) if groups else ""))
    top = {}
    for (x, _), n in held.items():
        top[x] = max(n, top.get(x, 0))
    return [
        (d, na, nb, ng, sum(ln.values()), sum(m for p, m in ln.items() if held[p] == top[p[0]]),
         sum(m * held[p] for p, m in ln.items()), digest)
        for d, na, nb, ng, ln, digest in found
    ]


@pytest.mark.parametrize("sizes", [{}, {"long_bytes": 500, "range_bytes": 100, "reach": 50, "block_bytes": 20_000}])
def test_aligned_tokens(spark, pairs, sizes):
    rows = pairs[::3] + EDGE + HAND
    got = rows_of(alignment.aligned_tokens(edge_rows(spark, rows), **sizes))
    assert [tuple(r) for r in got] == sorted(brute_alignment(rows), key=repr)


def test_alignment_of_no_rows(spark):
    assert alignment.aligned_tokens(empty(spark)).count() == 0


def test_fragments_compose_associatively():
    both = alignment.pair(*alignment.default_paths())
    text = "Das unverwechselbare Donaudampfschiff, naïve 日本語 1234567 encyclopaedia!!"
    size = len(text.encode()) + 1
    rng = random.Random(4)
    whole = alignment.range_fragment(both, alignment.units_of(text), 0, 0, size).whole()
    for _ in range(40):
        cuts = [0, *sorted(rng.sample(range(1, size), 3)), size]
        a, b, c, d = (
            alignment.range_fragment(both, alignment.units_of(text), 0, lo, hi) for lo, hi in zip(cuts, cuts[1:])
        )
        for made in (((a * b) * c) * d, a * (b * (c * d)), (a * b) * (c * d), alignment.Fragment() * a * b * c * d):
            made = made.whole()
            assert (made.groups, made.n_a, made.n_b, made.n_groups, made.n_links) == (
                whole.groups, whole.n_a, whole.n_b, whole.n_groups, whole.n_links
            )
            assert made.codes.tolist() == whole.codes.tolist() and made.times.tolist() == whole.times.tolist()


def test_units_are_forgotten(pairs):
    both = alignment.pair(*alignment.default_paths())
    import pyarrow as pa

    small, large = alignment.Units(both, most=2000), alignment.Units(both)
    for k in range(0, 12, 3):
        texts = pa.array([(t or "")[:1500] for _, t in pairs[k : k + 3]])
        units, number, _ = alignment.split_units(texts)
        uses = np.bincount(number, minlength=len(units))
        for found, row in (small.facts(units, uses), large.facts(units, uses)):
            assert found.text.take(pa.array(row[uses > 0])).to_pylist() == [
                brute_units(both, u) for u, n in zip(units.to_pylist(), uses) if n
            ]
    assert len(small.number) < len(large.number)


def brute_units(both, unit):
    a, b, same = both.encode(unit)
    if not same:
        return ""
    whole = alignment.range_fragment(both, [unit], 0, 0, len(unit.encode()) + 1).whole()
    return whole.groups.decode()


def test_pair_counts(spark):
    blocks = alignment.token_blocks(edge_rows(spark, [(1, "one two"), (2, "one"), (3, "one one")]))
    assert {r.n_documents for r in alignment.pair_counts(blocks).collect()} == {3, 1}


# --- repeated strings -----------------------------------------------------------------------


def brute_repeats(rows, span=200):
    raws = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(r[i : i + span] for _, r in raws for i in range(len(r) - span + 1))
    out = []
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            if seen[raw[i : i + span]] > 1:
                gone[i : i + span] = b"\1" * span
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((doc_id, len(raw), sum(gone), spans, sha(kept)))
    return out


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 20_000, "shard_bytes": 3000, "hot": 20}])
def test_remove_repeats(spark, pairs, sizes):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefg ") for _ in range(500))
    rows = [p for p in pairs if len(p[1] or "") < 20_000] + [
        (
            100 + i,
            "".join(rng.choice("xyz ") for _ in range(rng.randint(0, 300)))
            + passage[rng.randint(0, 100) : rng.randint(200, 500)] + "".join(rng.choice("xyz ") for _ in range(50)),
        )
        for i in range(60)
    ]
    got = rows_of(repeats.remove_repeats(edge_rows(spark, rows), **sizes))
    assert [tuple(r) for r in got] == sorted(brute_repeats(rows), key=repr)


def test_repeats_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr("beatloom.llm.repeats._CHUNK", 1000)  # texts over several chunks
    rng = random.Random(5)
    one = "".join(rng.choice("abcdefgh ") for _ in range(3500))
    rows = [(1, one), (2, one[700:2900] + "!"), (3, "z" * 4000), (None, "no")]
    got = rows_of(repeats.remove_repeats(edge_rows(spark, rows)))
    assert [tuple(r) for r in got] == sorted(brute_repeats(rows), key=repr)
    assert repeats.remove_repeats(empty(spark)).count() == 0


def test_segments_take_little_at_once(monkeypatch):
    rng = np.random.default_rng(6)
    start = np.append(0, np.cumsum(rng.choice([0, 1, 60, 199, 200, 201, 900, 5000], 3000)))
    data = rng.integers(97, 100, start[-1]).astype(np.uint8)

    def windows():
        first, count, anchor = repeats.segments(data, start)
        behind = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        return np.repeat(first, count) + behind, np.repeat(anchor, count)

    tracemalloc.start()
    repeats.segments(data, start)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 8 * len(data)  # less than one number per byte of the texts
    at, anchor = windows()
    monkeypatch.setattr("beatloom.llm.repeats._CHUNK", 1 << 23)
    whole = windows()
    assert at.tolist() == whole[0].tolist() and anchor.tolist() == whole[1].tolist()
    lengths = np.diff(start)
    assert at.tolist() == [p for a, n in zip(start.tolist(), lengths.tolist()) for p in range(a, a + n - 199)]


def test_texts_are_shuffled_no_more(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = repeats.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FlatMapCoGroupsInArrow") : plan.index("blocked_")]
    assert "Bucketed: true" in plan and "Exchange" not in scan


def test_suffix_array_and_prefixes():
    rng = random.Random(2)
    for _ in range(150):
        letters = rng.choice([1, 2, 3, 26])
        body = bytes(rng.randrange(97, 97 + letters) for _ in range(rng.randint(1, 120)))
        if rng.random() < 0.5:
            body = (body + body[: len(body) // 2]) * 2
        text = np.append(np.frombuffer(body, np.uint8).astype(np.int16) + 1, 0)
        want = sorted(range(len(body) + 1), key=lambda i: body[i:])
        assert suffixes.suffix_array(text).tolist() == want
        before, common = suffixes.permuted_prefixes(np.frombuffer(body, np.uint8), np.array(want[1:]), 40)
        for j, i in zip(want[1:], want[2:]):
            share = next((k for k in range(40) if body[i + k : i + k + 1] != body[j + k : j + k + 1]), 40)
            assert before[i] == j and common[i] == min(share, len(body) - max(i, j))


def test_names_are_sorted_few_times(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    passages = [" ".join(rng.choices(words, k=40)) for _ in range(60)]
    body = "\n".join(rng.choice(passages)[rng.randint(0, 60) :] for _ in range(200)).encode()
    text = np.append(np.frombuffer(body, np.uint8).astype(np.int16) + 1, 0)
    names = len(suffixes._lms(suffixes._types(text)))
    rows, places = [], suffixes._places
    monkeypatch.setattr(suffixes, "_places", lambda *keys: rows.append(len(keys[0])) or places(*keys))
    assert suffixes.suffix_array(text).tolist() == sorted(range(len(text)), key=lambda i: body[i:])
    assert sum(rows) < 5 * names  # twice at each level of the recursion, and long chains again


@pytest.mark.parametrize(
    "body",
    [
        b"ab" * 3000, b"ab" * 900 + b"ac" * 900 + b"ab" * 901,
        b"".join(b"a" + bytes([x, y]) for x in range(98, 120) for y in range(x, 250, 3)),
        b"".join(b"a" + bytes([x, y]) for x in range(120, 98, -1) for y in range(250, x, -3)) * 2,
        b"a\0b" * 40 + b"\0" * 60 + b"a\0b" * 41,
    ],
)
def test_long_chains_of_names(body):
    text = np.append(np.frombuffer(body, np.uint8).astype(np.int16) + 1, 0)
    want = sorted(range(len(body) + 1), key=lambda i: body[i:])
    assert suffixes.suffix_array(text).tolist() == want
    before, common = suffixes.permuted_prefixes(np.frombuffer(body, np.uint8), np.array(want[1:]), 200)
    for j, i in zip(want[1:], want[2:]):
        most = min(200, len(body) - max(i, j))
        same = next((k for k in range(most) if body[i + k] != body[j + k]), most)
        assert before[i] == j and common[i] == same


def test_registered(spark):
    for name in ("op11_periodic_runs", "op12_tokenizer_alignment", "op13_suffix_dedup"):
        assert queries.QUERIES[name](spark, SF).count() == 200
