import hashlib
import random
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from beatloom.llm import exact_dedup, jaccard_join, secret_scan, sieve
from beatloom.llm.components import components
from edge import EDGE, edge_rows, empty, rows_of

SF = "/root/testdata/sf0.001"


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")


def brute_exact(pairs):
    groups = defaultdict(list)
    for doc_id, text in pairs:
        groups[text or ""].append(doc_id)
    best = {t: max(ids, key=lambda i: (i is not None, i or 0)) for t, ids in groups.items()}
    return sorted(
        ((i, best[t or ""], len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in pairs),
        key=repr,
    ), len(groups)


@pytest.mark.parametrize("slots", [sieve.SLOTS, 1])
def test_exact_dedup(spark, monkeypatch, slots):
    monkeypatch.setattr(sieve, "SLOTS", slots)
    pairs = [tuple(r) for r in documents(spark).collect()] + EDGE
    got = exact_dedup.exact_dedup(edge_rows(spark, pairs)).collect()
    want, groups = brute_exact(pairs)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == want
    kept = [r for r in got if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_drop_copies_keeps_columns(spark):
    docs = edge_rows(spark, EDGE)
    out = exact_dedup.drop_copies(docs)
    assert out.schema.names == docs.schema.names
    assert sorted((t or "" for t in out.toPandas()["text"])) == sorted({t or "" for _, t in EDGE})
    assert exact_dedup.drop_copies(empty(spark)).count() == 0
    assert exact_dedup.exact_dedup(empty(spark)).count() == 0


def test_sieve_finds_every_key(spark):
    rows = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("_slot"))
    words = sieve.sieve(rows.filter("k % 7 = 0"), "k")
    got = sieve.marked(rows, words, ("k",), "hit")
    assert got.columns == ["k", "_slot", "hit"] and got.count() == 20_000
    assert got.filter("k % 7 = 0 AND NOT hit").isEmpty()
    assert got.filter("k % 7 > 0 AND hit").count() < 20
    nothing = sieve.marked(rows, sieve.sieve(rows.limit(0), "k"), ("k",), "hit")
    assert nothing.filter("hit").isEmpty() and nothing.count() == 20_000
    unset = spark.createDataFrame([(None,), ("a",)], "k string")
    assert sieve.marked(unset, sieve.sieve(unset, "k"), ("k",), "hit").filter("hit").count() == 2


@pytest.mark.parametrize("slots", [sieve.SLOTS, 1])
def test_full_filters_change_no_row(spark, monkeypatch, slots):
    monkeypatch.setattr(sieve, "SLOTS", slots)
    docs = edge_rows(spark, EDGE + [(20, "password=abcdefghijkl123 end"), (21, "password=abcdefghijkl123 end")])
    kept = exact_dedup.drop_copies(docs)
    assert Counter(t or "" for t in kept.toPandas()["text"]) == Counter({t or "" for _, t in EDGE} | {"password=abcdefghijkl123 end"})
    masked = {r.doc_id: r.text for r in secret_scan.mask_secrets(docs).collect() if r.doc_id in (8, 20, 21)}
    assert masked == {8: "x\n\n\nx\n", 20: "password=[SECRET] end", 21: "password=[SECRET] end"}


@pytest.mark.parametrize("threshold", ["-1", "1g"])
def test_rows_that_miss_the_filter_are_not_shuffled(spark, threshold):
    docs = edge_rows(spark, EDGE).withColumn("sha", F.sha2(F.coalesce("text", F.lit("")), 256))
    keys = docs.filter("doc_id = 4").select("sha")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        missed = sieve.marked(docs, sieve.sieve(keys, "sha"), ("sha",), "hit").filter("NOT hit").drop("hit", "sha")
        plan = missed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert all("BroadcastExchange" in e or "hashpartitioning(_slot" in e for e in exchanges), plan
    assert "BroadcastHashJoin" in plan


def shingles(text, n=5):
    words = (text or "").split()
    k = min(n, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def brute_jaccard(pairs):
    sets = [shingles(t) for _, t in pairs]
    where = defaultdict(list)
    links, parent = Counter(), list(range(len(sets)))

    def top(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in where[x])
        for x in s:
            where[x].append(i)
        for j, m in common.items():
            if 5 * m >= 4 * (len(s) + len(sets[j]) - m):
                links[i] += 1
                links[j] += 1
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[top(i)].append(pairs[i][0])
    name = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(
        ((pairs[i][0], name[top(i)], len(groups[top(i)]), links[i]) for i in range(len(sets))), key=repr
    ), len(groups)


def near_group(n=60, seed=3):
    """Near copies of one another and of nothing else, so that one bucket needs several blocks."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(120)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"x{rng.randrange(9999)}"
        out.append((1000 + i, " ".join(words)))
    return out


@pytest.mark.parametrize("block", [512, 16])
def test_jaccard_join(spark, block):
    pairs = [tuple(r) for r in documents(spark).collect()] + EDGE + near_group()
    got = jaccard_join.jaccard_join(edge_rows(spark, pairs), block=block).collect()
    want, _ = brute_jaccard(pairs)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_near_copies_leave_one_of_each_class(spark):
    pairs = EDGE + near_group(12)
    docs = edge_rows(spark, pairs)
    out = jaccard_join.drop_near_copies(docs)
    assert out.schema.names == docs.schema.names
    _, groups = brute_jaccard(pairs)
    assert out.count() == groups
    assert jaccard_join.drop_near_copies(empty(spark)).count() == 0
    assert jaccard_join.jaccard_join(empty(spark)).count() == 0


def test_pruning_bound():
    assert jaccard_join.least_matches(16, 0.8, 0.5) > jaccard_join.least_matches(16, 0.8, 1e-7)
    assert 0 < jaccard_join.least_matches(128, 0.8, 1e-7) < 103


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, 100), (300, 200), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}
    assert rows_of(components(spark.createDataFrame([], "u long, v long"))) == []
