"""The registered training-data queries against their SQL, and the pipeline as a whole."""

from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from beatloom.llm import queries, shared

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query(spark, db, name):
    df = queries.QUERIES[name](spark, SF)
    result = db.execute(queries.ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(columns).collect()))) == sorted(map(repr, result.fetchall()))


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


def brute_pipeline(spark):
    """Documents that each stage keeps, from the SQL of the rules and plain Python."""
    from test_dedup import shingles

    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    good = db.execute(f"SELECT doc_id FROM ({queries.ORACLES['op6_quality_rules']}) WHERE kept").fetchall()
    texts = dict(db.execute("SELECT doc_id, text FROM documents").fetchall())
    kept = [{i for (i,) in good}]
    largest = {}
    for i in kept[0]:
        largest[texts[i]] = max(i, largest.get(texts[i], i))
    kept.append(set(largest.values()))
    ids = sorted(kept[1])
    sets = {i: shingles(texts[i]) for i in ids}
    root = {i: i for i in ids}

    def top(i):
        return i if root[i] == i else top(root[i])

    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if 5 * common >= 4 * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    kept.append({top(i) for i in ids})
    return kept, texts


def test_pipeline(spark):
    from test_text_rules import brute_base

    want, texts = brute_pipeline(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = shared.written(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        seen.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert seen == [*want, want[-1]]
    for r in docs.collect():
        clean = not brute_base(texts[r.doc_id])
        assert not brute_base(r.text) and r.n_chars == len(r.text)
        assert r.text == texts[r.doc_id] or not clean or "[SECRET]" in r.text
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == want[-1]
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in whole) == sorted(
        (r.doc_id, r.piece, r.length, r.ids_crc32) for r in packed
    )
    shared.clear_scratch(spark)
