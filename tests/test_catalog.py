"""Upserts, lifecycle, status and catalog reports."""

from datetime import datetime as dt

import pytest

from beatloom import schemas
from beatloom.operators import catalog, quality

T0, T1, T2, T3 = (dt(2024, 1, d) for d in (1, 2, 3, 4))


def artifacts(spark, *rows):
    return spark.createDataFrame([(*r, T0) for r in rows], schemas.ARTIFACTS)


def test_upsert_replaces_by_key(spark):
    base = artifacts(spark, ("r1", "100", "raw", "ecg", "u1", "raw_ecg_v1"), ("r1", "101", "raw", "ecg", "v", "raw_ecg_v1"))
    new = artifacts(spark, ("r1", "100", "raw", "ecg", "u2", "raw_ecg_v1"))
    rows = catalog.upsert(base, new, ["run_id", "record_id", "layer", "artifact_type"], "created_at").collect()
    assert sorted((r.record_id, r.uri) for r in rows) == [("100", "u2"), ("101", "v")]


def service(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.SERVICE_RUNS)


def test_lifecycle(spark):
    base = service(
        spark, ("r1", "a", "running", "n1", T0, T0, T1), ("r1", "b", "running", "n1", T0, T0, None)
    )
    changes = service(
        spark,
        ("r1", "a", "succeeded", "n2", T1, T1, T2), ("r1", "b", "failed", None, T1, None, T2),
        ("r1", "b", "failed", "n4", T2, None, T3), ("r2", "a", "running", "n5", T1, T1, None),
    )
    rows = {(r.run_id, r.service): r for r in catalog.upsert_lifecycle(base, changes).collect()}
    a, b, c = rows[("r1", "a")], rows[("r1", "b")], rows[("r2", "a")]
    assert (a.status, a.notes, a.started_at, a.ended_at, a.created_at) == ("succeeded", "n2", T1, T1, T0)
    assert (b.status, b.notes, b.started_at, b.ended_at) == ("failed", "n4", T0, T2)
    assert (c.status, c.ended_at, c.created_at) == ("running", None, T1)


def test_runs(spark):
    base = spark.createDataFrame([("r1", T0.date(), "failed", "old", T0)], schemas.RUNS)
    new = spark.createDataFrame([("r1", T1.date(), "running", None, T1)], schemas.RUNS)
    r = catalog.upsert_run(base, new).first()
    assert (r.run_date, r.status, r.notes, r.created_at) == (T1.date(), "running", None, T0)


@pytest.mark.parametrize(
    "counts,expected",
    [
        ((2, 0, 0), "succeeded"), ((0, 2, 0), "succeeded"), ((1, 0, 1), "partial_success"),
        ((0, 1, 1), "partial_success"), ((0, 0, 2), "failed"),
    ],
)
def test_status(spark, counts, expected):
    rows = [
        ("r", "s", outcome)
        for outcome, n in zip(("ok", "skipped", "failed"), counts)
        for _ in range(n)
    ]
    r = catalog.run_status(spark.createDataFrame(rows, "run_id string, service string, outcome string")).first()
    assert (r.status, r.records_total) == (expected, 2)
    assert (r.records_ok, r.records_skipped, r.records_failed) == counts


def test_discovery_lineage_and_versions(spark):
    rows = artifacts(
        spark,
        ("r1", "101", "processed", "rr_intervals_v1", "p/101", "rr_intervals_v1"),
        ("r1", "100", "processed", "rr_intervals_v1", "p/100", "rr_intervals_v1"),
        ("r1", "102", "processed", "rr_intervals_v1", "p/102", "old"),
        ("r1", "100", "raw", "ecg", "x", "raw_ecg_v1"),
        ("r2", "100", "processing", "rr_intervals", "y", "rr_intervals"),
    )
    found = catalog.discover_artifacts(rows, "r1", "processed", "rr_intervals_v1", "rr_intervals_v1")
    assert [r.record_id for r in found.collect()] == ["100", "101"]
    assert catalog.discover_artifacts(rows, "r1", "processed", "rr_intervals_v1").count() == 3
    assert [r.layer for r in catalog.lineage(rows, "r1").collect()] == ["processed"] * 3 + ["raw"]
    bad = quality.version_mismatches(rows).collect()
    assert sorted(r.uri for r in bad) == ["p/102", "y"]


def test_run_level_artifacts_share_a_uri(spark):
    records = spark.createDataFrame([("r1", "1"), ("r1", "2"), ("r1", "2")], "run_id string, record_id string")
    rows = catalog.artifact_rows(records, "ml_ready", "record_features_v1", "ml_ready/x")
    assert rows.count() == 2
    r = catalog.artifact_consistency(rows).first()
    assert (r.artifact_rows, r.distinct_uris) == (2, 1)
    assert rows.filter("schema_ver <> artifact_type").isEmpty()


def test_summary_orphans_latest(spark):
    runs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "run_id string, at int")
    kids = spark.createDataFrame([("a",), ("a",), ("x",), (None,)], "run_id string")
    summary = {r.run_id: (r.artifact_rows, r.feature_rows) for r in catalog.run_summary(runs, kids, kids.limit(0)).collect()}
    assert summary == {"a": (2, 0), "b": (0, 0), "c": (0, 0)}
    assert [r.run_id for r in catalog.orphans(kids, runs, "run_id", "run_id").collect()] == ["x"]
    assert [r.run_id for r in catalog.latest_n(runs, "at", 2).collect()] == ["c", "b"]
