"""Stages over layer tables: skips, overwrites, partial outputs, failures and lineage."""

import os

import pytest
from conftest import beat_rows
from pyspark.sql import functions as F
from test_signal import irregular, recording

from beatloom import schemas
from beatloom.operators import quality
from beatloom.plans.run import CountInvariantError, NoInputError, Run, RunDateError, run_all
from beatloom.sinks import tables
from beatloom.sinks.metadata import Metadata
from beatloom.sources.layers import read_layer, read_record_files, read_rr, read_run
from beatloom.sources.records import RecordFilterError

DAY = "2024-01-01"


def waveform(record, seconds=40, seed=1, fs=120):
    x = [v for *_, v in recording(record, fs, seconds, irregular(fs, seconds, seed))]
    return (record, float(fs), [x, [0.5] * len(x)], True)


@pytest.fixture(scope="module")
def waves(spark):
    flat = ("flat", 120.0, [[0.0] * 2000], False)
    rows = [waveform("100", seed=1), waveform("101", seed=2), flat]
    return spark.createDataFrame(rows, schemas.WAVEFORMS).cache()


@pytest.fixture(scope="module")
def done(spark, waves, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    return root, run_all(spark, root, "r1", DAY, waves)


def service_state(spark, root, run_id, service):
    rows = Metadata(spark, root).current("service_runs")
    return rows.filter((F.col("run_id") == run_id) & (F.col("service") == service)).first()


def table(spark, root, layer, artifact, run_id="r1"):
    return read_run(spark, root, layer, artifact, run_id, DAY)


def test_full_run(spark, done):
    root, results = done
    assert [(r.service, r.status) for r in results] == [
        ("ingestion", "succeeded"), ("processing", "succeeded"), ("aggregation", "succeeded")
    ]
    assert (results[2].records_total, results[2].record_rows) == (3, 3)
    meta = Metadata(spark, root)
    assert meta.current("runs").first().status == "succeeded"
    for service in ("processing", "aggregation"):
        row = service_state(spark, root, "r1", service)
        assert row.status == "succeeded" and row.started_at and row.ended_at
    quality_rows = {r.record_id: r for r in meta.current("quality_metrics").collect()}
    assert (quality_rows["100"].n_channels, quality_rows["flat"].n_channels) == (2, 1)
    metrics = {r.record_id: r.n_beats for r in meta.current("processing_metrics").collect()}
    assert metrics["flat"] == 0 and metrics["100"] > 30
    kinds = meta.current("artifacts").groupBy("layer", "artifact_type").count().collect()
    assert {(k.layer, k.artifact_type): k["count"] for k in kinds} == {
        ("raw", "ecg"): 3, ("processed", "rr_intervals_v1"): 3,
        ("curated", "window_features_v1"): 2, ("ml_ready", "window_features_ml_v1"): 3,
        ("ml_ready", "record_features_v1"): 3,
    }
    assert meta.current("artifacts").filter("uri like '%://%'").isEmpty()


def test_outputs_meet_the_contract(spark, done):
    root, _ = done
    rr = read_rr(spark, root, "r1", DAY)
    curated = table(spark, root, "curated", "window_features_v1")
    ml = table(spark, root, "ml_ready", "window_features_ml_v1")
    record = table(spark, root, "ml_ready", "record_features_v1")
    # The identifiers look like a number and a date, and stay strings.
    assert dict(rr.dtypes)["record_id"] == "string" and dict(rr.dtypes)["run_date"] == "string"
    assert sorted(r.record_id for r in record.collect()) == ["100", "101", "flat"]
    assert record.filter("record_id = 'flat'").first().n_rr is None
    for bad in (
        quality.misaligned_windows(curated), quality.bad_coverage(curated),
        quality.bad_window_keys(ml), quality.bad_fractions(record), quality.bad_derived(record),
        quality.bad_distribution(record), quality.bad_coverage_rollup(record),
        quality.key_parity(curated, ml), quality.count_mismatches(curated, record, rr),
        quality.not_one_row(record, record), quality.window_count_mismatches(rr, curated),
        quality.version_mismatches(Metadata(spark, root).current("artifacts")),
        quality.unended_failures(Metadata(spark, root).current("service_runs")),
    ):
        assert bad.isEmpty()
    shown = tables.preview(ml, "r1", "100", 1).collect()
    assert len(shown) == 1 and shown[0].window_start_sec == 0
    assert tables.preview(ml, "r1", "100", -1).count() == 0
    with pytest.raises(tables.NoRowsError):
        tables.preview(ml, "r1", "999")


def test_rerun_skips(spark, done, waves):
    root, _ = done
    before = read_layer(spark, root, "ml_ready", "record_features_v1").agg(F.max("created_at")).first()
    results = run_all(spark, root, "r1", DAY, waves)
    assert [(r.status, r.records_ok, r.records_skipped) for r in results[:2]] == [
        ("succeeded", 0, 3), ("succeeded", 0, 3)
    ]
    assert results[2].status == "succeeded" and "skipped" in results[2].notes
    after = read_layer(spark, root, "ml_ready", "record_features_v1").agg(F.max("created_at")).first()
    assert before == after


def test_states(tmp_path):
    skip, run = tables.OutputState.SKIP, tables.OutputState.RUN
    assert tables.output_state(True, True, False) is skip
    assert tables.output_state(False, False, False) is run
    for pair in ((True, False), (False, True)):
        with pytest.raises(tables.PartialOutputError):
            tables.output_state(*pair, False)
    for pair in ((True, True), (True, False), (False, False)):
        assert tables.output_state(*pair, True) is run


def small_rr(spark, run_id, records=("a", "b")):
    rows = [(r, b, 0.8 * b + 1, 0.8 if b else None) for r in records for b in range(500)]
    return beat_rows(spark, rows, run_id, DAY)


def seeded(spark, root, run_id, rr):
    """A run whose intervals are already there."""
    run = Run(spark, root, run_id, DAY)
    records = rr.select("record_id").distinct()
    tables.write_records(rr, records, root, "processed", "rr_intervals_v1", run_id, DAY)
    run._register(records, "processed", "rr_intervals_v1", "x")
    return run


def test_partial_output_fails_until_overwritten(spark, tmp_path):
    root = str(tmp_path)
    assert seeded(spark, root, "p", small_rr(spark, "p")).aggregate().status == "succeeded"
    os.remove(f"{root}/ml_ready/record_features_v1/run_date={DAY}/run_id=p/_SUCCESS")
    with pytest.raises(tables.PartialOutputError):
        Run(spark, root, "p", DAY).aggregate()
    state = service_state(spark, root, "p", "aggregation")
    assert state.status == "failed" and state.ended_at is not None
    assert Run(spark, root, "p", DAY, overwrite=True).aggregate().status == "succeeded"
    assert service_state(spark, root, "p", "aggregation").ended_at == state.ended_at


def test_subset_overwrite_keeps_other_records(spark, tmp_path):
    root = str(tmp_path)
    seeded(spark, root, "s", small_rr(spark, "s")).aggregate()
    old = {r.record_id: r.created_at for r in table(spark, root, "ml_ready", "record_features_v1", "s").collect()}
    result = Run(spark, root, "s", DAY, overwrite=True, ids="b").aggregate()
    assert result.records_total == 1
    new = {r.record_id: r.created_at for r in table(spark, root, "ml_ready", "record_features_v1", "s").collect()}
    assert new.keys() == {"a", "b"} and new["a"] == old["a"] and new["b"] > old["b"]
    windows = table(spark, root, "ml_ready", "window_features_ml_v1", "s")
    assert quality.bad_window_keys(windows).isEmpty() and windows.count() == 4


def test_emptied_record_loses_its_rows(spark, tmp_path):
    root = str(tmp_path)
    rr = small_rr(spark, "e")
    seeded(spark, root, "e", rr)
    records = rr.select("record_id").distinct()
    tables.write_records(
        rr.filter("record_id = 'a'"), records, root, "processed", "rr_intervals_v1", "e", DAY
    )
    assert {r.record_id for r in read_rr(spark, root, "e", DAY).select("record_id").collect()} == {"a"}


def test_invariant_stops_before_anything_is_published(spark, tmp_path):
    root = str(tmp_path)
    rr = small_rr(spark, "i").withColumn(
        "t_peak_sec", F.when(F.col("beat_index") != 7, F.col("t_peak_sec"))
    )
    run = seeded(spark, root, "i", rr)
    with pytest.raises(CountInvariantError, match="2 records") as failure:
        run.aggregate()
    offenders = failure.value.offenders.collect()
    assert {(r.record_id, r.window_n_rr_sum, r.n_rr) for r in offenders} >= {("a", 498, 499)}
    assert table(spark, root, "curated", "window_features_v1", "i").isEmpty()
    assert service_state(spark, root, "i", "aggregation").status == "failed"


def test_missing_inputs_and_filters(spark, tmp_path, waves):
    root = str(tmp_path)
    with pytest.raises(NoInputError):
        Run(spark, root, "n", DAY).aggregate()
    assert service_state(spark, root, "n", "aggregation").status == "failed"
    assert Run(spark, root, "n", DAY).process().status == "succeeded"
    with pytest.raises(RecordFilterError):
        Run(spark, root, "n", DAY, ids="x").process()
    with pytest.raises(RecordFilterError):
        seeded(spark, root, "m", small_rr(spark, "m"))
        Run(spark, root, "m", DAY, ids="nothing").aggregate()
    with pytest.raises(RunDateError):
        Run(spark, root, "n", "2024-1-001")
    with pytest.raises(ValueError):
        Run(spark, root, " ", DAY)


def test_broken_records_do_not_stop_the_others(spark, tmp_path, waves):
    root = str(tmp_path)
    result = Run(spark, root, "b", DAY, ids="100,404").ingest(waves)
    assert (result.status, result.records_ok, result.records_failed) == ("partial_success", 1, 1)
    assert Metadata(spark, root).current("runs").first().status == "partial_success"
    failed = Run(spark, root, "c", DAY, ids="404").ingest(waves)
    assert failed.status == "failed"
    broken = spark.createDataFrame([("z", 0.0, [[1.0]], True)], schemas.WAVEFORMS)
    assert Run(spark, root, "d", DAY).ingest(broken).status == "failed"


def test_per_record_file_layout(spark, tmp_path):
    rr = small_rr(spark, "f", ("100", "0101"))
    for record in ("100", "0101"):
        path = f"{tmp_path}/processed/run_date={DAY}/run_id=f/record_id={record}/rr_intervals_v1.parquet"
        rr.filter(F.col("record_id") == record).write.parquet(path)
    got = read_record_files(spark, str(tmp_path), "processed", "rr_intervals_v1")
    assert quality.differing_rows(got, rr).isEmpty()
