"""Faults that once lost or kept rows wrongly; each of these failed before it was mended."""

import random

import pytest
from conftest import beat_rows
from pyspark.sql import functions as F
from test_run import DAY, table, waveform
from test_signal import irregular, recording

from beatloom import schemas
from beatloom.functions.quantiles import exact_quantiles
from beatloom.operators import catalog, signal
from beatloom.plans import gates
from beatloom.plans.features import feature_tables
from beatloom.plans.run import Run, RunDateError, run_all, valid_run_date
from beatloom.sinks import tables
from beatloom.sources import waveforms as wf
from beatloom.sources.layers import read_run
from beatloom.streaming.arrivals import BatchError, process_arrivals, waveform_stream


def test_overwrite_by_no_rows_leaves_none(spark, tmp_path):
    root = str(tmp_path)
    where = (root, "ml_ready", "window_features_ml_v1", "o", DAY)
    row = [None] * len(schemas.WINDOW_FEATURES_ML)
    row[:4] = ["o", DAY, "a", 0]
    rows = spark.createDataFrame([tuple(row)], schemas.WINDOW_FEATURES_ML)
    records = spark.createDataFrame([("a",)], "record_id string")
    tables.write_run_level(rows, records, *where)
    assert table(spark, root, *where[1:3], "o").count() == 1
    tables.write_run_level(rows.limit(0), records, *where)
    assert table(spark, root, *where[1:3], "o").count() == 0
    assert tables.is_complete(spark, root, *where[1:])


def test_a_second_run_date_is_refused(spark, tmp_path):
    root = str(tmp_path)
    waves = spark.createDataFrame([waveform("1", 20)], schemas.WAVEFORMS)
    Run(spark, root, "d", DAY).ingest(waves)
    for stage in ("process", "aggregate"):
        with pytest.raises(RunDateError):
            getattr(Run(spark, root, "d", "2024-01-02"), stage)()


@pytest.mark.parametrize("text", ["2024-02-29", "2023-02-29", "2024-1-001", "20240101", "2024-W01-1", "", None])
def test_run_dates(text):
    assert valid_run_date(text) == (text == "2024-02-29")


def samples_with(spark, gaps, fs=120, seconds=60):
    rows = recording("g", fs, seconds, irregular(fs, seconds, 5))
    rows = [(*r[:-1], None if i in gaps else float(r[-1])) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        [("r", DAY, "g", i, i / fs, r[-1]) for i, r in enumerate(rows)],
        "run_id string, run_date string, record_id string, sample_index long, t_sec double, lead_0 double",
    )


def test_missing_samples_cost_no_other_beats(spark):
    def beats(gaps, **kw):
        samples = samples_with(spark, gaps)
        rates = spark.createDataFrame([("r", DAY, "g", 120.0)], "run_id string, run_date string, record_id string, fs double")
        return {r.peak_index for r in signal.detect_peaks(samples, rates, **kw).collect()}

    whole = beats(set())
    assert len(whole) > 40
    gap = {5000, 5001, 5002}
    near = {p for p in whole if abs(p - 5001) < 120}
    assert beats(gap) - near == whole - near
    assert beats(gap, segment_samples=2000) == beats(gap)


def test_bad_sampling_rates_fail_their_record_only(spark, tmp_path):
    good = waveform("good", 20)
    rows = [good, ("minus", -5.0, good[2], False), ("huge", 1e9, good[2], False), ("none", None, good[2], False),
            ("twice", 120.0, good[2], False), ("twice", 120.0, good[2], False)]
    waves = spark.createDataFrame(rows, schemas.WAVEFORMS)
    sizes = {r.record_id: r.n_samples for r in wf.waveform_quality(waves, "b", 10).collect()}
    assert (sizes["good"], sizes["minus"], sizes["huge"]) == (1200, 0, len(good[2][0]))
    result = Run(spark, str(tmp_path), "b", DAY).ingest(waves, slice_seconds=10)
    assert (result.records_ok, result.records_failed) == (2, 3)
    ids = {r.record_id for r in table(spark, str(tmp_path), "raw", "ecg", "b").select("record_id").collect()}
    assert ids == {"good", "huge"}


def test_updates_win_over_the_base(spark):
    base = spark.createDataFrame([("k", 5, "old"), ("b", 1, "kept")], "k string, v int, x string")
    updates = spark.createDataFrame([("k", 3, "new"), ("k", 2, "older")], "k string, v int, x string")
    rows = {r.k: r.x for r in catalog.upsert(base, updates, ["k"], "v").collect()}
    assert rows == {"k": "new", "b": "kept"}


def test_stream_takes_any_record_id(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "lake")
    rows = [("a,b", *waveform("x", 20)[1:]), (" c", *waveform("y", 20, seed=2)[1:])]
    spark.createDataFrame(rows, schemas.WAVEFORMS).write.parquet(source)
    process_arrivals(waveform_stream(spark, source), root, "s", DAY, str(tmp_path / "ck")).awaitTermination()
    ids = {r.record_id for r in table(spark, root, "processed", "rr_intervals_v1", "s").collect()}
    assert ids == {"a,b", " c"}


def test_failed_batch_stays_open(spark, tmp_path):
    source, root, ck = (str(tmp_path / n) for n in ("in", "lake", "ck"))
    bad = spark.createDataFrame([("x", -1.0, [[1.0, 2.0]], False)], schemas.WAVEFORMS)
    bad.write.parquet(source)
    for _ in range(2):  # the second start meets the same batch again
        with pytest.raises(Exception, match=BatchError.__name__):
            process_arrivals(waveform_stream(spark, source), root, "f", DAY, ck).awaitTermination()


def test_exact_quantiles_of_any_size(spark):
    rng = random.Random(4)
    rows = [("big", float(rng.randint(0, 40_000))) for _ in range(30_000)] + [("one", 3.0), ("none", None)]
    rows += [("ties", 1.0)] * 500 + [("ties", 2.0)] * 500
    df = spark.createDataFrame(rows, "k string, v double")
    fractions = [0.0, 0.25, 0.5, 0.75, 1.0]
    got = {r.k: r.q for r in exact_quantiles(df, ["k"], "v", fractions, "q", accuracy=50).collect()}

    def want(key):
        values = sorted(v for k, v in rows if k == key)
        return [values[max(0, -(-len(values) * int(f * 100) // 100) - 1)] for f in fractions]

    assert got == {k: want(k) for k in ("big", "one", "ties")}


def test_gates(spark, tmp_path):
    root = str(tmp_path)
    waves = spark.createDataFrame([waveform("1", 40)], schemas.WAVEFORMS)
    run_all(spark, root, "g", DAY, waves)
    assert Run(spark, root, "g", DAY).check().collect() == []
    rr = beat_rows(spark, [("R", i, 10.0 + i, 1.0) for i in range(40)])
    made = feature_tables(rr)
    bad = gates.GateTables(
        rr=rr,
        curated=made.curated.withColumn("window_start_sec", F.col("window_start_sec") + 1),
        window_ml=made.window_ml.withColumn("pnn50", F.lit(1.5)),
        records=made.record.unionByName(made.record).withColumn("rr_median_ms", F.lit(-1.0)),
    )
    found = {(r.gate, r.check) for r in gates.gate_report(bad).collect()}
    assert found == {
        ("B", "misaligned_window"), ("C", "window_fraction"), ("C", "window_parity"),
        ("C", "distribution"), ("C", "not_one_row"), ("C", "interval_count"),
    }
    assert {r.gate for r in gates.gate_report(bad, ["B"]).collect()} == {"B"}
    with pytest.raises(ValueError):
        gates.gate_report(bad, ["X"])


def test_reading_a_run_lists_only_its_files(spark, tmp_path):
    root, rr = str(tmp_path), beat_rows(spark, [("a:1", 0, 1.0, None), ("b", 0, 1.0, None)])
    records = rr.select("record_id").distinct()
    where = (root, "processed", "rr_intervals_v1")
    for run_id in ("odd:run=1", "other", "more"):
        rows = rr.withColumn("run_id", F.lit(run_id))
        tables.write_records(rows, records, *where, run_id, DAY)
    found = read_run(spark, *where, "odd:run=1", DAY)
    assert {r.record_id for r in found.collect()} == {"a:1", "b"}
    assert len(found.inputFiles()) == 2  # not those of the other runs
    # A record that lost its rows goes, whatever its name.
    only_b = rr.filter("record_id = 'b'").withColumn("run_id", F.lit("odd:run=1"))
    tables.write_records(only_b, records, *where, "odd:run=1", DAY)
    assert {r.record_id for r in read_run(spark, *where, "odd:run=1", DAY).collect()} == {"b"}


def test_broken_chunks_fail_their_record(spark, tmp_path):
    x = waveform("x", 20)[2][0]
    half = len(x) // 2
    rows = [("ok", 0, x[:half]), ("ok", half, x[half:]), ("gap", 0, x[:half]), ("gap", half + 1, x[half:]),
            ("twice", 0, x[:half]), ("twice", 0, x[:half]), ("late", 5, x)]
    chunks = spark.createDataFrame(
        [(r, at, 120.0, [part], False) for r, at, part in rows],
        "record_id string, first_sample long, fs double, signal array<array<double>>, has_annotation boolean",
    )
    sizes = {r.record_id: r.n_samples for r in wf.waveform_quality(chunks, "c").collect()}
    assert sizes == {"ok": len(x), "gap": 0, "twice": 0, "late": 0}
    run = Run(spark, str(tmp_path), "c", DAY)
    result = run.ingest(chunks)
    assert (result.records_ok, result.records_failed) == (1, 3)
    raw = table(spark, str(tmp_path), "raw", "ecg", "c").orderBy("sample_index").collect()
    assert [r.lead_0 for r in raw] == x and [r.sample_index for r in raw] == list(range(len(x)))
