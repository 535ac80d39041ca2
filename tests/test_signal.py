"""Waveform ingest, sampling rates, detection and intervals."""

import math
import random

import pytest
from pyspark.sql import functions as F

from beatloom import schemas
from beatloom.operators import signal
from beatloom.sources.waveforms import ingest_waveforms, waveform_quality

KEYS = ["record_id"]


def waveforms(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.WAVEFORMS)


def leads(df):
    return [(r.sample_index, r.t_sec, r.lead_0, r.lead_1) for r in df.orderBy("sample_index").collect()]


def test_ingest_two_leads_and_slicing(spark):
    two = waveforms(spark, ("two", 2.0, [[0.0, 1.0, 0.0, -1.0], [5.0, 6.0, 7.0, 8.0]], True))
    full = ingest_waveforms(two, "r", "2024-01-01")
    assert leads(full) == [(0, 0.0, 0.0, 5.0), (1, 0.5, 1.0, 6.0), (2, 1.0, 0.0, 7.0), (3, 1.5, -1.0, 8.0)]
    assert [(f.name, f.dataType) for f in full.schema] == [(f.name, f.dataType) for f in schemas.RAW_ECG]
    assert ingest_waveforms(two, "r", "2024-01-01", 1).count() == 2
    for off in (0, -3, None, "x", "", "1.5"):
        assert ingest_waveforms(two, "r", "2024-01-01", off).count() == 4
    q = waveform_quality(two, "r", 1).first()
    assert (q.sampling_hz, q.n_samples, q.n_channels, q.atr_exists) == (2, 2, 2, True)


def test_ingest_one_and_three_leads(spark):
    rows = waveforms(
        spark,
        ("one", 2.9, [[0.0, 1.0]], None),
        ("three", 2.0, [[1.0], [2.0], [3.0]], False),
    )
    samples = ingest_waveforms(rows, "r", "2024-01-01")
    assert leads(samples.filter("record_id = 'one'")) == [(0, 0.0, 0.0, 0.0), (1, 0.5, 1.0, 0.0)]
    assert leads(samples.filter("record_id = 'three'")) == [(0, 0.0, 1.0, 2.0)]
    q = {r.record_id: (r.sampling_hz, r.n_channels, r.atr_exists) for r in waveform_quality(rows, "r").collect()}
    assert q == {"one": (2, 1, False), "three": (2, 2, False)}


def test_sampling_rate(spark):
    times = {"a": [0.0, 0.1, 0.1, 0.3, 0.4], "stuck": [1.0, 1.0, 1.0], "single": [4.0]}
    rows = [(r, i, t, 0.0) for r, ts in times.items() for i, t in enumerate(ts)]
    samples = spark.createDataFrame(rows, "record_id string, sample_index long, t_sec double, lead_0 double")
    for block_rows in (2, 1000):
        rates, errors = signal.infer_sampling_rate(samples, KEYS, block_rows)
        assert [(r.record_id, round(r.fs, 6)) for r in rates.collect()] == [("a", 10.0)]
        assert [(e.record_id, e.steps) for e in errors.collect()] == [("stuck", 2)]


def test_even_records_need_no_shuffle_of_samples(spark):
    rows = [("even", i, 3 + i / 250) for i in range(40)]
    rows += [("jitter", i, i / 250 + (0.001 if i % 2 else 0.0)) for i in range(40)]
    rows += [("gap", i if i < 20 else i + 5, i / 250) for i in range(40)]
    rows += [("stuck", i, 1.0) for i in range(3)] + [("single", 0, 0.0)]
    samples = spark.createDataFrame(rows, "record_id string, sample_index long, t_sec double")
    steady, spans = signal.steady_rates(samples, KEYS)
    assert [(r.record_id, round(r.fs, 9)) for r in steady.collect()] == [("even", 250.0)]
    assert spans.count() == 5
    rates, errors = signal.sampling_rates(samples, KEYS)
    inferred, _ = signal.infer_sampling_rate(samples, KEYS)
    expected = {r.record_id: pytest.approx(r.fs) for r in inferred.collect()}
    assert {r.record_id: r.fs for r in rates.collect()} == expected
    assert expected.keys() == {"even", "jitter", "gap"}
    assert [e.record_id for e in errors.collect()] == ["stuck"]
    even = samples.filter("record_id = 'even'")
    assert signal.sampling_rates(even, KEYS)[1].isEmpty()


def test_peaks_to_intervals(spark):
    raw = spark.createDataFrame(
        [("x", p) for p in (20, 5, 5, 13, -1, 40)] + [("y", 7)], "record_id string, peak_index long"
    )
    lengths = spark.createDataFrame([("x", 40), ("y", 40)], "record_id string, n_samples long")
    peaks = signal.sanitize_peaks(raw, lengths, KEYS).withColumn("t_peak_sec", F.col("peak_index") / 10)
    for block_rows in (6, 1000):
        rr = signal.rr_intervals(peaks, KEYS, block_rows)
        x = [tuple(r)[1:] for r in rr.filter("record_id = 'x'").orderBy("beat_index").collect()]
        assert [(b, p, t, rr and round(rr, 6)) for b, p, t, rr in x] == [
            (0, 5, 0.5, None), (1, 13, 1.3, 0.8), (2, 20, 2.0, 0.7)
        ]
    stamped = rr.withColumn("run_id", F.lit("r"))
    listed = spark.createDataFrame([("r", i) for i in "xyz"], "run_id string, record_id string")
    m = {r.record_id: r for r in signal.processing_metrics(stamped, listed).collect()}
    assert m["x"].n_beats == 3
    assert m["x"].mean_rr_ms == pytest.approx(750) and m["x"].sdnn_ms == pytest.approx(70.710678)
    assert (m["y"].n_beats, m["y"].mean_rr_ms, m["y"].sdnn_ms) == (1, None, None)
    assert (m["z"].n_beats, m["z"].mean_rr_ms, m["z"].sdnn_ms) == (0, None, None)


def recording(record, fs, seconds, beats, noise=0.0, wander=0.0, t_wave=0.25, seed=0):
    """A spike of 40 ms per beat, a T-wave bump after it, drift and noise."""
    rng = random.Random(seed)
    x = [wander * math.sin(0.6 * i / fs) + rng.gauss(0, noise) for i in range(int(fs * seconds))]
    for b in beats:
        half = max(1, round(0.02 * fs))
        for k in range(-half, half + 1):
            if 0 <= b + k < len(x):
                x[b + k] += 1 - abs(k) / (half + 1)
        for k in range(round(0.15 * fs), round(0.35 * fs)):
            if 0 <= b + k < len(x):
                x[b + k] += t_wave * math.sin(math.pi * (k / fs - 0.15) / 0.2)
    return [(record, i, i / fs, v) for i, v in enumerate(x)]


def irregular(fs, seconds, seed):
    rng, at, beats = random.Random(seed), 0.8, []
    while at < seconds - 0.8:
        beats.append(round(at * fs))
        at += rng.uniform(0.55, 1.2)
    return beats


@pytest.fixture(scope="module")
def recordings(spark):
    planted = {"a": irregular(360, 90, 1), "b": irregular(250, 120, 2), "c": irregular(360, 70, 3)}
    rows = recording("a", 360, 90, planted["a"], wander=0.5)
    rows += recording("b", 250, 120, planted["b"], wander=0.3, noise=0.01, seed=5)
    rows += recording("c", 360, 70, planted["c"], t_wave=0.4, noise=0.01, seed=6)
    rows += [("flat", i, i / 360, 0.0) for i in range(5000)] + [("short", 0, 0.0, 1.0)]
    samples = spark.createDataFrame(
        rows, "record_id string, sample_index long, t_sec double, lead_0 double"
    )
    return samples.repartition(6), planted


def test_detector_finds_planted_beats(recordings):
    samples, planted = recordings
    rr, errors = signal.beats_from_samples(samples, KEYS)
    found = {}
    for r in rr.collect():
        found.setdefault(r.record_id, []).append(r.peak_index)
    assert errors.isEmpty()
    assert found.keys() == planted.keys()
    for record, beats in planted.items():
        got = sorted(found[record])
        assert len(got) == len(beats)
        assert max(abs(g - b) for g, b in zip(got, beats)) <= 4


def test_segmentation_does_not_change_peaks(recordings):
    samples, _ = recordings
    rates, _ = signal.infer_sampling_rate(samples, KEYS)
    rates = rates.cache()
    whole = signal.detect_peaks(samples, rates, KEYS, segment_samples=10_000_000)
    cut = signal.detect_peaks(samples, rates, KEYS, segment_samples=1)
    assert whole.count() > 0
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, cut.collect()))


def plain_beats(x, widths, fs):
    """The detector sample by sample, on a record reflected at its ends."""
    base, half, refractory, block = widths.in_samples(fs)
    n = len(x)
    at = lambda i: x[min(i % (2 * n - 2), 2 * n - 2 - i % (2 * n - 2))]
    high = {i: (2 * base + 1) * at(i) - sum(at(i + k) for k in range(-base, base + 1)) for i in range(-half - 2, n + half + 2)}
    slope = {i: 2 * high[i + 2] + high[i + 1] - high[i - 1] - 2 * high[i - 2] for i in range(-half, n + half)}
    energy = [sum(slope[i + k] ** 2 for k in range(-half, half + 1)) for i in range(n)]
    top = {}
    for i, e in enumerate(energy):
        top[i // block] = max(e, top.get(i // block, 0))
    limit = {b: max(top.get(b + k, 0) for k in (-1, 0, 1)) for b in top}
    found = [
        i for i in range(1, n - 1)
        if 10 * energy[i] > widths.threshold_tenths * limit[i // block] and high[i - 1] < high[i] >= high[i + 1]
    ]
    return [
        i for i in found
        if all((high[j], -j) <= (high[i], -i) for j in found if abs(i - j) <= refractory)
    ]


def test_peaks_at_ends(spark):
    """Whole numbers, so plain sums are equal to the last digit."""
    rng, widths = random.Random(4), signal.DetectorWidths(10, 2, 7, 50)
    records = {f"r{n}": [rng.randint(-50, 50) for _ in range(n)] for n in (1, 2, 3, 4, 9, 28, 29, 400, 1203)}
    records["start"] = [100 * (i in (3, 60, 117)) for i in range(121)]
    rows = [(r, i, float(i), v) for r, x in records.items() for i, v in enumerate(x)]
    samples = spark.createDataFrame(rows, "record_id string, sample_index long, t_sec double, lead_0 long")
    rates = samples.select("record_id").distinct().withColumn("fs", F.lit(1.0)).cache()
    want = {(r, i) for r, x in records.items() if len(x) > 2 for i in plain_beats(x, widths, 1.0)}
    assert {i for r, i in want if r == "start"} == {3, 60, 117}
    for size in (1, 400, 10_000):
        peaks = signal.detect_peaks(samples, rates, KEYS, widths, size)
        assert {(p.record_id, p.peak_index) for p in peaks.collect()} == want


def test_clean_signal(recordings):
    samples, _ = recordings
    rates, _ = signal.infer_sampling_rate(samples, KEYS)
    rates = rates.cache()
    cleaned = signal.clean_signal(samples, rates, KEYS, segment_samples=1)
    whole = signal.clean_signal(samples, rates, KEYS)
    joined = cleaned.join(whole.withColumnRenamed("cleaned", "w"), [*KEYS, "sample_index"])
    assert cleaned.count() == whole.count() == joined.count()
    assert joined.agg(F.max(F.abs(F.col("cleaned") - F.col("w")))).first()[0] < 1e-9
    drift = joined.filter("record_id = 'a' and sample_index between 200 and 32000")
    assert abs(drift.agg(F.avg("w")).first()[0]) < 0.01
