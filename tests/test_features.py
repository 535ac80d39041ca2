"""Window and record features on rows worked out by hand."""

import random
import statistics

import pytest
from conftest import beat_rows
from pyspark.sql import functions as F

from beatloom import schemas
from beatloom.functions.ordered import plan_split
from beatloom.operators import quality, rollups, windows
from beatloom.plans.features import FeatureParams, feature_tables

PARAMS = FeatureParams(min_rr=3)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def approx(value):
    return None if value is None else pytest.approx(value, abs=1e-4)


def test_windows(worked_example):
    rows = by_key(
        windows.window_features(worked_example, min_rr=3), "record_id", "window_start_sec"
    )
    expected = {
        ("R", 0.0): (816.6667, 76.3763, 127.4755, 0.6667, 3, 1.65, True, True),
        ("R", 300.0): (750.0, 86.6025, 106.0660, 0.3333, 3, 299.9, True, True),
        ("S", 0.0): (900.0, None, None, 0.0, 1, 0.0, False, True),
        ("S", 300.0): (1000.0, 0.0, 0.0, 0.0, 2, 1.0, False, True),
    }
    assert rows.keys() == expected.keys()
    for key, (mean, sdnn, rmssd, pnn50, n, coverage, valid, partial) in expected.items():
        r = rows[key]
        assert (r.mean_rr_ms, r.sdnn_ms, r.rmssd_ms, r.pnn50, r.window_coverage_sec) == (
            approx(mean), approx(sdnn), approx(rmssd), approx(pnn50), approx(coverage)
        )
        assert (r.n_rr, r.window_valid, r.window_is_partial) == (n, valid, partial)
        assert r.window_end_sec == key[1] + 300.0


def test_records(worked_example):
    made = feature_tables(worked_example, params=PARAMS)
    rows = by_key(made.record, "record_id")
    r, s = rows[("R",)], rows[("S",)]
    assert (r.n_rr, r.mean_rr_ms, r.sdnn_ms, r.rmssd_ms, r.pnn50) == (
        6, approx(783.3333), approx(81.4894), approx(116.7708), approx(0.5)
    )
    assert (r.mean_rr_window_std, r.mean_window_coverage_sec, r.min_window_coverage_sec) == (
        approx(47.1405), approx(150.775), approx(1.65)
    )
    assert (r.sdsd_ms, r.pnn20, r.rr_median_ms, r.rr_iqr_ms) == (
        approx(125.4990), approx(0.8), approx(750.0), approx(150.0)
    )
    assert (s.n_rr, s.mean_rr_ms, s.sdnn_ms, s.rmssd_ms, s.pnn50) == (
        3, approx(966.6667), approx(0.0), approx(0.0), approx(0.0)
    )
    assert (s.mean_rr_window_std, s.mean_window_coverage_sec, s.min_window_coverage_sec) == (
        None, approx(0.5), approx(0.0)
    )
    assert (s.sdsd_ms, s.pnn20, s.rr_median_ms, s.rr_iqr_ms) == (
        approx(70.7107), approx(0.5), approx(1000.0), approx(100.0)
    )
    assert (s.window_count_total, s.window_count_valid, s.valid_window_fraction) == (2, 0, 0.0)
    assert s.partial_window_fraction == 1.0
    assert s.rmssd_sdnn_ratio is None
    assert s.heart_rate_bpm == approx(60000.0 / 966.66667)


def test_schemas(worked_example):
    made = feature_tables(worked_example, params=PARAMS)
    for df, schema in (
        (made.curated, schemas.WINDOW_FEATURES),
        (made.window_ml, schemas.WINDOW_FEATURES_ML),
        (made.record, schemas.RECORD_FEATURES),
    ):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_window_ratio_is_null_without_spread(worked_example):
    ml = by_key(feature_tables(worked_example, params=PARAMS).window_ml, "record_id", "window_start_sec")
    assert ml[("S", 300)].rmssd_sdnn_ratio is None
    assert ml[("S", 300)].rr_cv == 0.0
    assert ml[("S", 0)].rr_cv is None
    assert ml[("R", 0)].heart_rate_bpm == approx(60000 / 816.66667)


def test_null_metric_keeps_its_weight(spark):
    curated = spark.createDataFrame(
        [("r", "d", "x", 80.0, 3), ("r", "d", "x", None, 1)],
        "run_id string, run_date string, record_id string, sdnn_ms double, n_rr long",
    )
    row = curated.groupBy("record_id").agg(rollups._weighted("sdnn_ms").alias("v")).first()
    assert row.v == 60.0


def test_untimed_interval_breaks_the_count_invariant(spark, worked_example):
    extra = beat_rows(spark, [("R", 7, None, 0.8)])
    rr = worked_example.unionByName(extra)
    made = feature_tables(rr, params=PARAMS)
    wrong = quality.rollup_count_mismatches(made.rollups).collect()
    assert [(w.record_id, w.window_n_rr_sum, w.n_rr) for w in wrong] == [("R", 6, 7)]
    found = quality.count_mismatches(made.curated, made.record, rr).collect()
    assert [w.record_id for w in found] == ["R"]


def test_listed_record_without_intervals_has_one_empty_row(spark, worked_example):
    listed = spark.createDataFrame(
        [("r", "2024-01-01", x) for x in "RSZ"], "run_id string, run_date string, record_id string"
    )
    made = feature_tables(worked_example, listed, PARAMS)
    z = by_key(made.record, "record_id")[("Z",)]
    assert (z.n_rr, z.mean_rr_ms, z.sdsd_ms, z.window_count_total) == (None, None, None, None)
    assert quality.rollup_count_mismatches(made.rollups).isEmpty()


def test_ties_need_a_beat_index(spark):
    tied = beat_rows(
        spark, [("R", 1, 1.0, 0.8), ("R", 0, 1.0, 0.5), ("R", 2, 2.0, 1.0), ("R", 3, 2.5, 0.5)]
    )
    with pytest.raises(windows.TiedBeatsError):
        windows.successive_differences(tied.drop("beat_index"))
    diffs = by_key(windows.successive_differences(tied), "beat_index")
    assert diffs[(0,)].diff_ms is None
    assert diffs[(1,)].diff_ms == approx(300.0)
    assert diffs[(2,)].diff_ms == approx(200.0)
    untied = windows.successive_differences(tied.filter("beat_index > 0").drop("beat_index"))
    assert untied.count() == 3


def random_beats(seed, records=4, beats=400):
    rng = random.Random(seed)
    rows = []
    for r in range(records):
        t = rng.uniform(0, 5)
        for b in range(beats * (12 if r == 0 else 1)):
            rr = rng.uniform(0.4, 1.4) if rng.random() > 0.02 else rng.uniform(200, 700)
            t += rr
            rows.append((f"rec{r}", b, t, rr if b else None))
    return rows


@pytest.mark.parametrize("rows_per_segment", [50, 700, 10_000_000])
def test_against_plain_statistics(spark, rows_per_segment):
    """One heavy record; the result does not depend on how it is cut or partitioned."""
    rows = random_beats(7)
    rr = beat_rows(spark, rows).repartition(17)
    timed = rr.select("run_id", "record_id", "t_peak_sec", "beat_index")
    split = plan_split(timed, ["run_id", "record_id"], ["t_peak_sec", "beat_index"], rows_per_segment)
    assert split.cut_any == (rows_per_segment < 10_000)
    made = feature_tables(rr, split=split)
    got_windows = by_key(made.curated, "record_id", "window_start_sec")
    got_records = by_key(made.record, "record_id")

    groups, records = {}, {}
    for record, _, t, interval in rows:
        if interval is not None:
            groups.setdefault((record, t // 300 * 300), []).append((t, interval * 1000))
            records.setdefault((record,), []).append(interval * 1000)
    assert got_windows.keys() == groups.keys()
    for key, beats in groups.items():
        ms = [x for _, x in beats]
        diffs = [b - a for a, b in zip(ms, ms[1:])]
        row = got_windows[key]
        assert row.n_rr == len(ms)
        assert row.mean_rr_ms == pytest.approx(statistics.fmean(ms))
        if len(ms) > 1:
            assert row.sdnn_ms == pytest.approx(statistics.stdev(ms))
            assert row.rmssd_ms == pytest.approx(statistics.fmean(d * d for d in diffs) ** 0.5)
        assert row.pnn50 == pytest.approx(sum(abs(d) > 50 for d in diffs) / len(ms))
    for key, ms in records.items():
        diffs = [b - a for a, b in zip(ms, ms[1:])]
        row = got_records[key]
        assert row.sdsd_ms == pytest.approx(statistics.stdev(diffs))
        assert row.pnn20 == pytest.approx(sum(abs(d) > 20 for d in diffs) / len(diffs))
        assert (row.n_rr, row.rr_min_ms, row.rr_max_ms) == (len(ms), min(ms), max(ms))
        assert row.rr_median_ms == sorted(ms)[(len(ms) + 1) // 2 - 1]
    for bad in (
        quality.misaligned_windows(made.curated), quality.bad_coverage(made.curated),
        quality.bad_window_keys(made.window_ml), quality.bad_fractions(made.record),
        quality.bad_derived(made.window_ml), quality.bad_derived(made.record),
        quality.bad_distribution(made.record), quality.bad_coverage_rollup(made.record),
        quality.count_mismatches(made.curated, made.record, rr),
        quality.key_parity(made.curated, made.window_ml),
    ):
        assert bad.isEmpty()


def test_one_shuffle_of_the_beats(spark, worked_example, tmp_path):
    """Differences, windows and their grouping share a single exchange; the scan is pruned."""
    path = str(tmp_path / "rr")
    worked_example.write.parquet(path)
    plan = windows.window_features(spark.read.parquet(path))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert text.count("Exchange hashpartitioning") == 1
    assert "IsNotNull(rr_interval_sec)" in text and "IsNotNull(t_peak_sec)" in text
    assert "peak_index" not in text


def test_repeated_runs_agree(worked_example):
    first = feature_tables(worked_example, params=PARAMS).record
    second = feature_tables(worked_example.repartition(4), params=PARAMS).record
    rounded = [
        df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
        for df in (first, second)
    ]
    assert quality.differing_rows(*rounded).isEmpty()
