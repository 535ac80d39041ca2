"""Each contract check catches its bad row."""

import pytest
from pyspark.sql import functions as F

from beatloom import schemas
from beatloom.operators import quality
from beatloom.plans.features import FeatureParams, feature_tables


@pytest.fixture(scope="module")
def made(worked_example):
    tables = feature_tables(worked_example, params=FeatureParams(min_rr=3))
    return tables.curated.cache(), tables.window_ml.cache(), tables.record.cache()


def test_good_rows_pass(made, worked_example):
    curated, ml, record = made
    assert quality.misaligned_windows(curated).isEmpty()
    assert quality.bad_coverage(curated).isEmpty()
    assert quality.bad_window_keys(ml).isEmpty()
    assert quality.bad_fractions(record).isEmpty()
    assert quality.bad_derived(ml).isEmpty() and quality.bad_derived(record).isEmpty()
    assert quality.bad_distribution(record).isEmpty()
    assert quality.bad_coverage_rollup(record).isEmpty()
    assert quality.key_parity(curated, ml).isEmpty()
    assert quality.count_mismatches(curated, record, worked_example).isEmpty()
    assert quality.not_one_row(record, record).isEmpty()
    assert quality.window_count_mismatches(worked_example, curated).isEmpty()
    assert quality.missing_columns(ml, "window_features_ml_v1").isEmpty()
    assert quality.schema_mismatches(curated, "window_features_v1", schemas.WINDOW_FEATURES).isEmpty()


def broken(df, **columns):
    return df.withColumns({k: v if hasattr(v, "_jc") else F.lit(v) for k, v in columns.items()})


@pytest.mark.parametrize(
    "table,columns,check",
    [
        (0, {"window_start_sec": 301.0}, quality.misaligned_windows),
        (0, {"window_coverage_sec": -1.0}, quality.bad_coverage),
        (0, {"window_coverage_sec": 301.0}, quality.bad_coverage),
        (0, {"window_is_partial": False}, quality.bad_coverage),
        (1, {"window_start_sec": 300}, quality.bad_window_keys),
        (1, {"pnn50": 1.5}, lambda d: quality.bad_fractions(d, quality.WINDOW_FRACTIONS)),
        (1, {"mean_rr_ms": 0.0}, quality.bad_derived),
        (1, {"heart_rate_bpm": 60.0}, quality.bad_derived),
        (1, {"heart_rate_bpm": float("nan")}, quality.bad_derived),
        (1, {"sdnn_ms": 0.0, "rmssd_sdnn_ratio": 1.0}, quality.bad_derived),
        (1, {"rr_cv": float("inf")}, quality.bad_derived),
        (2, {"rr_range_ms": 1.0}, quality.bad_distribution),
        (2, {"rr_range_ms": -1.0}, quality.bad_distribution),
        (2, {"rr_median_ms": 5000.0}, quality.bad_distribution),
        (2, {"min_window_coverage_sec": 299.0}, quality.bad_coverage_rollup),
        (2, {"valid_window_fraction": -0.1}, quality.bad_fractions),
    ],
)
def test_bad_rows_fail(made, table, columns, check):
    assert not check(broken(made[table], **columns)).isEmpty()


def test_nulls(made):
    curated, ml, _ = made
    nothing = curated.withColumn("window_coverage_sec", F.lit(None).cast("double"))
    assert quality.bad_coverage(nothing).count() == curated.count()
    no_start = ml.withColumn("window_start_sec", F.lit(None).cast("long"))
    assert not quality.bad_window_keys(no_start).isEmpty()
    assert quality.misaligned_windows(no_start).isEmpty()


def test_bpm_off_by_a_thousandth(made):
    ml = made[1]
    off = ml.withColumn("heart_rate_bpm", F.col("heart_rate_bpm") + 1e-3)
    assert quality.bad_derived(off).count() == ml.count()


def test_columns_and_types(made):
    curated, ml, record = made
    missing = quality.missing_columns(record.drop("pnn20"), "record_features_v1").collect()
    assert [m.missing_column for m in missing] == ["pnn20"]
    wrong = quality.schema_mismatches(
        ml.withColumn("window_start_sec", F.col("window_start_sec").cast("double")),
        "window_features_ml_v1", schemas.WINDOW_FEATURES_ML,
    ).collect()
    assert [(w.column, w.declared, w.actual) for w in wrong] == [("window_start_sec", "bigint", "double")]


def test_presence(spark, worked_example):
    listed = worked_example.select("run_id", "record_id").distinct()
    assert quality.untimed_records(worked_example, listed).isEmpty()
    untimed = worked_example.withColumn("t_peak_sec", F.lit(None).cast("double"))
    assert quality.untimed_records(untimed, listed).count() == 2
    assert quality.untimed_records(worked_example.limit(0), listed).count() == 2


def test_across_tables(made, worked_example):
    curated, ml, record = made
    lost = ml.filter("not (record_id = 'R' and window_start_sec = 300)")
    gone = quality.key_parity(curated, lost).collect()
    assert [(g.record_id, g.window_start_sec, g.in_left, g.in_right) for g in gone] == [("R", 300, True, False)]
    assert quality.not_one_row(record.unionAll(record.filter("record_id = 'S'")), record).count() == 1
    assert quality.count_mismatches(curated.filter("record_id = 'R'"), record, worked_example).count() == 1
    assert quality.window_count_mismatches(worked_example, curated.filter("window_start_sec = 0")).count() == 2
    surplus = quality.differing_rows(curated, curated.filter("record_id = 'R'"))
    assert surplus.count() == 2 and surplus.filter("surplus = 1").count() == 2


def test_lifecycle_and_dates(spark):
    rows = spark.createDataFrame(
        [("r", "a", "failed", None, None, None, None), ("r", "b", "running", None, None, None, None)],
        schemas.SERVICE_RUNS,
    )
    assert [r.service for r in quality.unended_failures(rows).collect()] == ["a"]
    dates = spark.createDataFrame([("r", "2024-01-01"), ("r", "2024-01-02"), ("q", "2024-13-01")], "run_id string, run_date string")
    assert [r.run_id for r in quality.several_run_dates(dates).collect()] == ["r"]
    assert [r.run_id for r in quality.bad_run_dates(dates).collect()] == ["q"]
