"""Contract checks. Each returns the violating rows; an empty result passes.

The row conditions are also available as columns, for reports that flag rows instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatloom import constants as K
from beatloom import schemas
from beatloom.functions.hrv import valid_run_date

# Tolerances of the checks.
ALIGNMENT_TOLERANCE = 1e-9
COVERAGE_TOLERANCE = 1e-6
MEAN_COVERAGE_TOLERANCE = 1e-9
DERIVED_TOLERANCE = 1e-6

REQUIRED_COLUMNS = {
    K.RR_INTERVALS: ["t_peak_sec"],
    K.WINDOW_FEATURES: [
        c for c in schemas.WINDOW_FEATURES.fieldNames() if c not in K.RECORD_COLS
    ],
    K.WINDOW_FEATURES_ML: schemas.WINDOW_FEATURES_ML.fieldNames(),
    K.RECORD_FEATURES: schemas.RECORD_FEATURES.fieldNames(),
}


def _holds(condition: Column) -> Column:
    """A condition that cannot be decided (NULL) counts as not holding."""
    return F.coalesce(condition, F.lit(False))


# --- schema and presence -------------------------------------------------------------------


def missing_columns(df: DataFrame, artifact: str) -> DataFrame:
    missing = [(artifact, c) for c in REQUIRED_COLUMNS[artifact] if c not in df.columns]
    return df.sparkSession.createDataFrame(missing, "artifact string, missing_column string")


def schema_mismatches(df: DataFrame, artifact: str, schema: T.StructType) -> DataFrame:
    """Declared columns that are absent or have another type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema}
    wrong = [
        (artifact, f.name, f.dataType.simpleString(), actual.get(f.name))
        for f in schema
        if actual.get(f.name) != f.dataType.simpleString()
    ]
    return df.sparkSession.createDataFrame(
        wrong, "artifact string, column string, declared string, actual string"
    )


def presence(rr: DataFrame, keys: Sequence[str] = K.RECORD_KEY) -> DataFrame:
    """Rows and timed rows per record."""
    return rr.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count("t_peak_sec").alias("timed_rows")
    )


def untimed_records(rr: DataFrame, records: DataFrame, keys: Sequence[str] = K.RECORD_KEY) -> DataFrame:
    """Listed records without rows, or without any beat time."""
    return (
        records.select(*keys).distinct()
        .join(presence(rr, keys), list(keys), "left")
        .fillna(0, ["rows", "timed_rows"])
        .filter(F.col("timed_rows") == 0)
    )


# --- windows -------------------------------------------------------------------------------


def expected_windows(rr: DataFrame, curated: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    """Per record: windows written, and windows a gap-free record of that length has."""
    last = F.max(F.when(F.col("t_peak_sec").isNotNull(), F.col("t_peak_sec")))
    needed = rr.groupBy(*K.RECORD_KEY).agg(
        (F.floor(last / F.lit(float(width_sec))) + 1).alias("expected_rows")
    )
    written = curated.groupBy(*K.RECORD_KEY).agg(F.count(F.lit(1)).alias("actual_rows"))
    return needed.join(written, K.RECORD_KEY, "left").fillna(0, ["actual_rows"])


def window_count_mismatches(rr: DataFrame, curated: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    return expected_windows(rr, curated, width_sec).filter(
        ~F.col("expected_rows").eqNullSafe(F.col("actual_rows"))
    )


def is_aligned(width_sec: float = K.WINDOW_SEC) -> Column:
    """A start on the grid. NULL starts are the key check's business."""
    start = F.col("window_start_sec")
    return start.isNull() | (F.abs(start % F.lit(float(width_sec))) <= ALIGNMENT_TOLERANCE)


def coverage_ok(width_sec: float = K.WINDOW_SEC) -> Column:
    coverage, partial = F.col("window_coverage_sec"), F.col("window_is_partial")
    return _holds(
        coverage.between(F.lit(0.0), F.lit(width_sec + COVERAGE_TOLERANCE))
        & (partial == (coverage < F.lit(width_sec - K.PARTIAL_EPSILON_SEC)))
    )


def misaligned_windows(curated: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    return curated.filter(~is_aligned(width_sec))


def bad_coverage(curated: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    return curated.filter(~coverage_ok(width_sec))


def window_key_counts(windows: DataFrame) -> DataFrame:
    """Rows per window key, with the start as a whole number."""
    return windows.groupBy(
        *K.RECORD_KEY, F.col("window_start_sec").cast("long").alias("window_start_sec")
    ).agg(F.count(F.lit(1)).alias("rows"))


def bad_window_keys(windows: DataFrame) -> DataFrame:
    """Keys that repeat or have no start."""
    return window_key_counts(windows).filter(
        (F.col("rows") > 1) | F.col("window_start_sec").isNull()
    )


# --- value ranges --------------------------------------------------------------------------


def fractions_ok(columns: Sequence[str]) -> Column:
    """Every set value lies in [0, 1]."""
    ok = F.lit(True)
    for name in columns:
        ok = ok & (F.col(name).isNull() | _holds(F.col(name).between(0.0, 1.0)))
    return ok


RECORD_FRACTIONS = ("pnn50", "pnn20", "valid_window_fraction", "partial_window_fraction")
WINDOW_FRACTIONS = ("pnn50",)


def bad_fractions(df: DataFrame, columns: Sequence[str] = RECORD_FRACTIONS) -> DataFrame:
    return df.filter(~fractions_ok(columns))


def _finite(column: Column) -> Column:
    return ~F.isnan(column) & (F.abs(column) < F.lit(float("inf")))


def derived_ok() -> Column:
    """Derived columns are NULL without a positive denominator, else finite and as defined."""
    mean, sdnn = F.col("mean_rr_ms"), F.col("sdnn_ms")
    bpm, cv, ratio = F.col("heart_rate_bpm"), F.col("rr_cv"), F.col("rmssd_sdnn_ratio")
    rate = F.when(
        _holds(mean > 0),
        _holds(_finite(bpm) & (F.abs(bpm - F.lit(K.MS_PER_MINUTE) / mean) <= DERIVED_TOLERANCE))
        & (cv.isNull() | _finite(cv)),
    ).otherwise(bpm.isNull() & cv.isNull())
    spread = F.when(_holds(sdnn > 0), ratio.isNull() | _finite(ratio)).otherwise(ratio.isNull())
    return rate & spread


def bad_derived(df: DataFrame) -> DataFrame:
    return df.filter(~derived_ok())


def distribution_ok() -> Column:
    """Range is max - min and not negative; the median lies between them. NULLs pass."""
    low, high = F.col("rr_min_ms"), F.col("rr_max_ms")
    width, median = F.col("rr_range_ms"), F.col("rr_median_ms")
    range_ok = (width >= 0) & (F.abs(width - (high - low)) <= DERIVED_TOLERANCE)
    return F.coalesce(range_ok, F.lit(True)) & F.coalesce(
        (low <= median) & (median <= high), F.lit(True)
    )


def bad_distribution(records: DataFrame) -> DataFrame:
    return records.filter(~distribution_ok())


def coverage_rollup_ok(width_sec: float = K.WINDOW_SEC) -> Column:
    low, mean = F.col("min_window_coverage_sec"), F.col("mean_window_coverage_sec")
    return F.coalesce(
        (low >= 0) & (low <= mean) & (mean <= F.lit(width_sec + MEAN_COVERAGE_TOLERANCE)),
        F.lit(True),
    )


def bad_coverage_rollup(records: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    return records.filter(~coverage_rollup_ok(width_sec))


# --- across tables -------------------------------------------------------------------------


def interval_counts(curated: DataFrame, records: DataFrame, rr: DataFrame) -> DataFrame:
    """Per record: intervals summed over windows, in its feature row, and in the interval table."""
    keys = K.RECORD_KEY
    windows = curated.groupBy(*keys).agg(F.sum("n_rr").alias("window_n_rr"))
    rows = records.groupBy(*keys).agg(F.sum("n_rr").alias("record_n_rr"))
    source = rr.groupBy(*keys).agg(F.count("rr_interval_sec").alias("source_n_rr"))
    joined = windows.join(rows, keys, "full").join(source, keys, "full")
    return joined.fillna(0, ["window_n_rr", "record_n_rr", "source_n_rr"])


def rollup_interval_counts(rollups: DataFrame, rr: DataFrame) -> DataFrame:
    """`interval_counts` from `record_rollups`, which has both of its legs already."""
    legs = rollups.select(
        *K.RECORD_KEY, F.col("window_n_rr_sum").alias("window_n_rr"), F.col("n_rr").alias("record_n_rr")
    )
    source = rr.groupBy(*K.RECORD_KEY).agg(F.count("rr_interval_sec").alias("source_n_rr"))
    joined = legs.join(source, K.RECORD_KEY, "full")
    return joined.fillna(0, ["window_n_rr", "record_n_rr", "source_n_rr"])


def counts_agree() -> Column:
    return (F.col("window_n_rr") == F.col("record_n_rr")) & (
        F.col("source_n_rr") == F.col("record_n_rr")
    )


def count_mismatches(curated: DataFrame, records: DataFrame, rr: DataFrame) -> DataFrame:
    return interval_counts(curated, records, rr).filter(~counts_agree())


def rollup_count_mismatches(rollups: DataFrame) -> DataFrame:
    """The same invariant on `record_rollups`, before anything is written."""
    return rollups.select(*K.RECORD_KEY, "window_n_rr_sum", "n_rr").filter(
        F.coalesce("window_n_rr_sum", F.lit(0)) != F.coalesce("n_rr", F.lit(0))
    )


def record_row_counts(records: DataFrame, listed: DataFrame) -> DataFrame:
    """Feature rows of every listed record."""
    rows = records.groupBy(*K.RECORD_KEY).agg(F.count(F.lit(1)).alias("rows"))
    return listed.select(*K.RECORD_KEY).distinct().join(rows, K.RECORD_KEY, "left").fillna(0, ["rows"])


def not_one_row(records: DataFrame, listed: DataFrame) -> DataFrame:
    return record_row_counts(records, listed).filter(F.col("rows") != 1)


def key_parity(left: DataFrame, right: DataFrame, keys: Sequence[str] = K.WINDOW_KEY) -> DataFrame:
    """Keys found on one side only. One grouping over both sides, combined map-side."""
    def side(df: DataFrame, is_left: bool) -> DataFrame:
        columns = [
            F.col(k).cast("long").alias(k) if k == "window_start_sec" else F.col(k) for k in keys
        ]
        return df.select(*columns, F.lit(is_left).alias("_l"), F.lit(not is_left).alias("_r"))

    return (
        side(left, True).unionByName(side(right, False))
        .groupBy(*keys)
        .agg(F.bool_or("_l").alias("in_left"), F.bool_or("_r").alias("in_right"))
        .filter(F.col("in_left") != F.col("in_right"))
    )


def bad_version() -> Column:
    """A canonical artifact whose version differs from its type, or a row of the legacy layer."""
    canonical = F.col("layer").isin(K.PROCESSED, K.CURATED, K.ML_READY)
    return (canonical & ~F.col("schema_ver").eqNullSafe(F.col("artifact_type"))) | (
        F.col("layer") == K.LEGACY_LAYER
    )


def version_mismatches(artifacts: DataFrame) -> DataFrame:
    return artifacts.filter(bad_version())


def unended_failures(service_runs: DataFrame) -> DataFrame:
    return service_runs.filter((F.col("status") == K.FAILED) & F.col("ended_at").isNull())


def differing_rows(first: DataFrame, second: DataFrame, ignore: Sequence[str] = ("created_at",)) -> DataFrame:
    """Rows (with multiplicity) in one result only, for repeated runs on the same input."""
    columns = [c for c in first.columns if c not in ignore]
    counted = (
        first.select(*columns, F.lit(1).alias("_side"))
        .unionByName(second.select(*columns, F.lit(-1).alias("_side")))
        .groupBy(*columns)
        .agg(F.sum("_side").alias("surplus"))
    )
    return counted.filter(F.col("surplus") != 0)


def bad_run_dates(df: DataFrame, column: str = "run_date") -> DataFrame:
    return df.filter(~valid_run_date(F.col(column)))


def several_run_dates(df: DataFrame) -> DataFrame:
    """Runs with more than one date; the window keys assume one."""
    return df.groupBy("run_id").agg(
        F.min("run_date").alias("first_date"), F.max("run_date").alias("last_date")
    ).filter(F.col("first_date") != F.col("last_date"))
