"""Beat intervals -> fixed-width windows of heart-rate-variability features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.functions import hrv
from beatloom.functions.ordered import (
    ROWS_PER_SEGMENT,
    Split,
    drop_segments,
    plan_split,
    time_split,
    with_previous,
)


class TiedBeatsError(ValueError):
    """Beats share a time and there is no column that orders them."""


def with_rr_ms(rr: DataFrame) -> DataFrame:
    """Rows that end an interval, with its length in milliseconds. No outlier filter."""
    return rr.filter(F.col("rr_interval_sec").isNotNull()).withColumn("rr_ms", hrv.rr_ms())


def assign_window(df: DataFrame, width_sec: float = K.WINDOW_SEC) -> DataFrame:
    """Timed rows with the start and end of their window; the closing beat decides."""
    return (
        df.filter(F.col("t_peak_sec").isNotNull())
        .withColumn("window_start_sec", hrv.window_start("t_peak_sec", width_sec))
        .withColumn("window_end_sec", F.col("window_start_sec") + F.lit(float(width_sec)))
    )


def tied_beats(df: DataFrame) -> DataFrame:
    """Beat times of a record that occur more than once."""
    return (
        df.filter(F.col("rr_interval_sec").isNotNull() & F.col("t_peak_sec").isNotNull())
        .groupBy(*K.RECORD_KEY, "t_peak_sec")
        .count()
        .filter(F.col("count") > 1)
    )


def assert_orderable(rr: DataFrame) -> None:
    if "beat_index" not in rr.columns and not tied_beats(rr).isEmpty():
        raise TiedBeatsError("t_peak_sec ties without a beat_index to order them")


def _beat_order(rr: DataFrame) -> list[str]:
    return ["t_peak_sec", *(["beat_index"] if "beat_index" in rr.columns else [])]


def plan_beat_split(rr: DataFrame, rows_per_segment: int = ROWS_PER_SEGMENT) -> Split:
    """Measure an interval table and cut its heavy records by rows, for series without a highest rate."""
    timed, order = rr.filter(F.col("t_peak_sec").isNotNull()), _beat_order(rr)
    return plan_split(timed.select(*K.RECORD_KEY, *order), K.RECORD_KEY, order, rows_per_segment)


def successive_differences(
    rr: DataFrame,
    width_sec: float = K.WINDOW_SEC,
    split: Split | None = None,
    seconds: float | None = None,
) -> DataFrame:
    """Interval rows with `rr_ms`, window bounds and both kinds of successive difference.

    `diff_record_ms` looks back over the record and `diff_ms` only within the window. Windows are
    contiguous in beat order, so one look-back per record serves both: the window difference is
    the record difference, kept where the previous beat lies in the same window. Without a `split` a record
    is cut every `seconds`, or where it is found to be heavy.
    """
    assert_orderable(rr)
    if split is None:
        split = time_split(K.RECORD_KEY, _beat_order(rr), seconds) if seconds else plan_beat_split(rr)
    timed = assign_window(with_rr_ms(rr), width_sec)
    seen = with_previous(
        timed, split, {"_prev_rr_ms": "rr_ms", "_prev_start_sec": "window_start_sec"}
    )
    diff = F.col("rr_ms") - F.col("_prev_rr_ms")
    same_window = F.col("_prev_start_sec") == F.col("window_start_sec")
    return drop_segments(
        seen.withColumns({"diff_record_ms": diff, "diff_ms": F.when(same_window, diff)}).drop(
            "_prev_rr_ms", "_prev_start_sec"
        )
    )


def window_summary(
    diffs: DataFrame,
    width_sec: float = K.WINDOW_SEC,
    min_rr: int = K.MIN_RR_PER_WINDOW,
    pnn50_ms: float = K.PNN50_MS,
    pnn20_ms: float = K.PNN20_MS,
) -> DataFrame:
    """One row per window: its features plus the partial sums the record roll-up merges.

    The `_diff_*` columns summarise `diff_record_ms` so that the beat-level rows are shuffled and
    sorted once for windows and records together.
    """
    step, near = F.col("diff_ms"), F.col("diff_record_ms")
    return window_quality(
        diffs.groupBy(*K.RECORD_COLS, "window_start_sec", "window_end_sec").agg(
            F.avg("rr_ms").alias("mean_rr_ms"),
            F.stddev_samp("rr_ms").alias("sdnn_ms"),
            F.sqrt(F.avg(step * step)).alias("rmssd_ms"),
            F.avg(hrv.exceeds(step, pnn50_ms)).alias("pnn50"),
            F.count("rr_ms").alias("n_rr"),
            F.min("t_peak_sec").alias("_first_sec"),
            F.max("t_peak_sec").alias("_last_sec"),
            F.count(near).alias("_diff_n"),
            F.avg(near).alias("_diff_mean"),
            F.var_pop(near).alias("_diff_var"),
            F.sum(hrv.exceeds(near, pnn20_ms)).alias("_diff_above"),
        ),
        width_sec,
        min_rr,
    )


def window_quality(
    df: DataFrame, width_sec: float = K.WINDOW_SEC, min_rr: int = K.MIN_RR_PER_WINDOW
) -> DataFrame:
    """Validity, observed beat span and partial flag from `n_rr`, `_first_sec`, `_last_sec`."""
    coverage = F.col("_last_sec") - F.col("_first_sec")
    return df.withColumns(
        {
            "window_valid": F.col("n_rr") >= F.lit(min_rr),
            "window_coverage_sec": coverage,
            "window_is_partial": hrv.is_partial(coverage, width_sec),
        }
    ).drop("_first_sec", "_last_sec")


def curated_windows(summary: DataFrame) -> DataFrame:
    """The curated table: `window_summary` without its partial sums."""
    return summary.select(
        *K.RECORD_COLS, "window_start_sec", "window_end_sec",
        "mean_rr_ms", "sdnn_ms", "rmssd_ms", "pnn50", "n_rr",
        "window_valid", "window_coverage_sec", "window_is_partial",
    )


def window_features(rr: DataFrame, split: Split | None = None, width_sec: float = K.WINDOW_SEC,
                    min_rr: int = K.MIN_RR_PER_WINDOW, pnn50_ms: float = K.PNN50_MS) -> DataFrame:
    """Curated window features straight from an interval table."""
    diffs = successive_differences(rr, width_sec, split)
    return curated_windows(window_summary(diffs, width_sec, min_rr, pnn50_ms))


def with_derived_ratios(df: DataFrame) -> DataFrame:
    """Heart rate, coefficient of variation and deviation ratio; NULL where undefined."""
    return df.withColumns(
        {
            "heart_rate_bpm": hrv.heart_rate_bpm(),
            "rr_cv": hrv.rr_cv(),
            "rmssd_sdnn_ratio": hrv.rmssd_sdnn_ratio(),
        }
    )


def window_features_ml(curated: DataFrame) -> DataFrame:
    """Modelling view of the curated windows: a projection, nothing is recomputed."""
    return with_derived_ratios(curated).select(
        *K.RECORD_COLS, F.col("window_start_sec").cast("long").alias("window_start_sec"),
        "mean_rr_ms", "sdnn_ms", "rmssd_ms", "pnn50", "n_rr",
        "heart_rate_bpm", "rr_cv", "rmssd_sdnn_ratio",
        "window_valid", "window_coverage_sec", "window_is_partial",
    )
