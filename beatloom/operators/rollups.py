"""Windows and intervals -> one feature row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom import schemas
from beatloom.functions import hrv
from beatloom.functions.quantiles import exact_quantiles
from beatloom.operators.windows import with_derived_ratios, with_rr_ms


def _weighted(metric: str) -> Column:
    """Mean weighted by `n_rr`. A NULL metric adds nothing above but its weight stays below."""
    return hrv.guarded_ratio(F.sum(F.col(metric) * F.col("n_rr")), F.sum("n_rr"))


def _spread_over_valid(metric: str) -> Column:
    return F.stddev_samp(F.when(F.col("window_valid"), F.col(metric)))


def weighted_measures() -> list[Column]:
    return [_weighted(m).alias(m) for m in ("mean_rr_ms", "sdnn_ms", "rmssd_ms", "pnn50")]


def coverage_measures() -> list[Column]:
    total, valid = F.count(F.lit(1)), F.count_if(F.col("window_valid"))
    return [
        total.alias("window_count_total"),
        valid.alias("window_count_valid"),
        hrv.guarded_ratio(valid, total).alias("valid_window_fraction"),
        F.avg("window_coverage_sec").alias("mean_window_coverage_sec"),
        F.min("window_coverage_sec").alias("min_window_coverage_sec"),
        F.avg(F.col("window_is_partial").cast("double")).alias("partial_window_fraction"),
    ]


def stability_measures() -> list[Column]:
    return [
        _spread_over_valid("mean_rr_ms").alias("mean_rr_window_std"),
        _spread_over_valid("sdnn_ms").alias("sdnn_window_std"),
        _spread_over_valid("rmssd_ms").alias("rmssd_window_std"),
    ]


def rollup_measures() -> list[Column]:
    return [
        F.sum("n_rr").alias("window_n_rr_sum"),
        *weighted_measures(), *stability_measures(), *coverage_measures(),
    ]


def record_window_rollup(curated: DataFrame) -> DataFrame:
    """Weighted means, counts, coverage and stability of a record's windows."""
    return curated.groupBy(*K.RECORD_COLS).agg(*rollup_measures())


def rr_distribution(rr: DataFrame, accuracy: int = K.PERCENTILE_ACCURACY) -> DataFrame:
    """Count, range, exact median and inter-quartile range of all intervals, timed or not."""
    low, high = F.min("rr_ms"), F.max("rr_ms")
    measured = exact_quantiles(
        with_rr_ms(rr), K.RECORD_COLS, "rr_ms", [0.25, 0.5, 0.75], "_q", accuracy,
        beside=[
            F.count("rr_ms").alias("n_rr"), low.alias("rr_min_ms"), high.alias("rr_max_ms"),
            (high - low).alias("rr_range_ms"),
        ],
    )
    return (
        measured.withColumn("rr_median_ms", F.get("_q", F.lit(1)))
        .withColumn("rr_iqr_ms", F.get("_q", F.lit(2)) - F.get("_q", F.lit(0)))
        .drop("_q")
    )


def rr_irregularity(diffs: DataFrame, pnn20_ms: float = K.PNN20_MS) -> DataFrame:
    """Deviation and share of large successive differences, from beat-level differences."""
    diff = F.col("diff_record_ms")
    return diffs.groupBy(*K.RECORD_COLS).agg(
        F.stddev_samp(diff).alias("sdsd_ms"),
        hrv.guarded_ratio(F.sum(hrv.exceeds(diff, pnn20_ms)), F.count(diff)).alias("pnn20"),
    )


def irregularity_measures() -> list[Column]:
    """The same measures merged from the per-window partial sums of `window_summary`.

    Squared deviations add up as a within-window plus a between-window part. Differences telescope,
    so window means are tiny next to the deviations and the second part loses no precision.
    """
    n, mean = F.col("_diff_n"), F.col("_diff_mean")
    total, shifted = F.sum(n), F.sum(n * mean)
    within = F.sum(n * F.col("_diff_var"))
    between = F.greatest(F.sum(n * mean * mean) - shifted * shifted / total, F.lit(0.0))
    return [
        F.when(total > 1, F.sqrt((within + between) / (total - 1))).alias("sdsd_ms"),
        hrv.guarded_ratio(F.sum("_diff_above"), total).alias("pnn20"),
    ]


def window_counts(curated: DataFrame) -> DataFrame:
    """Windows per record."""
    return curated.groupBy(*K.RECORD_COLS).agg(F.count(F.lit(1)).alias("windows"))


def rr_features(rr: DataFrame, irregularity: DataFrame) -> DataFrame:
    """Distribution and irregularity of a record's intervals side by side."""
    return rr_distribution(rr).join(irregularity, K.RECORD_COLS, "left")


def record_rollups(rr: DataFrame, summary: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Every listed record with its window roll-up and interval features.

    `records` (run_id, run_date, record_id) defaults to the records of `rr`. A record without
    intervals keeps one row of NULLs. The summary is grouped once for all its measures; all sides
    are grouped by the same keys, so the joins meet small, equally partitioned tables.
    """
    listed = (rr if records is None else records).select(*K.RECORD_COLS).distinct()
    merged = summary.groupBy(*K.RECORD_COLS).agg(*rollup_measures(), *irregularity_measures())
    return listed.join(merged, K.RECORD_COLS, "left").join(
        rr_distribution(rr), K.RECORD_COLS, "left"
    )


def record_features(rollups: DataFrame) -> DataFrame:
    """The record-level modelling table from `record_rollups`."""
    return (
        with_derived_ratios(rollups)
        .withColumn("created_at", F.current_timestamp())
        .select(*schemas.RECORD_FEATURES.fieldNames())
    )
