"""Column expressions of the feature definitions. All stay inside whole-stage codegen."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from beatloom import constants as K


def rr_ms(rr_interval_sec="rr_interval_sec") -> Column:
    return F.col(rr_interval_sec) * 1000


def window_start(t="t_peak_sec", width_sec: float = K.WINDOW_SEC) -> Column:
    """Start of the fixed-width bin holding `t`, as a double."""
    return F.floor(F.col(t) / F.lit(float(width_sec))) * F.lit(float(width_sec))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """`numerator / denominator`, NULL unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def exceeds(diff: Column, threshold: float) -> Column:
    """1 where the absolute difference is above the threshold, else 0 (also for NULL)."""
    return F.when(F.abs(diff) > F.lit(float(threshold)), 1).otherwise(0)


def heart_rate_bpm() -> Column:
    return guarded_ratio(F.lit(K.MS_PER_MINUTE), F.col("mean_rr_ms"))


def rr_cv() -> Column:
    return guarded_ratio(F.col("sdnn_ms"), F.col("mean_rr_ms"))


def rmssd_sdnn_ratio() -> Column:
    return guarded_ratio(F.col("rmssd_ms"), F.col("sdnn_ms"))


def is_partial(coverage: Column, width_sec: float = K.WINDOW_SEC) -> Column:
    return coverage < F.lit(float(width_sec) - K.PARTIAL_EPSILON_SEC)


def valid_run_date(run_date: Column) -> Column:
    """Exactly ten characters and a real calendar date."""
    parsed = F.try_to_timestamp(run_date, F.lit("yyyy-MM-dd"))
    return F.coalesce((F.length(run_date) == 10) & parsed.isNotNull(), F.lit(False))


def epoch_seconds(ts: str) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    since = F.expr(f"cast({ts} - timestamp_ntz'1970-01-01 00:00:00' as interval second)")
    return since.cast("decimal(20,6)").cast("double")
