"""Declared schemas of the data and metadata tables."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
INT, BOOL, TIME = T.IntegerType(), T.BooleanType(), T.TimestampType()


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_IDS = {"run_id": STRING, "run_date": STRING, "record_id": STRING}
_HRV = {"mean_rr_ms": DOUBLE, "sdnn_ms": DOUBLE, "rmssd_ms": DOUBLE, "pnn50": DOUBLE}
_DERIVED = {"heart_rate_bpm": DOUBLE, "rr_cv": DOUBLE, "rmssd_sdnn_ratio": DOUBLE}
_QUALITY = {"window_valid": BOOL, "window_coverage_sec": DOUBLE, "window_is_partial": BOOL}

WAVEFORMS = _struct(
    record_id=STRING, fs=DOUBLE, signal=T.ArrayType(T.ArrayType(DOUBLE)), has_annotation=BOOL
)
RAW_ECG = _struct(**_IDS, sample_index=LONG, t_sec=DOUBLE, lead_0=DOUBLE, lead_1=DOUBLE)
RR_INTERVALS = _struct(
    **_IDS, beat_index=LONG, peak_index=LONG, t_peak_sec=DOUBLE, rr_interval_sec=DOUBLE
)
WINDOW_FEATURES = _struct(
    **_IDS, window_start_sec=DOUBLE, window_end_sec=DOUBLE, **_HRV, n_rr=LONG, **_QUALITY
)
WINDOW_FEATURES_ML = _struct(
    **_IDS, window_start_sec=LONG, **_HRV, n_rr=LONG, **_DERIVED, **_QUALITY
)
RECORD_FEATURES = _struct(
    **_IDS, **_HRV, n_rr=LONG, **_DERIVED,
    rr_min_ms=DOUBLE, rr_max_ms=DOUBLE, rr_range_ms=DOUBLE, rr_median_ms=DOUBLE, rr_iqr_ms=DOUBLE,
    sdsd_ms=DOUBLE, pnn20=DOUBLE,
    mean_rr_window_std=DOUBLE, sdnn_window_std=DOUBLE, rmssd_window_std=DOUBLE,
    window_count_total=LONG, window_count_valid=LONG, valid_window_fraction=DOUBLE,
    mean_window_coverage_sec=DOUBLE, min_window_coverage_sec=DOUBLE, partial_window_fraction=DOUBLE,
    created_at=TIME,
)

RUNS = _struct(run_id=STRING, run_date=T.DateType(), status=STRING, notes=STRING, created_at=TIME)
ARTIFACTS = _struct(
    run_id=STRING, record_id=STRING, layer=STRING, artifact_type=STRING, uri=STRING,
    schema_ver=STRING, created_at=TIME,
)
QUALITY_METRICS = _struct(
    run_id=STRING, record_id=STRING, sampling_hz=INT, n_samples=LONG, n_channels=INT,
    atr_exists=BOOL, created_at=TIME,
)
SERVICE_RUNS = _struct(
    run_id=STRING, service=STRING, status=STRING, notes=STRING, created_at=TIME,
    started_at=TIME, ended_at=TIME,
)
PROCESSING_METRICS = _struct(
    run_id=STRING, record_id=STRING, n_beats=INT, mean_rr_ms=DOUBLE, sdnn_ms=DOUBLE, created_at=TIME
)
FEATURES_METRICS = _struct(
    run_id=STRING, record_id=STRING, **_HRV, n_rr=INT, created_at=TIME
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast `df` to exactly the declared columns, order and types."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema])
