"""Fixed values of the data contract; every operator takes them as keyword defaults."""

# Feature definitions.
WINDOW_SEC = 300.0
MIN_RR_PER_WINDOW = 30
PARTIAL_EPSILON_SEC = 1e-6
PNN50_MS = 50.0
PNN20_MS = 20.0
PERCENTILE_ACCURACY = 10000  # of the sketch that brackets a quantile
MS_PER_MINUTE = 60000.0

# Layers and artifact names.
RAW = "raw"
PROCESSED = "processed"
CURATED = "curated"
ML_READY = "ml_ready"
LEGACY_LAYER = "processing"
ECG = "ecg"
RAW_SCHEMA_VER = "raw_ecg_v1"
RR_INTERVALS = "rr_intervals_v1"
WINDOW_FEATURES = "window_features_v1"
WINDOW_FEATURES_ML = "window_features_ml_v1"
RECORD_FEATURES = "record_features_v1"

# Run states and service names.
RUNNING = "running"
SUCCEEDED = "succeeded"
PARTIAL_SUCCESS = "partial_success"
FAILED = "failed"
INGESTION = "ingestion"
PROCESSING = "processing"
AGGREGATION = "aggregation"

# Business keys of the metadata tables.
RUN_KEY = ["run_id"]
ARTIFACT_KEY = ["run_id", "record_id", "layer", "artifact_type"]
RECORD_KEY = ["run_id", "record_id"]
SERVICE_KEY = ["run_id", "service"]

RECORD_COLS = ["run_id", "run_date", "record_id"]
WINDOW_KEY = ["run_id", "record_id", "window_start_sec"]
