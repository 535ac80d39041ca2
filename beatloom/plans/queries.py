"""Registered queries over the given tables, each beside the SQL that states its result."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.functions import hrv
from beatloom.functions.ordered import drop_segments
from beatloom.operators import catalog, quality, rollups, signal, windows
from beatloom.plans import gates, views
from beatloom.plans.gate_metrics import gate_metrics
from beatloom.plans.features import FeatureParams, FeatureTables, feature_tables
from beatloom.session import ensure_checkpoint_dir
from beatloom.sinks import tables
from beatloom.sinks.generations import Publication
from beatloom.sources import waveforms as wf
from beatloom.sources.layers import read_rr, read_run
from beatloom.sources.records import filter_records
from beatloom.streaming.live_windows import end_of_stream, live_windows, publish_windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Event types are records of one-day windows; users are records of one-week windows.
BY_TYPE = FeatureParams(width_sec=86_400.0, min_rr=30, pnn50_ms=600_000.0, pnn20_ms=240_000.0)
BY_USER = FeatureParams(width_sec=604_800.0, min_rr=10, pnn50_ms=600_000.0, pnn20_ms=240_000.0)
RECORD = {BY_TYPE: "event_type", BY_USER: "user_id"}
SMALL_SEGMENTS = 2 * 86_400.0  # seconds: some days of a record
LARGE = 1e6


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name], ORACLES[name] = build, sql
        return build

    return register


def rounded(df: DataFrame, keep: tuple[str, ...] = (), large: float = LARGE) -> DataFrame:
    """Computed doubles to four places, large ones to one: sums differ in the last of their fifteen
    digits with the order of rows, on values from a million on in the places behind the fourth."""
    def shown(c: str) -> Column:
        return F.when(F.abs(c) >= large, F.round(c, 1)).otherwise(F.round(c, 4)).alias(c)

    return df.select(
        [shown(c) if kind == "double" and c not in keep else F.col(c) for c, kind in df.dtypes]
    )


# --- shared SQL ----------------------------------------------------------------------------


def rr_sql(params: FeatureParams) -> str:
    record = f"CAST({RECORD[params]} AS VARCHAR)"
    return f"""WITH beats AS (
  SELECT {record} AS record_id, event_id, epoch_us(ts) / 1e6 AS t FROM events),
rr AS (
  SELECT '{views.RUN_ID}' AS run_id, '{views.RUN_DATE}' AS run_date, record_id,
    row_number() OVER w - 1 AS beat_index, event_id AS peak_index, t AS t_peak_sec,
    t - lag(t) OVER w AS rr_interval_sec
  FROM beats WINDOW w AS (PARTITION BY record_id ORDER BY t, event_id))"""


def diff_sql(params: FeatureParams) -> str:
    width = params.width_sec
    return f"""{rr_sql(params)},
timed AS (
  SELECT *, rr_interval_sec * 1000 AS rr_ms,
    floor(t_peak_sec / {width}) * {width} AS window_start_sec,
    floor(t_peak_sec / {width}) * {width} + {width} AS window_end_sec
  FROM rr WHERE rr_interval_sec IS NOT NULL AND t_peak_sec IS NOT NULL),
d AS (
  SELECT *, rr_ms - lag(rr_ms) OVER (PARTITION BY run_id, record_id
      ORDER BY t_peak_sec, beat_index) AS diff_record_ms,
    rr_ms - lag(rr_ms) OVER (PARTITION BY run_id, record_id, window_start_sec
      ORDER BY t_peak_sec, beat_index) AS diff_ms
  FROM timed)"""


def curated_sql(params: FeatureParams) -> str:
    width = params.width_sec
    return f"""{diff_sql(params)},
measured AS (
  SELECT run_id, run_date, record_id, window_start_sec, window_end_sec,
    avg(rr_ms) AS mean_rr_ms, stddev_samp(rr_ms) AS sdnn_ms,
    sqrt(avg(diff_ms * diff_ms)) AS rmssd_ms,
    avg(CASE WHEN abs(diff_ms) > {params.pnn50_ms} THEN 1 ELSE 0 END) AS pnn50,
    count(rr_ms) AS n_rr, max(t_peak_sec) - min(t_peak_sec) AS window_coverage_sec
  FROM d GROUP BY ALL),
curated AS (
  SELECT *, n_rr >= {params.min_rr} AS window_valid,
    window_coverage_sec < {width} - 1e-6 AS window_is_partial
  FROM measured)"""


def records_sql(params: FeatureParams) -> str:
    return f"""{curated_sql(params)},
rolled AS (
  SELECT run_id, run_date, record_id, sum(n_rr)::BIGINT AS window_n_rr_sum,
    sum(mean_rr_ms * n_rr) / sum(n_rr) AS mean_rr_ms,
    sum(sdnn_ms * n_rr) / sum(n_rr) AS sdnn_ms,
    sum(rmssd_ms * n_rr) / sum(n_rr) AS rmssd_ms,
    sum(pnn50 * n_rr) / sum(n_rr) AS pnn50,
    stddev_samp(CASE WHEN window_valid THEN mean_rr_ms END) AS mean_rr_window_std,
    stddev_samp(CASE WHEN window_valid THEN sdnn_ms END) AS sdnn_window_std,
    stddev_samp(CASE WHEN window_valid THEN rmssd_ms END) AS rmssd_window_std,
    count(*) AS window_count_total,
    count(*) FILTER (WHERE window_valid) AS window_count_valid,
    count(*) FILTER (WHERE window_valid) / count(*) AS valid_window_fraction,
    avg(window_coverage_sec) AS mean_window_coverage_sec,
    min(window_coverage_sec) AS min_window_coverage_sec,
    avg(CAST(window_is_partial AS DOUBLE)) AS partial_window_fraction
  FROM curated GROUP BY run_id, run_date, record_id),
distribution AS (
  SELECT run_id, run_date, record_id, count(rr_ms) AS n_rr, min(rr_ms) AS rr_min_ms,
    max(rr_ms) AS rr_max_ms, max(rr_ms) - min(rr_ms) AS rr_range_ms,
    quantile_disc(rr_ms, 0.5) AS rr_median_ms,
    quantile_disc(rr_ms, 0.75) - quantile_disc(rr_ms, 0.25) AS rr_iqr_ms
  FROM (SELECT *, rr_interval_sec * 1000 AS rr_ms FROM rr WHERE rr_interval_sec IS NOT NULL)
  GROUP BY ALL),
irregularity AS (
  SELECT run_id, run_date, record_id, stddev_samp(diff_record_ms) AS sdsd_ms,
    CASE WHEN count(diff_record_ms) > 0 THEN
      sum(CASE WHEN abs(diff_record_ms) > {params.pnn20_ms} THEN 1 ELSE 0 END)
      / count(diff_record_ms) END AS pnn20
  FROM d GROUP BY ALL),
listed AS (SELECT DISTINCT run_id, run_date, record_id FROM rr),
record AS (
  SELECT l.run_id, l.run_date, l.record_id, w.mean_rr_ms, w.sdnn_ms, w.rmssd_ms, w.pnn50, f.n_rr,
    CASE WHEN w.mean_rr_ms > 0 THEN 60000.0 / w.mean_rr_ms END AS heart_rate_bpm,
    CASE WHEN w.mean_rr_ms > 0 THEN w.sdnn_ms / w.mean_rr_ms END AS rr_cv,
    CASE WHEN w.sdnn_ms > 0 THEN w.rmssd_ms / w.sdnn_ms END AS rmssd_sdnn_ratio,
    f.rr_min_ms, f.rr_max_ms, f.rr_range_ms, f.rr_median_ms, f.rr_iqr_ms, i.sdsd_ms, i.pnn20,
    w.mean_rr_window_std, w.sdnn_window_std, w.rmssd_window_std, w.window_count_total,
    w.window_count_valid, w.valid_window_fraction, w.mean_window_coverage_sec,
    w.min_window_coverage_sec, w.partial_window_fraction
  FROM listed l LEFT JOIN rolled w USING (run_id, run_date, record_id)
  LEFT JOIN distribution f USING (run_id, run_date, record_id)
  LEFT JOIN irregularity i USING (run_id, run_date, record_id))"""


def take(columns: str, table: str) -> str:
    """SELECT list where `name~` asks for four places."""
    parts = [
        f"CASE WHEN abs({c[:-1]}) >= {LARGE} THEN round({c[:-1]}, 1) ELSE round({c[:-1]}, 4) END AS {c[:-1]}" if c.endswith("~") else c for c in columns.split()
    ]
    return f" SELECT {', '.join(parts)} FROM {table}"


CURATED_COLS = (
    "run_id run_date record_id window_start_sec window_end_sec mean_rr_ms~ sdnn_ms~ rmssd_ms~ "
    "pnn50~ n_rr window_valid window_coverage_sec~ window_is_partial"
)
DISTRIBUTION_COLS = (
    "run_id run_date record_id n_rr rr_min_ms~ rr_max_ms~ rr_range_ms~ rr_median_ms~ rr_iqr_ms~"
)
STABILITY_COLS = (
    "run_id run_date record_id mean_rr_window_std~ sdnn_window_std~ rmssd_window_std~"
)
COVERAGE_COLS = (
    "run_id run_date record_id window_count_total window_count_valid valid_window_fraction~ "
    "mean_window_coverage_sec~ min_window_coverage_sec~ partial_window_fraction~"
)
WEIGHTED_COLS = "run_id run_date record_id mean_rr_ms~ sdnn_ms~ rmssd_ms~ pnn50~"
RECORD_COLS_SQL = (
    "run_id run_date record_id mean_rr_ms~ sdnn_ms~ rmssd_ms~ pnn50~ n_rr heart_rate_bpm~ rr_cv~ "
    "rmssd_sdnn_ratio~ rr_min_ms~ rr_max_ms~ rr_range_ms~ rr_median_ms~ rr_iqr_ms~ sdsd_ms~ "
    "pnn20~ mean_rr_window_std~ sdnn_window_std~ rmssd_window_std~ window_count_total "
    "window_count_valid valid_window_fraction~ mean_window_coverage_sec~ "
    "min_window_coverage_sec~ partial_window_fraction~"
)

# --- shared plans --------------------------------------------------------------------------


def differences(spark, sf_dir, params, seconds=None) -> DataFrame:
    rr, split = views.beats(spark, sf_dir, RECORD[params], seconds)
    return windows.successive_differences(rr, params.width_sec, split)


def curated(spark, sf_dir, params, seconds=None) -> DataFrame:
    summary = windows.window_summary(
        differences(spark, sf_dir, params, seconds),
        params.width_sec, params.min_rr, params.pnn50_ms, params.pnn20_ms,
    )
    return windows.curated_windows(summary)


def features(spark, sf_dir, params, seconds=None) -> FeatureTables:
    rr, split = views.beats(spark, sf_dir, RECORD[params], seconds)
    return feature_tables(rr, params=params, split=split)


def record_table(spark, sf_dir, params, seconds=None) -> DataFrame:
    return features(spark, sf_dir, params, seconds).record.drop("created_at")


# --- intervals and differences -------------------------------------------------------------

RR_ROWS = " SELECT record_id, beat_index, peak_index, t_peak_sec, rr_interval_sec FROM rr"


@query("rr_intervals", rr_sql(BY_TYPE) + RR_ROWS)
def _(spark, sf_dir):
    return views.intervals(spark, sf_dir, "event_type").drop("run_id", "run_date")


@query("rr_intervals_segmented", rr_sql(BY_TYPE) + RR_ROWS)
def _(spark, sf_dir):
    return views.intervals(spark, sf_dir, "event_type", SMALL_SEGMENTS).drop("run_id", "run_date")


@query(
    "rr_ms",
    rr_sql(BY_USER) + " SELECT record_id, beat_index, rr_interval_sec * 1000 AS rr_ms FROM rr"
    " WHERE rr_interval_sec IS NOT NULL",
)
def _(spark, sf_dir):
    rr = views.intervals(spark, sf_dir, "user_id")
    return windows.with_rr_ms(rr).select("record_id", "beat_index", "rr_ms")


@query(
    "assign_window",
    "SELECT event_id, epoch_us(ts) / 1e6 AS t_peak_sec,"
    " floor(epoch_us(ts) / 1e6 / 300.0) * 300.0 AS window_start_sec,"
    " floor(epoch_us(ts) / 1e6 / 300.0) * 300.0 + 300.0 AS window_end_sec FROM events",
)
def _(spark, sf_dir):
    events = views.table(spark, sf_dir, "events")
    return windows.assign_window(
        events.select("event_id", hrv.epoch_seconds("ts").alias("t_peak_sec"))
    )


@query("diff_in_window", diff_sql(BY_TYPE) + take("record_id beat_index window_start_sec diff_ms", "d"))
def _(spark, sf_dir):
    return differences(spark, sf_dir, BY_TYPE).select(
        "record_id", "beat_index", "window_start_sec", "diff_ms"
    )


@query("diff_in_record", diff_sql(BY_USER) + take("record_id beat_index diff_record_ms", "d"))
def _(spark, sf_dir):
    return differences(spark, sf_dir, BY_USER).select("record_id", "beat_index", "diff_record_ms")


@query(
    "diffs_segmented",
    diff_sql(BY_TYPE) + take("record_id beat_index window_start_sec diff_ms diff_record_ms", "d"),
)
def _(spark, sf_dir):
    return differences(spark, sf_dir, BY_TYPE, SMALL_SEGMENTS).select(
        "record_id", "beat_index", "window_start_sec", "diff_ms", "diff_record_ms"
    )


@query(
    "tie_check",
    "SELECT record_id, t_peak_sec, count(*) AS ties FROM (SELECT CAST(user_id AS VARCHAR) AS record_id,"
    " floor(epoch_us(ts) / 1e6 / 3600.0) * 3600.0 AS t_peak_sec FROM events)"
    " GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf_dir):
    hourly = views.table(spark, sf_dir, "events").select(
        F.lit(views.RUN_ID).alias("run_id"),
        F.col("user_id").cast("string").alias("record_id"),
        hrv.epoch_seconds("ts").alias("exact_sec"),
        F.lit(1.0).alias("rr_interval_sec"),
    )
    hourly = hourly.withColumn("t_peak_sec", hrv.window_start("exact_sec", 3600.0))
    return windows.tied_beats(hourly).select(
        "record_id", "t_peak_sec", F.col("count").alias("ties")
    )


# --- windows -------------------------------------------------------------------------------


@query("window_features_rrt", curated_sql(BY_TYPE) + take(CURATED_COLS, "curated"))
def _(spark, sf_dir):
    return rounded(curated(spark, sf_dir, BY_TYPE))


@query("window_features_rru", curated_sql(BY_USER) + take(CURATED_COLS, "curated"))
def _(spark, sf_dir):
    return rounded(curated(spark, sf_dir, BY_USER))


@query("window_features_segmented", curated_sql(BY_TYPE) + take(CURATED_COLS, "curated"))
def _(spark, sf_dir):
    return rounded(curated(spark, sf_dir, BY_TYPE, SMALL_SEGMENTS))


@query(
    "window_quality",
    curated_sql(BY_USER) + take(
        "record_id window_start_sec n_rr window_valid window_coverage_sec~ window_is_partial",
        "curated",
    ),
)
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER).select(
        "record_id", "window_start_sec", "n_rr", "window_valid", "window_coverage_sec",
        "window_is_partial",
    )
    return rounded(rows)


@query(
    "window_features_ml",
    curated_sql(BY_USER) + """,
ml AS (SELECT * REPLACE (CAST(window_start_sec AS BIGINT) AS window_start_sec),
  CASE WHEN mean_rr_ms > 0 THEN 60000.0 / mean_rr_ms END AS heart_rate_bpm,
  CASE WHEN mean_rr_ms > 0 THEN sdnn_ms / mean_rr_ms END AS rr_cv,
  CASE WHEN sdnn_ms > 0 THEN rmssd_ms / sdnn_ms END AS rmssd_sdnn_ratio FROM curated)"""
    + take(
        "run_id run_date record_id window_start_sec mean_rr_ms~ sdnn_ms~ rmssd_ms~ pnn50~ n_rr "
        "heart_rate_bpm~ rr_cv~ rmssd_sdnn_ratio~ window_valid window_coverage_sec~ "
        "window_is_partial",
        "ml",
    ),
)
def _(spark, sf_dir):
    return rounded(windows.window_features_ml(curated(spark, sf_dir, BY_USER)))


@query(
    "preview_topk",
    curated_sql(BY_TYPE) + """ SELECT CAST(window_start_sec AS BIGINT) AS window_start_sec, n_rr,
  round(mean_rr_ms, 4) AS mean_rr_ms, round(sdnn_ms, 4) AS sdnn_ms, round(rmssd_ms, 4) AS rmssd_ms,
  round(pnn50, 4) AS pnn50,
  round(CASE WHEN mean_rr_ms > 0 THEN 60000.0 / mean_rr_ms END, 4) AS heart_rate_bpm, window_valid
FROM curated WHERE record_id = 'click' ORDER BY window_start_sec LIMIT 3""",
)
def _(spark, sf_dir):
    ml = windows.window_features_ml(curated(spark, sf_dir, BY_TYPE))
    return rounded(tables.preview(ml, views.RUN_ID, "click", 3), large=float("inf"))


# --- records -------------------------------------------------------------------------------


@query("rollup_weighted", records_sql(BY_USER) + take(WEIGHTED_COLS, "rolled"))
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    return rounded(rows.groupBy(*K.RECORD_COLS).agg(*rollups.weighted_measures()))


@query("rollup_counts_coverage", records_sql(BY_USER) + take(COVERAGE_COLS, "rolled"))
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    return rounded(rows.groupBy(*K.RECORD_COLS).agg(*rollups.coverage_measures()))


@query("rollup_stability", records_sql(BY_USER) + take(STABILITY_COLS, "rolled"))
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    return rounded(rows.groupBy(*K.RECORD_COLS).agg(*rollups.stability_measures()))


@query(
    "window_counts",
    curated_sql(BY_USER) + " SELECT run_id, run_date, record_id, count(*) AS windows FROM curated GROUP BY ALL",
)
def _(spark, sf_dir):
    return rollups.window_counts(curated(spark, sf_dir, BY_USER))


@query("rr_distribution", records_sql(BY_USER) + take(DISTRIBUTION_COLS, "distribution"))
def _(spark, sf_dir):
    return rounded(rollups.rr_distribution(views.intervals(spark, sf_dir, "user_id")))


@query(
    "rr_irregularity",
    records_sql(BY_USER) + take("run_id run_date record_id sdsd_ms~ pnn20~", "irregularity"),
)
def _(spark, sf_dir):
    diffs = differences(spark, sf_dir, BY_USER)
    return rounded(rollups.rr_irregularity(diffs, BY_USER.pnn20_ms))


@query(
    "rr_features",
    records_sql(BY_TYPE) + take(DISTRIBUTION_COLS + " sdsd_ms~ pnn20~",
        "distribution LEFT JOIN irregularity USING (run_id, run_date, record_id)"),
)
def _(spark, sf_dir):
    rr, split = views.beats(spark, sf_dir, "event_type")
    diffs = windows.successive_differences(rr, BY_TYPE.width_sec, split)
    irregular = rollups.rr_irregularity(diffs, BY_TYPE.pnn20_ms)
    return rounded(rollups.rr_features(rr, irregular))


@query("record_features", records_sql(BY_TYPE) + take(RECORD_COLS_SQL, "record"))
def _(spark, sf_dir):
    return rounded(record_table(spark, sf_dir, BY_TYPE))


@query("record_features_sparse", records_sql(BY_USER) + take(RECORD_COLS_SQL, "record"))
def _(spark, sf_dir):
    return rounded(record_table(spark, sf_dir, BY_USER))


@query("record_features_segmented", records_sql(BY_TYPE) + take(RECORD_COLS_SQL, "record"))
def _(spark, sf_dir):
    return rounded(record_table(spark, sf_dir, BY_TYPE, SMALL_SEGMENTS))


@query(
    "processing_metrics",
    rr_sql(BY_USER) + " SELECT run_id, record_id, CAST(count(*) AS INT) AS n_beats,"
    " round(avg(rr_interval_sec) * 1000, 4) AS mean_rr_ms,"
    " round(stddev_samp(rr_interval_sec) * 1000, 4) AS sdnn_ms FROM rr GROUP BY ALL",
)
def _(spark, sf_dir):
    return rounded(signal.processing_metrics(views.intervals(spark, sf_dir, "user_id")), large=float("inf"))


LISTED_SQL = (
    "SELECT 'r1' AS run_id, '2024-01-31' AS run_date, CAST(c_custkey AS VARCHAR) AS record_id FROM customer"
)


def listed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the requested records: users with events among them, and many without."""
    return views.table(spark, sf_dir, "customer").select(
        F.lit(views.RUN_ID).alias("run_id"),
        F.lit(views.RUN_DATE).alias("run_date"),
        F.col("c_custkey").cast("string").alias("record_id"),
    )


@query(
    "processing_metrics_listed",
    rr_sql(BY_USER) + f""", listed AS ({LISTED_SQL}),
m AS (SELECT run_id, record_id, count(*) AS n, avg(rr_interval_sec) * 1000 AS mean_rr_ms,
  stddev_samp(rr_interval_sec) * 1000 AS sdnn_ms FROM rr GROUP BY ALL)
SELECT run_id, record_id, CAST(coalesce(n, 0) AS INT) AS n_beats, round(mean_rr_ms, 4) AS mean_rr_ms,
  round(sdnn_ms, 4) AS sdnn_ms FROM listed LEFT JOIN m USING (run_id, record_id)""",
)
def _(spark, sf_dir):
    rr = views.intervals(spark, sf_dir, "user_id")
    return rounded(signal.processing_metrics(rr, listed(spark, sf_dir)), large=float("inf"))


@query(
    "record_features_listed",
    records_sql(BY_USER).replace("SELECT DISTINCT run_id, run_date, record_id FROM rr", LISTED_SQL)
    + take(RECORD_COLS_SQL, "record"),
)
def _(spark, sf_dir):
    rr, split = views.beats(spark, sf_dir, "user_id")
    made = feature_tables(rr, listed(spark, sf_dir), BY_USER, split)
    return rounded(made.record.drop("created_at"))


# --- waveforms and signals -----------------------------------------------------------------


@query(
    "waveform_ingest",
    "SELECT 'r1' AS run_id, '2024-01-31' AS run_date, CAST(vec_id AS VARCHAR) AS record_id,"
    " i - 1 AS sample_index, (i - 1) / 360.0::DOUBLE AS t_sec,"
    " CAST(embedding[i] AS DOUBLE) AS lead_0, 0.0::DOUBLE AS lead_1"
    " FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)",
)
def _(spark, sf_dir):
    return wf.ingest_waveforms(views.waveforms(spark, sf_dir), views.RUN_ID, views.RUN_DATE)


@query(
    "waveform_ingest_chunked",
    "SELECT 'r1' AS run_id, '2024-01-31' AS run_date, CAST(vec_id AS VARCHAR) AS record_id,"
    " i - 1 AS sample_index, (i - 1) / 360.0::DOUBLE AS t_sec,"
    " CAST(embedding[i] AS DOUBLE) AS lead_0, 0.0::DOUBLE AS lead_1"
    " FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)",
)
def _(spark, sf_dir):
    chunks = views.chunked(views.waveforms(spark, sf_dir), 20)
    return wf.ingest_waveforms(chunks, views.RUN_ID, views.RUN_DATE)


@query(
    "waveform_qc_chunked",
    "SELECT 'r1' AS run_id, CAST(vec_id AS VARCHAR) AS record_id, 10 AS sampling_hz,"
    " CAST(least(30, len(embedding)) AS BIGINT) AS n_samples, 2 AS n_channels,"
    " coalesce(label = 0, false) AS atr_exists FROM embeddings",
)
def _(spark, sf_dir):
    chunks = views.chunked(views.waveforms(spark, sf_dir, fs=10.0, leads=3), 20)
    return wf.waveform_quality(chunks, views.RUN_ID, slice_seconds=3)


@query(
    "waveform_ingest_two_leads",
    "SELECT CAST(vec_id AS VARCHAR) AS record_id, i - 1 AS sample_index,"
    " (i - 1) / 10.0::DOUBLE AS t_sec, CAST(embedding[i] AS DOUBLE) AS lead_0,"
    " CAST(embedding[len(embedding) + 1 - i] AS DOUBLE) AS lead_1 FROM (SELECT vec_id, embedding,"
    " unnest(generate_series(1, least(30, len(embedding)))) AS i FROM embeddings)",
)
def _(spark, sf_dir):
    rows = views.waveforms(spark, sf_dir, fs=10.0, leads=3)
    return wf.ingest_waveforms(rows, views.RUN_ID, views.RUN_DATE, slice_seconds=3).drop(
        "run_id", "run_date"
    )


@query(
    "waveform_ingest_two_leads_whole",
    "SELECT CAST(vec_id AS VARCHAR) AS record_id, i - 1 AS sample_index,"
    " (i - 1) / 10.0::DOUBLE AS t_sec, CAST(embedding[i] AS DOUBLE) AS lead_0,"
    " CAST(embedding[len(embedding) + 1 - i] AS DOUBLE) AS lead_1 FROM (SELECT vec_id, embedding,"
    " unnest(generate_series(1, len(embedding))) AS i FROM embeddings)",
)
def _(spark, sf_dir):
    rows = views.waveforms(spark, sf_dir, fs=10.0, leads=3)
    return wf.ingest_waveforms(rows, views.RUN_ID, views.RUN_DATE).drop("run_id", "run_date")


@query(
    "waveform_qc_whole",
    "SELECT 'r1' AS run_id, CAST(vec_id AS VARCHAR) AS record_id, 10 AS sampling_hz,"
    " CAST(len(embedding) AS BIGINT) AS n_samples, 2 AS n_channels,"
    " coalesce(label = 0, false) AS atr_exists FROM embeddings",
)
def _(spark, sf_dir):
    rows = views.waveforms(spark, sf_dir, fs=10.0, leads=3)
    return wf.waveform_quality(rows, views.RUN_ID)


@query(
    "waveform_qc",
    "SELECT 'r1' AS run_id, CAST(vec_id AS VARCHAR) AS record_id, 10 AS sampling_hz,"
    " CAST(least(30, len(embedding)) AS BIGINT) AS n_samples, 2 AS n_channels,"
    " coalesce(label = 0, false) AS atr_exists FROM embeddings",
)
def _(spark, sf_dir):
    rows = views.waveforms(spark, sf_dir, fs=10.0, leads=3)
    return wf.waveform_quality(rows, views.RUN_ID, slice_seconds=3)


@query(
    "sampling_rate",
    "SELECT record_id, round(1.0 / median(dt), 4) AS fs FROM (SELECT CAST(vec_id AS VARCHAR) AS"
    " record_id, (i - 1) / 360.0::DOUBLE - (i - 2) / 360.0::DOUBLE AS dt FROM (SELECT vec_id,"
    " unnest(generate_series(2, len(embedding))) AS i FROM embeddings)) WHERE dt > 0 GROUP BY record_id",
)
def _(spark, sf_dir):
    rows = wf.ingest_waveforms(views.waveforms(spark, sf_dir), views.RUN_ID, views.RUN_DATE)
    rates, _ = signal.infer_sampling_rate(rows)
    return rounded(rates.select("record_id", "fs"), large=float("inf"))


@query(
    "sampling_rate_of_events",
    rr_sql(BY_TYPE) + " SELECT record_id, round(1.0 / median(rr_interval_sec), 10) AS fs FROM rr"
    " WHERE rr_interval_sec > 0 GROUP BY record_id",
)
def _(spark, sf_dir):
    rates, _ = signal.infer_sampling_rate(views.samples(spark, sf_dir), block_rows=1000)
    return rates.select("record_id", F.round("fs", 10).alias("fs"))


@query(
    "sampling_rate_steady",
    "SELECT CAST(vec_id AS VARCHAR) AS record_id, round(360.0::DOUBLE, 6) AS fs FROM embeddings"
    " WHERE len(embedding) > 1",
)
def _(spark, sf_dir):
    rows = wf.ingest_waveforms(views.waveforms(spark, sf_dir), views.RUN_ID, views.RUN_DATE)
    rates, _ = signal.sampling_rates(rows)
    return rates.select("record_id", F.round("fs", 6).alias("fs"))


SAMPLE_WIDTHS = signal.DetectorWidths(baseline=10, energy=2, refractory=7, threshold_block=50)

SAMPLES_SQL = """WITH sig AS (
  SELECT event_type AS record_id, epoch_us(ts) / 1e6 AS t,
    row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS i,
    count(*) OVER (PARTITION BY event_type) AS n, CAST(round(value * 100) AS BIGINT) AS x
  FROM events)"""

# The filters reach 14 samples to both sides; there the record is reflected at its ends.
PEAKS_SQL = SAMPLES_SQL + """,
places AS (
  SELECT record_id, n, i, (i % (2 * n - 2) + 2 * n - 2) % (2 * n - 2) AS turned
  FROM (SELECT record_id, n, unnest(range(-14, n + 14)) AS i FROM sig WHERE i = 0 AND n >= 3)),
padded AS (
  SELECT p.record_id, p.n, p.i, s.t, s.x FROM places p JOIN sig s
    ON s.record_id = p.record_id AND s.i = least(turned, 2 * p.n - 2 - turned)),
filtered AS (
  SELECT *, CASE WHEN i BETWEEN -4 AND n + 3 THEN 21 * x - sum(x) OVER (PARTITION BY record_id
    ORDER BY i ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING) END AS high FROM padded),
sloped AS (
  SELECT *, 2 * lead(high, 2) OVER w + lead(high, 1) OVER w - lag(high, 1) OVER w
    - 2 * lag(high, 2) OVER w AS slope, lag(high) OVER w AS high_before, lead(high) OVER w AS high_after
  FROM filtered WINDOW w AS (PARTITION BY record_id ORDER BY i)),
energetic AS (
  SELECT *, CASE WHEN count(slope) OVER w = 5 THEN sum(slope * slope) OVER w END AS energy,
    i // 50 AS block
  FROM sloped WINDOW w AS (PARTITION BY record_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)),
blocks AS (
  SELECT record_id, block, max(energy) AS top FROM energetic WHERE energy IS NOT NULL GROUP BY ALL),
limits AS (
  SELECT record_id, block, max(top) OVER (PARTITION BY record_id ORDER BY block
    ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM blocks),
candidates AS (
  SELECT record_id, i, t, high FROM energetic JOIN limits USING (record_id, block)
  WHERE energy * 10 > near * 3 AND high > high_before AND high >= high_after AND i BETWEEN 1 AND n - 2),
peaks AS (
  SELECT record_id, i AS peak_index, t AS t_peak_sec FROM (SELECT *,
    max(high) OVER (PARTITION BY record_id ORDER BY i RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING) AS ahead,
    max(high) OVER (PARTITION BY record_id ORDER BY i RANGE BETWEEN 1 FOLLOWING AND 7 FOLLOWING) AS behind
    FROM candidates)
  WHERE (ahead IS NULL OR ahead < high) AND (behind IS NULL OR behind <= high))"""


@query(
    "clean_signal",
    SAMPLES_SQL + """ SELECT record_id, i AS sample_index, round(CASE WHEN i BETWEEN 10 AND n - 11
  THEN x - sum(x) OVER (PARTITION BY record_id ORDER BY i ROWS BETWEEN 10 PRECEDING AND 10 FOLLOWING)
    / 21.0::DOUBLE ELSE x END, 4) AS cleaned FROM sig""",
)
def _(spark, sf_dir):
    rows = views.samples(spark, sf_dir)
    cleaned = signal.clean_signal(
        rows, views.unit_rates(rows), widths=SAMPLE_WIDTHS, segment_samples=1000
    )
    return rounded(cleaned.drop("run_id", "run_date"), large=float("inf"))


@query("peak_detect", PEAKS_SQL + " SELECT record_id, peak_index, t_peak_sec FROM peaks")
def _(spark, sf_dir):
    rows = views.samples(spark, sf_dir)
    peaks = signal.detect_peaks(
        rows, views.unit_rates(rows), widths=SAMPLE_WIDTHS, segment_samples=1000
    )
    return peaks.drop("run_id", "run_date")


@query(
    "beats_from_signal",
    PEAKS_SQL + """ SELECT record_id, row_number() OVER w - 1 AS beat_index, peak_index, t_peak_sec,
  t_peak_sec - lag(t_peak_sec) OVER w AS rr_interval_sec FROM peaks
  WINDOW w AS (PARTITION BY record_id ORDER BY peak_index)""",
)
def _(spark, sf_dir):
    rows = views.samples(spark, sf_dir)
    rr, _ = signal.beats_from_samples(
        rows, rates=views.unit_rates(rows), widths=SAMPLE_WIDTHS, segment_samples=1000
    )
    return rr.drop("run_id", "run_date")


@query(
    "sanitize_peaks",
    "WITH p AS (SELECT event_type AS record_id, CAST(floor(value * 10) AS BIGINT) - 50 AS peak_index"
    " FROM events), n AS (SELECT event_type AS record_id, count(*) AS n FROM events GROUP BY 1)"
    " SELECT DISTINCT record_id, peak_index FROM p JOIN n USING (record_id)"
    " WHERE peak_index BETWEEN 0 AND n - 1",
)
def _(spark, sf_dir):
    events = views.table(spark, sf_dir, "events").withColumnRenamed("event_type", "record_id")
    peaks = events.select(
        "record_id", (F.floor(F.col("value") * 10) - 50).cast("long").alias("peak_index")
    )
    return signal.sanitize_peaks(peaks, signal.record_lengths(events, ["record_id"]), ["record_id"])


# --- record selection and catalog ----------------------------------------------------------


def _rows_per_record(df: DataFrame) -> DataFrame:
    return df.groupBy("record_id").agg(F.count(F.lit(1)).alias("beats"))


def _users(spark, sf_dir) -> DataFrame:
    return views.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("record_id")
    )


PER_USER = "SELECT CAST(user_id AS VARCHAR) AS record_id, count(*) AS beats FROM events WHERE "


@query("record_filter_ids", PER_USER + "user_id IN (3, 17, 99, 235) GROUP BY ALL")
def _(spark, sf_dir):
    return _rows_per_record(filter_records(_users(spark, sf_dir), ids="3, 17,,235, 99", range="1-2"))


@query("record_filter_range", PER_USER + "user_id BETWEEN 10 AND 400 GROUP BY ALL")
def _(spark, sf_dir):
    return _rows_per_record(filter_records(_users(spark, sf_dir), range="10-400"))


@query("record_limit", PER_USER + "user_id BETWEEN 10 AND 129 GROUP BY ALL")
def _(spark, sf_dir):
    return _rows_per_record(filter_records(_users(spark, sf_dir), range="10-400", limit=120))


@query(
    "pending_records",
    "SELECT CAST(c_custkey AS VARCHAR) AS record_id, CASE WHEN c_custkey IN (SELECT o_custkey FROM"
    " orders) THEN 'skip' ELSE 'run' END AS state FROM customer",
)
def _(spark, sf_dir):
    records = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("record_id")
    )
    written = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("record_id")
    )
    skipped, pending = tables.split_pending(records, written, overwrite=False)
    return skipped.withColumn("state", F.lit("skip")).unionByName(
        pending.withColumn("state", F.lit("run"))
    )


ARTIFACTS_SQL = """WITH a AS (SELECT o_orderpriority AS run_id, CAST(o_orderkey AS VARCHAR) AS record_id,
  CASE o_orderstatus WHEN 'F' THEN 'raw' WHEN 'O' THEN 'processed' ELSE 'curated' END AS layer,
  CASE o_orderstatus WHEN 'F' THEN 'ecg' WHEN 'O' THEN 'rr_intervals_v1' ELSE 'window_features_v1' END
    AS artifact_type, o_custkey, o_totalprice FROM orders),
artifacts AS (SELECT run_id, record_id, layer, artifact_type,
  layer || '/' || CAST(o_custkey AS VARCHAR) AS uri,
  CASE WHEN o_totalprice < 50000 THEN 'old_v0' ELSE artifact_type END AS schema_ver FROM a)"""


@query(
    "artifact_discovery",
    ARTIFACTS_SQL + " SELECT record_id, uri FROM artifacts WHERE run_id = '2-HIGH' AND layer ="
    " 'processed' AND artifact_type = 'rr_intervals_v1' AND schema_ver = 'rr_intervals_v1' ORDER BY record_id",
)
def _(spark, sf_dir):
    return catalog.discover_artifacts(
        views.artifacts(spark, sf_dir), "2-HIGH", K.PROCESSED, K.RR_INTERVALS, K.RR_INTERVALS
    )


@query(
    "lineage_listing",
    ARTIFACTS_SQL + " SELECT layer, artifact_type, schema_ver, record_id FROM artifacts"
    " WHERE run_id = '1-URGENT' ORDER BY layer, record_id",
)
def _(spark, sf_dir):
    return catalog.lineage(views.artifacts(spark, sf_dir), "1-URGENT")


@query(
    "count_distinct_uri",
    ARTIFACTS_SQL + " SELECT run_id, layer, artifact_type, count(*) AS artifact_rows,"
    " count(DISTINCT uri) AS distinct_uris FROM artifacts GROUP BY ALL",
)
def _(spark, sf_dir):
    return catalog.artifact_consistency(views.artifacts(spark, sf_dir))


@query(
    "dq_versions",
    ARTIFACTS_SQL + " SELECT * FROM artifacts WHERE layer IN ('processed', 'curated', 'ml_ready')"
    " AND schema_ver <> artifact_type",
)
def _(spark, sf_dir):
    return quality.version_mismatches(views.artifacts(spark, sf_dir))


@query(
    "register_artifacts",
    "SELECT DISTINCT 'r1' AS run_id, CAST(user_id AS VARCHAR) AS record_id, 'ml_ready' AS layer,"
    " 'record_features_v1' AS artifact_type, 'ml_ready/features' AS uri,"
    " 'record_features_v1' AS schema_ver FROM events",
)
def _(spark, sf_dir):
    records = _users(spark, sf_dir).withColumn("run_id", F.lit(views.RUN_ID))
    return catalog.artifact_rows(
        records, K.ML_READY, K.RECORD_FEATURES, "ml_ready/features"
    ).drop("created_at")


@query(
    "upsert_latest",
    "SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice, o_orderdate FROM orders QUALIFY"
    " row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) = 1",
)
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    old = F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")
    return catalog.upsert(
        orders.filter(old), orders.filter(~old), ["o_custkey", "o_orderstatus"],
        ["o_orderdate", "o_orderkey"],
    )


@query(
    "upsert_out_of_order",
    "SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice, o_orderdate FROM orders QUALIFY"
    " row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY (o_totalprice < 100000) DESC,"
    " o_orderdate DESC, o_orderkey DESC) = 1",
)
def _(spark, sf_dir):
    # Updates are the cheap orders, so their dates lie on both sides of the base's.
    orders = views.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderstatus", "o_orderkey", "o_totalprice", "o_orderdate"
    )
    cheap = F.col("o_totalprice") < 100_000
    return catalog.upsert(
        orders.filter(~cheap), orders.filter(cheap), ["o_custkey", "o_orderstatus"],
        ["o_orderdate", "o_orderkey"],
    )


STATES_SQL = """WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS run_id, o_orderstatus AS service,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'failed' ELSE o_orderpriority END AS status,
  'order ' || CAST(o_orderkey AS VARCHAR) AS notes,
  o_orderdate + to_microseconds(o_orderkey) AS created_at,
  CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS started_at,
  CASE WHEN o_orderpriority = '2-HIGH' THEN o_orderdate END AS ended_at FROM orders)"""


@query(
    "upsert_lifecycle",
    STATES_SQL + """ SELECT run_id, service, arg_max(status, created_at) AS status,
  arg_max(notes, created_at) AS notes, min(created_at) AS created_at,
  arg_max(started_at, created_at) FILTER (WHERE started_at IS NOT NULL) AS started_at,
  arg_min(ended_at, created_at) FILTER (WHERE ended_at IS NOT NULL) AS ended_at
FROM s GROUP BY run_id, service""",
)
def _(spark, sf_dir):
    history = views.states(spark, sf_dir)
    old = F.col("created_at") < F.lit("1996-01-01").cast("timestamp_ntz")
    return catalog.upsert_lifecycle(history.filter(old), history.filter(~old))


@query(
    "upsert_runs",
    STATES_SQL + """ SELECT run_id, arg_max(CAST(created_at AS DATE), created_at) AS run_date,
  arg_max(status, created_at) AS status, arg_max(notes, created_at) AS notes,
  min(created_at) AS created_at FROM s GROUP BY run_id""",
)
def _(spark, sf_dir):
    history = views.states(spark, sf_dir).select(
        "run_id", F.col("created_at").cast("date").alias("run_date"), "status", "notes",
        "created_at",
    )
    old = F.col("created_at") < F.lit("1996-01-01").cast("timestamp_ntz")
    return catalog.upsert_run(history.filter(old), history.filter(~old))


@query(
    "dq_unended_failures",
    STATES_SQL + " SELECT run_id, service, notes FROM s WHERE status = 'failed' AND ended_at IS NULL",
)
def _(spark, sf_dir):
    failed = quality.unended_failures(views.states(spark, sf_dir))
    return failed.select("run_id", "service", "notes")


@query(
    "referential_orphans",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events"
    " WHERE user_id IS NOT NULL)",
)
def _(spark, sf_dir):
    customers = views.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    users = views.table(spark, sf_dir, "events").select("user_id")
    return catalog.orphans(customers, users, "c_custkey", "user_id")


@query(
    "run_summary",
    "SELECT c_custkey AS run_id, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS"
    " artifact_rows, (SELECT count(*) FROM events WHERE user_id = c_custkey) AS feature_rows FROM customer",
)
def _(spark, sf_dir):
    return catalog.run_summary(
        views.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("run_id")),
        views.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("run_id")),
        views.table(spark, sf_dir, "events").select(F.col("user_id").alias("run_id")),
    )


@query(
    "run_status",
    """WITH c AS (SELECT o_custkey AS run_id, count(*) AS records_total,
  count(*) FILTER (WHERE o_orderstatus = 'O') AS records_ok,
  count(*) FILTER (WHERE o_orderstatus = 'P') AS records_skipped,
  count(*) FILTER (WHERE o_orderstatus = 'F') AS records_failed FROM orders GROUP BY ALL)
SELECT *, CASE WHEN records_failed = 0 THEN 'succeeded' WHEN records_ok + records_skipped > 0
  THEN 'partial_success' ELSE 'failed' END AS status FROM c""",
)
def _(spark, sf_dir):
    status = F.col("o_orderstatus")
    outcomes = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"),
        F.when(status == "O", "ok").when(status == "P", "skipped").otherwise("failed").alias("outcome"),
    )
    return catalog.run_status(outcomes, ["run_id"])


@query(
    "latest_n",
    "SELECT o_orderkey, o_orderdate, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 6",
)
def _(spark, sf_dir):
    orders = views.table(spark, sf_dir, "orders")
    return catalog.latest_n(
        orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), ["o_orderdate", "o_orderkey"], 6
    )


@query(
    "date_valid",
    """WITH d AS (SELECT o_orderkey, CASE o_orderpriority
    WHEN '5-LOW' THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN '4-NOT SPECIFIED' THEN strftime(o_orderdate, '%Y-%m-%d')[1:9]
    WHEN '3-MEDIUM' THEN strftime(o_orderdate, '%Y-%d-%m')
    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS run_date FROM orders)
SELECT o_orderkey, run_date, length(run_date) = 10 AND try_strptime(run_date, '%Y-%m-%d') IS NOT NULL AS valid
FROM d""",
)
def _(spark, sf_dir):
    priority = F.col("o_orderpriority")
    text = (
        F.when(priority == "5-LOW", F.date_format("o_orderdate", "yyyy/MM/dd"))
        .when(priority == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd").substr(1, 9))
        .when(priority == "3-MEDIUM", F.date_format("o_orderdate", "yyyy-dd-MM"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    )
    rows = views.table(spark, sf_dir, "orders").select("o_orderkey", text.alias("run_date"))
    return rows.withColumn("valid", hrv.valid_run_date(F.col("run_date")))


# --- contract checks: every key with its verdict -------------------------------------------

WINDOW_ID = "record_id window_start_sec "


def _verdicts(df: DataFrame, *columns: str, **checks) -> DataFrame:
    return df.select(*columns, *[check.alias(name) for name, check in checks.items()])


@query(
    "dq_presence",
    rr_sql(BY_USER) + " SELECT run_id, record_id, count(*) AS rows, count(t_peak_sec) AS timed_rows"
    " FROM rr GROUP BY ALL",
)
def _(spark, sf_dir):
    return quality.presence(views.intervals(spark, sf_dir, "user_id"))


@query(
    "dq_untimed_records",
    "SELECT 'r1' AS run_id, CAST(c_custkey AS VARCHAR) AS record_id, CAST(0 AS BIGINT) AS rows,"
    " CAST(0 AS BIGINT) AS timed_rows FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)",
)
def _(spark, sf_dir):
    rr = views.intervals(spark, sf_dir, "user_id")
    return quality.untimed_records(rr, listed(spark, sf_dir))


@query(
    "dq_derived_records",
    records_sql(BY_USER) + " SELECT record_id, mean_rr_ms > 0 AND isfinite(heart_rate_bpm) AND"
    " coalesce(isfinite(rr_cv), true) AND coalesce(isfinite(rmssd_sdnn_ratio), true) AS derived_ok"
    " FROM record",
)
def _(spark, sf_dir):
    rows = record_table(spark, sf_dir, BY_USER)
    return _verdicts(rows, "record_id", derived_ok=quality.derived_ok())


@query(
    "expected_windows",
    curated_sql(BY_TYPE) + """, e AS (SELECT run_id, record_id,
  CAST(floor((max(t_peak_sec) - {0}) / {1}) + 1 AS BIGINT) AS expected_rows FROM rr GROUP BY ALL),
a AS (SELECT run_id, record_id, count(*) AS actual_rows FROM curated GROUP BY ALL)
SELECT run_id, record_id, expected_rows, coalesce(actual_rows, 0) AS actual_rows
FROM e LEFT JOIN a USING (run_id, record_id)""".format(1704067200.0, BY_TYPE.width_sec),
)
def _(spark, sf_dir):
    rr = views.intervals(spark, sf_dir, "event_type")
    # Counted from the first day of the data, as a record counts from its own start.
    shifted = rr.withColumn("t_peak_sec", F.col("t_peak_sec") - F.lit(1704067200.0))
    return quality.expected_windows(shifted, curated(spark, sf_dir, BY_TYPE), BY_TYPE.width_sec)


@query(
    "dq_alignment",
    "SELECT event_id, abs((epoch_us(ts) / 1e6) % 300.0) <= 1e-9 AS on_grid FROM events",
)
def _(spark, sf_dir):
    starts = views.table(spark, sf_dir, "events").select(
        "event_id", hrv.epoch_seconds("ts").alias("window_start_sec")
    )
    return _verdicts(starts, "event_id", on_grid=quality.is_aligned())


@query(
    "dq_coverage",
    curated_sql(BY_USER) + """ SELECT record_id, window_start_sec,
  window_coverage_sec BETWEEN 0 AND 400000.000001
  AND window_is_partial = (window_coverage_sec < 400000 - 1e-6) AS coverage_ok FROM curated""",
)
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    return _verdicts(
        rows, "record_id", "window_start_sec", coverage_ok=quality.coverage_ok(400_000.0)
    )


@query(
    "dq_key_unique",
    "SELECT 'r1' AS run_id, CAST(user_id AS VARCHAR) AS record_id,"
    " CAST(floor(epoch_us(ts) / 1e6 / 86400.0) * 86400.0 AS BIGINT) AS window_start_sec,"
    " count(*) AS rows FROM events GROUP BY ALL HAVING count(*) > 1",
)
def _(spark, sf_dir):
    rows = views.table(spark, sf_dir, "events").select(
        F.lit(views.RUN_ID).alias("run_id"),
        F.col("user_id").cast("string").alias("record_id"),
        hrv.epoch_seconds("ts").alias("exact_sec"),
    )
    return quality.bad_window_keys(
        rows.withColumn("window_start_sec", hrv.window_start("exact_sec", 86_400.0))
    )


@query(
    "dq_fractions",
    records_sql(BY_USER) + " SELECT record_id, pnn50 BETWEEN 0 AND 1 AND coalesce(pnn20 BETWEEN 0"
    " AND 1, true) AND valid_window_fraction BETWEEN 0 AND 1 AND partial_window_fraction BETWEEN 0"
    " AND 1 AS in_range, rr_cv BETWEEN 0 AND 1 AS cv_in_range FROM record",
)
def _(spark, sf_dir):
    rows = record_table(spark, sf_dir, BY_USER)
    return _verdicts(
        rows, "record_id", in_range=quality.fractions_ok(quality.RECORD_FRACTIONS),
        cv_in_range=quality.fractions_ok(["rr_cv"]),
    )


@query(
    "dq_derived",
    curated_sql(BY_USER) + " SELECT record_id, CAST(window_start_sec AS BIGINT) AS window_start_sec,"
    " mean_rr_ms > 0 AND (sdnn_ms IS NULL OR isfinite(sdnn_ms / mean_rr_ms)) AND (sdnn_ms IS NULL"
    " OR sdnn_ms > 0) AS derived_ok FROM curated",
)
def _(spark, sf_dir):
    rows = windows.window_features_ml(curated(spark, sf_dir, BY_USER))
    return _verdicts(rows, "record_id", "window_start_sec", derived_ok=quality.derived_ok())


@query(
    "dq_distribution",
    records_sql(BY_USER) + " SELECT record_id, rr_range_ms >= 0 AND abs(rr_range_ms - (rr_max_ms -"
    " rr_min_ms)) <= 1e-6 AND rr_min_ms <= rr_median_ms AND rr_median_ms <= rr_max_ms AS"
    " distribution_ok FROM record",
)
def _(spark, sf_dir):
    rows = record_table(spark, sf_dir, BY_USER)
    return _verdicts(rows, "record_id", distribution_ok=quality.distribution_ok())


@query(
    "dq_coverage_rollup",
    records_sql(BY_USER) + " SELECT record_id, min_window_coverage_sec >= 0 AND"
    " min_window_coverage_sec <= mean_window_coverage_sec AND mean_window_coverage_sec <="
    " 400000 + 1e-9 AS coverage_ok FROM record",
)
def _(spark, sf_dir):
    rows = record_table(spark, sf_dir, BY_USER)
    return _verdicts(rows, "record_id", coverage_ok=quality.coverage_rollup_ok(400_000.0))


@query(
    "count_invariant",
    records_sql(BY_USER) + """, source AS (SELECT run_id, record_id, count(rr_interval_sec) AS source_n_rr
  FROM rr GROUP BY ALL)
SELECT run_id, record_id, window_n_rr_sum AS window_n_rr, n_rr AS record_n_rr, source_n_rr,
  window_n_rr_sum = n_rr AND source_n_rr = n_rr AS agrees
FROM rolled JOIN record USING (run_id, record_id) JOIN source USING (run_id, record_id)""",
)
def _(spark, sf_dir):
    rr, split = views.beats(spark, sf_dir, "user_id")
    made = feature_tables(rr, params=BY_USER, split=split)
    counts = quality.rollup_interval_counts(made.rollups, drop_segments(rr))
    return counts.withColumn("agrees", quality.counts_agree())


@query(
    "dq_one_row_per_record",
    "SELECT 'r1' AS run_id, CAST(c_custkey AS VARCHAR) AS record_id, (SELECT count(*) FROM events"
    " WHERE user_id = c_custkey) AS rows FROM customer WHERE (SELECT count(*) FROM events WHERE"
    " user_id = c_custkey) <> 1",
)
def _(spark, sf_dir):
    run = F.lit(views.RUN_ID).alias("run_id")
    rows = _users(spark, sf_dir).select(run, "record_id")
    listed = views.table(spark, sf_dir, "customer").select(
        run, F.col("c_custkey").cast("string").alias("record_id")
    )
    return quality.not_one_row(rows, listed)


@query(
    "key_parity",
    curated_sql(BY_USER) + " SELECT run_id, record_id, CAST(window_start_sec AS BIGINT) AS"
    " window_start_sec, true AS in_left, false AS in_right FROM curated WHERE NOT window_valid",
)
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    valid = windows.window_features_ml(rows).filter("window_valid")
    return quality.key_parity(rows, valid)


@query(
    "determinism",
    curated_sql(BY_TYPE) + " SELECT record_id, count(*) AS windows, sum(n_rr)::BIGINT AS n_rr,"
    " CAST(0 AS BIGINT) AS differing_rows FROM curated GROUP BY record_id",
)
def _(spark, sf_dir):
    plain = rounded(curated(spark, sf_dir, BY_TYPE))
    segmented = rounded(curated(spark, sf_dir, BY_TYPE, SMALL_SEGMENTS))
    differing = quality.differing_rows(plain, segmented).groupBy("record_id").agg(
        F.count(F.lit(1)).alias("differing_rows")
    )
    totals = segmented.groupBy("record_id").agg(
        F.count(F.lit(1)).alias("windows"), F.sum("n_rr").alias("n_rr")
    )
    return totals.join(differing, "record_id", "left").fillna(0, ["differing_rows"])


@query(
    "run_date_conflicts",
    "SELECT run_id, strftime(min(run_date), '%Y-%m-%d') AS first_date, strftime(max(run_date),"
    " '%Y-%m-%d') AS last_date FROM (SELECT o_custkey AS run_id, o_orderdate AS run_date FROM orders)"
    " GROUP BY run_id HAVING min(run_date) <> max(run_date)",
)
def _(spark, sf_dir):
    rows = views.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("run_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("run_date"),
    )
    return quality.several_run_dates(rows)


# --- gates and stored layers -----------------------------------------------------------------


@query(
    "gate_report",
    curated_sql(BY_USER) + """, n AS (
  SELECT right(record_id, 1) AS last, record_id, count(*) AS w FROM curated GROUP BY ALL)
SELECT 'B' AS gate, 'misaligned_window' AS check, record_id, w AS violations FROM n WHERE last = '1'
UNION ALL SELECT 'B', 'coverage', record_id, w FROM n WHERE last = '2'
UNION ALL SELECT 'C', 'window_fraction', record_id, w FROM n WHERE last = '3'
UNION ALL SELECT 'C', 'window_parity', record_id, 2 * w FROM n WHERE last = '1'
UNION ALL SELECT 'C', 'window_parity', record_id, w FROM n WHERE last = '4'""",
)
def _(spark, sf_dir):
    rows = curated(spark, sf_dir, BY_USER)
    last = F.substring("record_id", -1, 1)
    planted = gates.GateTables(
        curated=rows.withColumns({
            "window_start_sec": F.col("window_start_sec") + F.when(last == "1", 1.0).otherwise(0.0),
            "window_coverage_sec": F.when(last == "2", -1.0).otherwise(F.col("window_coverage_sec")),
        }),
        window_ml=windows.window_features_ml(rows).filter(last != "4").withColumn(
            "pnn50", F.when(last == "3", 1.5).otherwise(F.col("pnn50"))
        ),
    )
    report = gates.gate_report(planted, width_sec=BY_USER.width_sec)
    return report.groupBy("gate", "check", "record_id").agg(F.count(F.lit(1)).alias("violations"))


# Faults of the modelled run, a record each by the remainder of its number.
_FAULT = "CAST(record_id AS INT) % 15"
_GATE_SQL = records_sql(BY_USER) + f""",
beats_ AS (
  SELECT record_id, CASE WHEN {_FAULT} <> 1 THEN t_peak_sec END AS t, rr_interval_sec AS rr FROM rr),
windows_ AS (
  SELECT * REPLACE (
      window_start_sec + CASE WHEN {_FAULT} = 2 THEN 1 ELSE 0 END AS window_start_sec,
      CASE WHEN {_FAULT} = 3 THEN -1.0 ELSE window_coverage_sec END AS window_coverage_sec)
  FROM curated WHERE NOT ({_FAULT} = 4 AND (window_start_sec / {BY_USER.width_sec}) % 2 = 0)),
ml_once AS (
  SELECT record_id, mean_rr_ms, CASE WHEN {_FAULT} <> 6 THEN CAST(window_start_sec AS BIGINT) END AS start,
    CASE WHEN {_FAULT} = 7 THEN 1.5 ELSE pnn50 END AS pnn50,
    60000.0 / mean_rr_ms + CASE WHEN {_FAULT} = 8 THEN 1 ELSE 0 END AS bpm
  FROM curated),
ml_ AS (SELECT * FROM ml_once UNION ALL SELECT * FROM ml_once WHERE {_FAULT} = 5),
records_ AS (
  SELECT * REPLACE (
      CASE WHEN {_FAULT} = 9 THEN 2.0 ELSE pnn20 END AS pnn20,
      heart_rate_bpm + CASE WHEN {_FAULT} = 10 THEN 1 ELSE 0 END AS heart_rate_bpm,
      CASE WHEN {_FAULT} = 11 THEN rr_max_ms + 1 ELSE rr_median_ms END AS rr_median_ms,
      CASE WHEN {_FAULT} = 12 THEN mean_window_coverage_sec + 1 ELSE min_window_coverage_sec END
        AS min_window_coverage_sec,
      n_rr + CASE WHEN {_FAULT} = 14 THEN 1 ELSE 0 END AS n_rr)
  FROM record WHERE {_FAULT} <> 13),
listed_ AS (
  SELECT DISTINCT record_id FROM rr
  UNION ALL SELECT CAST(max(CAST(record_id AS INT)) + 1 AS VARCHAR) FROM rr),
parity AS (
  SELECT record_id, count(*) AS n FROM (
    (SELECT DISTINCT record_id, CAST(window_start_sec AS BIGINT) AS start FROM windows_
      EXCEPT SELECT record_id, start FROM ml_)
    UNION ALL (SELECT DISTINCT record_id, start FROM ml_
      EXCEPT SELECT record_id, CAST(window_start_sec AS BIGINT) FROM windows_)) GROUP BY ALL),
counts AS (
  SELECT record_id, coalesce(w.n, 0) AS w, coalesce(r.n, 0) AS r, coalesce(b.n, 0) AS b
  FROM (SELECT record_id, sum(n_rr) AS n FROM windows_ GROUP BY ALL) w
  FULL JOIN (SELECT record_id, sum(n_rr) AS n FROM records_ GROUP BY ALL) r USING (record_id)
  FULL JOIN (SELECT record_id, count(rr) AS n FROM beats_ GROUP BY ALL) b USING (record_id)),
artifacts_ AS (
  SELECT o_orderpriority AS run, CAST(o_orderkey AS VARCHAR) AS record_id, o_orderstatus AS s,
    o_totalprice < 50000 AS old FROM orders
  WHERE NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'O'))"""

_IN_RUN = f"'{views.RUN_ID}' AS run_id, record_id"


@query(
    "gate_metrics",
    _GATE_SQL + f"""
SELECT 'A' AS gate, 'artifact_version' AS check, run AS run_id, record_id, count(*) AS violations
FROM artifacts_ WHERE s <> 'F' AND old GROUP BY ALL
UNION ALL SELECT 'A', 'no_interval_table', run, NULL, 1 FROM artifacts_ GROUP BY run HAVING count(*) FILTER (s = 'O') = 0
UNION ALL SELECT 'A', 'failure_not_ended', CAST(o_custkey AS VARCHAR), NULL, count(*)
FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
UNION ALL SELECT 'A', 'run_date', n_name, NULL, 1 FROM nation WHERE n_nationkey % 5 < 2
UNION ALL SELECT 'A', 'several_run_dates', '{views.RUN_ID}', NULL, 1
UNION ALL SELECT 'B0', 'no_beat_times', {_IN_RUN}, 1 FROM listed_ LEFT JOIN beats_ USING (record_id)
GROUP BY record_id HAVING count(t) = 0
UNION ALL SELECT 'B', 'missing_column', NULL, NULL, 1
UNION ALL SELECT 'B', 'misaligned_window', {_IN_RUN}, count(*) FROM windows_
WHERE abs(window_start_sec % {BY_USER.width_sec}) > 1e-9 GROUP BY record_id
UNION ALL SELECT 'B', 'coverage', {_IN_RUN}, count(*) FROM windows_
WHERE window_coverage_sec NOT BETWEEN 0 AND {BY_USER.width_sec} + 1e-6
  OR window_is_partial <> (window_coverage_sec < {BY_USER.width_sec} - 1e-6) GROUP BY record_id
UNION ALL SELECT 'B', 'window_count', {_IN_RUN}, 1
FROM (SELECT record_id, floor(max(t) / {BY_USER.width_sec}) + 1 AS expected FROM beats_ GROUP BY record_id)
LEFT JOIN (SELECT record_id, count(*) AS n FROM windows_ GROUP BY record_id) USING (record_id)
WHERE expected IS DISTINCT FROM coalesce(n, 0)
UNION ALL SELECT 'C', 'missing_window_column', NULL, NULL, 1
UNION ALL SELECT 'C', 'window_key', {_IN_RUN}, count(*)
FROM (SELECT record_id, start FROM ml_ GROUP BY ALL HAVING count(*) > 1 OR start IS NULL) GROUP BY record_id
UNION ALL SELECT 'C', 'window_fraction', {_IN_RUN}, count(*) FROM ml_ WHERE pnn50 NOT BETWEEN 0 AND 1 GROUP BY record_id
UNION ALL SELECT 'C', 'window_derived', {_IN_RUN}, count(*) FROM ml_
WHERE abs(bpm - 60000.0 / mean_rr_ms) > 1e-6 GROUP BY record_id
UNION ALL SELECT 'C', 'window_parity', {_IN_RUN}, n FROM parity
UNION ALL SELECT 'C', 'missing_record_column', NULL, NULL, 2
UNION ALL SELECT 'C', 'fraction', {_IN_RUN}, 1 FROM records_ WHERE pnn20 NOT BETWEEN 0 AND 1
UNION ALL SELECT 'C', 'derived', {_IN_RUN}, 1 FROM records_ WHERE abs(heart_rate_bpm - 60000.0 / mean_rr_ms) > 1e-6
UNION ALL SELECT 'C', 'distribution', {_IN_RUN}, 1 FROM records_ WHERE rr_median_ms NOT BETWEEN rr_min_ms AND rr_max_ms
UNION ALL SELECT 'C', 'coverage_rollup', {_IN_RUN}, 1 FROM records_
WHERE min_window_coverage_sec > mean_window_coverage_sec
UNION ALL SELECT 'C', 'not_one_row', {_IN_RUN}, 1 FROM listed_ WHERE record_id NOT IN (SELECT record_id FROM records_)
UNION ALL SELECT 'C', 'interval_count', {_IN_RUN}, 1 FROM counts WHERE w <> r OR b <> r""",
)
def _(spark, sf_dir):
    return gate_metrics(_faulty_run(spark, sf_dir), width_sec=BY_USER.width_sec)


@query(
    "gate_metrics_no_times",
    rr_sql(BY_USER) + f"""
SELECT 'B0' AS gate, 'missing_column' AS check, NULL AS run_id, NULL AS record_id, 1 AS violations
UNION ALL SELECT 'B0', 'no_beat_times', '{views.RUN_ID}', record_id, 1 FROM rr GROUP BY record_id""",
)
def _(spark, sf_dir):
    rr = views.intervals(spark, sf_dir, "user_id").drop("t_peak_sec")
    return gate_metrics(gates.GateTables(rr=rr), ["B0"])


def _faulty_run(spark: SparkSession, sf_dir: str) -> gates.GateTables:
    """A run's tables with a fault for every check but the one for interval columns."""
    fault = F.col("record_id").cast("int") % 15

    def broken(number: int, name: str, value: Column) -> dict[str, Column]:
        return {name: F.when(fault == number, value).otherwise(F.col(name))}

    none = F.lit(None)
    rr, split = views.beats(spark, sf_dir, "user_id")
    made = feature_tables(rr, params=BY_USER, split=split)
    rr = drop_segments(rr)
    ml = made.window_ml.withColumns(
        broken(6, "window_start_sec", none) | broken(7, "pnn50", F.lit(1.5))
        | broken(8, "heart_rate_bpm", F.col("heart_rate_bpm") + 1)
    ).drop("rr_cv")
    odd_window = (F.col("window_start_sec") / BY_USER.width_sec) % 2 != 0
    listed = rr.select(*K.RECORD_COLS).distinct()
    unknown = listed.groupBy("run_id", "run_date").agg(
        (F.max(F.col("record_id").cast("int")) + 1).cast("string").alias("record_id")
    )
    nations = views.table(spark, sf_dir, "nation")
    date = F.when(F.col("n_nationkey") % 5 == 0, "2024-02-30").when(F.col("n_nationkey") % 5 == 1, "2024-1-001")
    return gates.GateTables(
        rr=rr.withColumns(broken(1, "t_peak_sec", none) | broken(0, "run_date", F.lit("2024-02-01"))),
        curated=made.curated.filter((fault != 4) | odd_window).withColumns(
            broken(2, "window_start_sec", F.col("window_start_sec") + 1)
            | broken(3, "window_coverage_sec", F.lit(-1.0))
        ).drop("window_end_sec"),
        window_ml=ml.unionByName(ml.filter(fault == 5)),
        records=made.record.filter(fault != 13).withColumns(
            broken(9, "pnn20", F.lit(2.0)) | broken(10, "heart_rate_bpm", F.col("heart_rate_bpm") + 1)
            | broken(11, "rr_median_ms", F.col("rr_max_ms") + 1)
            | broken(12, "min_window_coverage_sec", F.col("mean_window_coverage_sec") + 1)
            | broken(14, "n_rr", F.col("n_rr") + 1)
        ).drop("rr_iqr_ms", "created_at"),
        listed=listed.unionByName(unknown),
        artifacts=views.artifacts(spark, sf_dir).filter("NOT (run_id = '1-URGENT' AND layer = 'processed')"),
        service_runs=views.states(spark, sf_dir),
        runs=nations.select(F.col("n_name").alias("run_id"), F.coalesce(date, F.lit("2024-01-31")).alias("run_date")),
    )


def _fresh_root(spark) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/layers-{uuid.uuid4().hex}"


@query("layer_roundtrip", rr_sql(BY_TYPE) + RR_ROWS)
def _(spark, sf_dir):
    root, rr = _fresh_root(spark), views.intervals(spark, sf_dir, "event_type")
    records = rr.select("record_id").distinct()
    tables.write_records(rr, records, root, K.PROCESSED, K.RR_INTERVALS, views.RUN_ID, views.RUN_DATE)
    return read_rr(spark, root, views.RUN_ID, views.RUN_DATE).drop("run_id", "run_date")


@query(
    "run_level_overwrite",
    curated_sql(BY_USER) + """ SELECT record_id, CAST(window_start_sec AS BIGINT) AS window_start_sec,
  n_rr, CASE WHEN right(record_id, 1) = '3' THEN -1.0 ELSE round(pnn50, 4) END AS pnn50
FROM curated WHERE right(record_id, 1) <> '7'""",
)
def _(spark, sf_dir):
    root, last = _fresh_root(spark), F.substring("record_id", -1, 1)
    where = (root, K.ML_READY, K.WINDOW_FEATURES_ML, views.RUN_ID, views.RUN_DATE)
    rows = windows.window_features_ml(curated(spark, sf_dir, BY_USER))
    tables.write_run_level(rows, rows.select("record_id").distinct(), *where)
    # A second write replaces the records in 3 and empties those in 7; the others stay.
    stored = read_run(spark, root, *where[1:])
    replaced = stored.filter(last.isin("3", "7")).select("record_id").distinct().checkpoint()
    new = stored.filter(last == "3").withColumn("pnn50", F.lit(-1.0))
    tables.write_run_level(new, replaced, *where)
    found = read_run(spark, root, *where[1:])
    return rounded(found.select("record_id", "window_start_sec", "n_rr", "pnn50"))


PUBLISHED_SQL = """ SELECT record_id, CAST(window_start_sec AS BIGINT) AS window_start_sec, n_rr,
  CASE WHEN right(record_id, 1) = '3' THEN -1.0 ELSE round(pnn50, 4) END AS pnn50,
  CASE WHEN right(record_id, 1) = '3' THEN -1 ELSE count(*) OVER (PARTITION BY record_id) END AS windows
FROM curated WHERE right(record_id, 1) <> '7'"""


def _published(spark, sf_dir) -> Publication:
    """Both modelling tables, published, cut off in an overwrite, and published again in part."""
    made, last = features(spark, sf_dir, BY_USER), F.substring("record_id", -1, 1)
    run = Publication(spark, _fresh_root(spark), K.ML_READY, views.RUN_ID, views.RUN_DATE)
    run.publish(
        {K.WINDOW_FEATURES_ML: made.window_ml, K.RECORD_FEATURES: made.record},
        made.record.select("record_id"),
    )
    stored, record = run.read(K.WINDOW_FEATURES_ML), run.read(K.RECORD_FEATURES)
    # Only the first table of this one gets written, for every record.
    run.write_batch(
        2, {K.WINDOW_FEATURES_ML: stored.withColumn("pnn50", F.lit(-2.0))}, record.select("record_id")
    )
    # This one replaces the records in 3 and empties those in 7; the others stay.
    run.publish(
        {
            K.WINDOW_FEATURES_ML: stored.filter(last == "3").withColumn("pnn50", F.lit(-1.0)),
            K.RECORD_FEATURES: record.filter(last == "3").withColumn("window_count_total", F.lit(-1)),
        },
        record.filter(last.isin("3", "7")).select("record_id"),
    )
    return run


def _published_rows(run: Publication) -> DataFrame:
    record = run.read(K.RECORD_FEATURES).select("record_id", F.col("window_count_total").alias("windows"))
    found = run.read(K.WINDOW_FEATURES_ML).join(record, "record_id")
    return rounded(found.select("record_id", "window_start_sec", "n_rr", "pnn50", "windows"))


@query("publish_generations", curated_sql(BY_USER) + PUBLISHED_SQL)
def _(spark, sf_dir):
    return _published_rows(_published(spark, sf_dir))


@query("publish_compacted", curated_sql(BY_USER) + PUBLISHED_SQL)
def _(spark, sf_dir):
    run = _published(spark, sf_dir)
    run.compact()
    run.remove_unreferenced()
    return _published_rows(run)


# --- streams -------------------------------------------------------------------------------

DELIVERIES = 6
ARRIVAL_LAG = 21_600  # seconds: events arrive up to six hours late and out of order


@query("window_features_live", curated_sql(BY_TYPE) + take(CURATED_COLS, "curated"))
def _(spark, sf_dir):
    root = _fresh_root(spark)
    delivered, delay, last = views.deliver_events(spark, sf_dir, root, "event_type", DELIVERIES, ARRIVAL_LAG)
    end = last + delay + 2 * BY_TYPE.width_sec
    per_trigger = max(1, len(delivered.inputFiles()) // DELIVERIES)
    end_of_stream(delivered, end).write.mode("append").parquet(f"{root}/inbox")
    stream = (
        spark.readStream.schema(delivered.schema)
        .option("maxFilesPerTrigger", per_trigger).parquet(f"{root}/inbox")
    )
    summary = live_windows(stream, f"{delay} seconds", BY_TYPE)
    publish_windows(summary, f"{root}/windows", f"{root}/progress").awaitTermination()
    closed = spark.read.schema(summary.schema).parquet(f"{root}/windows")
    return rounded(windows.curated_windows(closed))
