"""Windows of a beat stream, each published once, when no beat of it can still arrive in time.

State per record: the beats of windows that are still open, the last beat of the closed ones and the
interval it ended. Nothing else is kept, so state is bounded by the beats of the delay and one window.
Rows are those of the batch plan's `window_summary`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from beatloom import constants as K
from beatloom.operators.windows import window_quality
from beatloom.plans.features import FeatureParams

# A stream's watermark starts at zero and drops what is not past it, but beats count from a record's start:
# event times lie a day later, so that beats from a day before zero on are taken.
_ORIGIN_MS = 86_400_000
_STATE = "open_t array<double>, open_index array<long>, last_t double, last_rr_ms double"
_ROW = {
    "window_start_sec": "double", "window_end_sec": "double", "mean_rr_ms": "double", "sdnn_ms": "double",
    "rmssd_ms": "double", "pnn50": "double", "n_rr": "long", "_first_sec": "double", "_last_sec": "double",
    "_diff_n": "long", "_diff_mean": "double", "_diff_var": "double", "_diff_above": "long",
}
_SCHEMA = ", ".join(f"{c} string" for c in K.RECORD_COLS) + ", " + ", ".join(f"{c} {t}" for c, t in _ROW.items())


def _summaries(
    t: np.ndarray, last_t: float, last_rr: float, params: FeatureParams
) -> tuple[pd.DataFrame, float]:
    """Summaries of closed beats in order, NaN for what is undefined, and the last interval.

    `last_t` and `last_rr` are those of the beat before, or NaN.
    """
    rr = (t - np.append(last_t, t[:-1])) * 1000
    near = rr - np.append(last_rr, rr[:-1])
    start = np.floor(t / params.width_sec) * params.width_sec
    # The beat before the first one lies in a window closed earlier.
    step = np.where(start == np.append(np.nan, start[:-1]), near, np.nan)
    beats = pd.DataFrame({"start": start, "t": t, "rr": rr, "near": near, "step": step})
    beats = beats[~np.isnan(rr)]
    beats = beats.assign(
        square=beats["step"] ** 2, far=(beats["step"].abs() > params.pnn50_ms).astype("int64"),
        above=(beats["near"].abs() > params.pnn20_ms).astype("int64"),
    )
    per = beats.groupby("start")
    out = pd.DataFrame({
        "mean_rr_ms": per["rr"].mean(), "sdnn_ms": per["rr"].std(), "rmssd_ms": np.sqrt(per["square"].mean()),
        "pnn50": per["far"].mean(), "n_rr": per["rr"].size(), "_first_sec": per["t"].min(),
        "_last_sec": per["t"].max(), "_diff_n": per["near"].count(), "_diff_mean": per["near"].mean(),
        "_diff_var": per["near"].var(ddof=0), "_diff_above": per["above"].sum(),
    })
    out.insert(0, "window_end_sec", out.index + params.width_sec)
    out.insert(0, "window_start_sec", out.index)
    return out, float(rr[-1])


def live_windows(beats: DataFrame, delay: str, params: FeatureParams = FeatureParams()) -> DataFrame:
    """Window summaries of a stream of beats (run_id, run_date, record_id, t_peak_sec, peak_index).

    Beats may come in any order within `delay`: a beat is late if it lies `delay` or more behind the latest
    beat of all records that the micro-batch before the last one or an earlier one brought (Spark's
    watermark for late rows). Late beats are dropped and counted (`late_beats`). Equal
    times are ordered by the index, none first. A window is published when the latest beat is `delay` past its end.
    Rows without a time are ignored; rows without a record belong to none, but their time counts, so that
    one of them, far ahead, closes what is open (`end_of_stream`). The rows that a micro-batch brings for one
    record meet in one task; the source's limit on files per trigger bounds them. A record keeps one
    small row of state for as long as the stream lives.
    """
    width = params.width_sec

    def advance(
        key: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        open_t, open_index, last_t, last_rr = state.get if state.exists else ([], [], None, None)
        parts = [(open_t, open_index), *((f["t_peak_sec"], f["peak_index"]) for f in frames)]
        if key[-1] is None:
            return
        t = np.concatenate([np.asarray(p, "float64") for p, _ in parts])
        index = np.concatenate([np.asarray(i, "int64") for _, i in parts])
        order = np.lexsort((index, t))
        t, index = t[order], index[order]
        bound = (state.getCurrentWatermarkMs() - _ORIGIN_MS) / 1000 // width * width
        closed = int(np.searchsorted(t, bound))
        if closed:
            before = [np.nan if x is None else x for x in (last_t, last_rr)]
            rows, last_rr = _summaries(t[:closed], *before, params)
            last_t, last_rr = float(t[closed - 1]), None if np.isnan(last_rr) else last_rr
            for at, (name, value) in enumerate(zip(K.RECORD_COLS, key)):
                rows.insert(at, name, value)
            yield rows
        state.update((t[closed:].tolist(), index[closed:].tolist(), last_t, last_rr))
        if closed < len(t):
            end = (t[closed] // width + 1) * width
            # Due once the watermark is past this time, that is, has reached the end.
            state.setTimeoutTimestamp(int(end * 1000) + _ORIGIN_MS - 1)

    timed = (
        beats.filter(F.col("t_peak_sec").isNotNull())
        .select(*K.RECORD_COLS, "t_peak_sec", F.coalesce("peak_index", F.lit(-1)).alias("peak_index"))
        .withColumn("_ts", F.timestamp_millis(F.floor(F.col("t_peak_sec") * 1000) + _ORIGIN_MS))
        .withWatermark("_ts", delay)
    )
    found = timed.groupBy(*K.RECORD_COLS).applyInPandasWithState(
        advance, _SCHEMA, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    numbers = {c: F.nanvl(c, F.lit(None).cast("double")) for c, kind in _ROW.items() if kind == "double"}
    return window_quality(found.withColumns(numbers), width, params.min_rr)


def publish_windows(summary: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append closed windows to Parquet files, each exactly once; started again, it continues.

    By default it takes what has arrived and ends.
    """
    return (
        summary.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def late_beats(query: StreamingQuery) -> int:
    """Beats that came too late, over the micro-batches the query remembers
    (`spark.sql.streaming.numRecentProgressUpdates`)."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def end_of_stream(beats: DataFrame, t_sec: float) -> DataFrame:
    """One row without a record at `t_sec`, with the columns of `beats`."""
    spark = beats.sparkSession
    row = {"t_peak_sec": F.lit(float(t_sec))}
    return spark.range(1).select(
        *[row.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in beats.schema]
    )
