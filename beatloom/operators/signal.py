"""Waveform samples -> beat positions -> beat intervals.

Samples are grouped by (record, segment) with a margin of neighbouring samples on each side, so a
recording of any length is spread over many tasks, each of bounded size. The numeric kernel sees
one such segment as Arrow columns.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.functions.ordered import block_split, drop_segments, with_previous
from beatloom.functions.quantiles import exact_median, value_counts
from beatloom.session import broadcast_if_small, ensure_checkpoint_dir

SEGMENT_SAMPLES = 65_536
BLOCK_ROWS = 1_000_000


@dataclass(frozen=True)
class DetectorWidths:
    """Half-widths and lengths in seconds, after Pan and Tompkins (1985)."""

    baseline: float = 0.3
    energy: float = 0.075
    refractory: float = 0.2
    threshold_block: float = 2.0
    threshold_tenths: int = 3

    def in_samples(self, fs: float) -> tuple[int, int, int, int]:
        fs = round(fs, 6)  # the last bits of a measured rate must not decide a width
        return (
            max(1, round(self.baseline * fs)),
            max(1, round(self.energy * fs)),
            max(1, round(self.refractory * fs)),
            max(1, round(self.threshold_block * fs)),
        )


# --- sampling rate -------------------------------------------------------------------------


def sample_steps(
    samples: DataFrame, keys: Sequence[str] = K.RECORD_COLS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Time from each sample to the one before it in the record."""
    split = block_split(keys, "sample_index", block_rows)
    seen = with_previous(
        samples.select(*keys, "sample_index", "t_sec"), split, {"_prev_sec": "t_sec"}
    )
    return drop_segments(seen).select(
        *keys, "sample_index", (F.col("t_sec") - F.col("_prev_sec")).alias("dt_sec")
    )


def infer_sampling_rate(
    samples: DataFrame, keys: Sequence[str] = K.RECORD_COLS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(rates, errors) per record: `fs` = 1 / median positive time step.

    Records of fewer than two samples are in neither; those without a positive, finite step are
    errors with a `reason`, and do not stop the others.
    """
    ensure_checkpoint_dir(samples.sparkSession)
    # A steadily sampled record has a handful of distinct steps, so this table is small. It is read
    # several times below; checkpointing it shuffles the samples only once.
    counts = value_counts(sample_steps(samples, keys, block_rows), keys, "dt_sec").checkpoint()
    positive = counts.filter((F.col("dt_sec") > 0) & ~F.isnan("dt_sec"))
    median = exact_median(positive, keys, "dt_sec", "_step")
    rates = median.filter(F.col("_step") < F.lit(float("inf"))).select(
        *keys, (F.lit(1.0) / F.col("_step")).alias("fs")
    )
    errors = _without_rate(counts.groupBy(*keys).agg(F.sum("n").alias("steps")), rates, keys)
    return rates, errors


def steady_rates(
    samples: DataFrame, keys: Sequence[str] = K.RECORD_COLS, tolerance: float = 1e-6
) -> tuple[DataFrame, DataFrame]:
    """(rates, spans): the rate of every record whose samples lie on an even time grid.

    Two passes of map-side aggregates and no shuffle of samples: the grid follows from a record's
    first and last sample, then the largest distance of any sample from it is measured. Within
    `tolerance` of a step, the rate equals the one from the median step to as many parts.
    `spans` holds the sample count of every record.
    """
    keys = list(keys)
    at, t = F.col("sample_index"), F.col("t_sec")
    spans = samples.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_samples"), F.count(t).alias("_timed"),
        F.min(at).alias("_i0"), F.max(at).alias("_i1"), F.min(t).alias("_t0"), F.max(t).alias("_t1"),
    ).checkpoint()
    steps = F.col("_i1") - F.col("_i0")
    grid = spans.filter(
        (F.col("n_samples") > 1) & (F.col("_timed") == F.col("n_samples"))
        & (steps + 1 == F.col("n_samples")) & (F.col("_t1") > F.col("_t0"))
    ).select(*keys, "_i0", "_t0", (steps / (F.col("_t1") - F.col("_t0"))).alias("fs"))
    off = F.abs((t - F.col("_t0")) * F.col("fs") - (at - F.col("_i0")))
    rates = (
        samples.select(*keys, at, t).join(broadcast_if_small(grid), keys)
        .groupBy(*keys, "fs").agg(F.max(off).alias("_off"))
        .filter(F.col("_off") <= tolerance)
        .select(*keys, "fs")
    )
    return rates, spans.select(*keys, "n_samples")


def sampling_rates(
    samples: DataFrame, keys: Sequence[str] = K.RECORD_COLS, block_rows: int = BLOCK_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(rates, errors) of all records: evenly sampled ones without a shuffle, the others by
    `infer_sampling_rate`."""
    keys = list(keys)
    ensure_checkpoint_dir(samples.sparkSession)
    steady, spans = steady_rates(samples, keys)
    steady = steady.checkpoint()
    others = spans.filter(F.col("n_samples") > 1).join(steady, keys, "left_anti").checkpoint()
    uneven = samples.join(broadcast_if_small(others.select(*keys)), keys, "left_semi")
    rates = steady
    if not others.isEmpty():
        inferred, _ = infer_sampling_rate(uneven, keys, block_rows)
        rates = steady.unionByName(inferred).checkpoint()
    return rates, _without_rate(others.select(*keys, (F.col("n_samples") - 1).alias("steps")), rates, keys)


def _without_rate(records: DataFrame, rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    reason = F.lit("no positive finite time step to infer a sampling rate").alias("reason")
    return records.join(rates, list(keys), "left_anti").select(*keys, "steps", reason)


# --- segments ------------------------------------------------------------------------------


def _segmented(
    samples: DataFrame, rates: DataFrame, keys: Sequence[str], margin_sec: float, length: int
) -> DataFrame:
    """Each sample in its own segment and, near an edge, in the neighbour's margin as well."""
    rated = samples.join(broadcast_if_small(rates.select(*keys, "fs")), list(keys))
    margin = F.ceil(F.col("fs") * F.lit(margin_sec)).cast("long")
    size = F.greatest(F.lit(length).cast("long"), margin * 2)
    at = F.col("sample_index")
    first = F.greatest(F.floor((at - margin) / size), F.lit(0).cast("long"))
    return rated.withColumn(
        "_segment", F.explode(F.sequence(first, F.floor((at + margin) / size)))
    ).groupBy(*keys, "_segment")


def _own(index: np.ndarray, segment: int, fs: float, margin_sec: float, length: int) -> np.ndarray:
    """Which positions belong to the segment itself rather than to its margins."""
    return index // max(length, 2 * math.ceil(fs * margin_sec)) == segment


def _moving_sum(x: np.ndarray, half: int) -> np.ndarray:
    """Sum over 2 * half + 1 values around each position; the edges without full support are cut."""
    total = np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
    return total[2 * half + 1 :] - total[: -(2 * half + 1)]


def _mirrored(x: np.ndarray, width: int) -> np.ndarray:
    """`x` with `width` more values on both sides, reflected at its end values as often as needed."""
    turn = 2 * (len(x) - 1)
    at = np.arange(-width, len(x) + width) % turn
    return x[np.minimum(at, turn - at)]


def _sorted_columns(table: pa.Table, *names: str) -> list[np.ndarray]:
    index = table.column("sample_index").to_numpy()
    order = np.argsort(index, kind="stable")
    return [index[order], *(table.column(n).to_numpy()[order] for n in names)]


def _filled(x: np.ndarray) -> np.ndarray:
    """Missing samples take the last value before them, those at the start the first value."""
    if x.dtype.kind != "f":
        return x
    known = np.isfinite(x)
    if known.all() or not known.any():
        return x
    last = np.maximum.accumulate(np.where(known, np.arange(len(x)), -1))
    return x[np.where(last < 0, known.argmax(), last)]


# --- cleaning ------------------------------------------------------------------------------


def clean_signal(
    samples: DataFrame,
    rates: DataFrame,
    keys: Sequence[str] = K.RECORD_COLS,
    widths: DetectorWidths = DetectorWidths(),
    segment_samples: int = SEGMENT_SAMPLES,
) -> DataFrame:
    """`lead_0` minus its moving mean as `cleaned`; unfiltered where the mean has no full support."""
    keys = list(keys)
    schema = samples.select(*keys, "sample_index", F.col("lead_0").cast("double").alias("cleaned"))
    margin = widths.baseline + 0.1

    def clean(key: tuple, table: pa.Table) -> pa.Table:
        index, x = _sorted_columns(table, "lead_0")
        x, fs = _filled(x.astype(np.float64)), table.column("fs")[0].as_py()
        half = widths.in_samples(fs)[0]
        cleaned = x.copy()
        if len(x) > 2 * half:
            cleaned[half:-half] -= _moving_sum(x, half) / (2 * half + 1)
        own = _own(index, key[-1].as_py(), fs, margin, segment_samples)
        return _keyed(key[:-1], keys, sample_index=index[own], cleaned=cleaned[own])

    needed = samples.select(*keys, "sample_index", "lead_0")
    grouped = _segmented(needed, rates, keys, margin, segment_samples)
    return grouped.applyInArrow(clean, schema.schema)


def _keyed(key: tuple, keys: Sequence[str], **columns: np.ndarray) -> pa.Table:
    """Arrow table of `columns` with the group's key values in front."""
    rows = len(next(iter(columns.values())))
    ids = {name: pa.repeat(value, rows) for name, value in zip(keys, key)}
    return pa.table({**ids, **{n: pa.array(c) for n, c in columns.items()}})


# --- detection -----------------------------------------------------------------------------


def _beats(x: np.ndarray, index: np.ndarray, fs: float, widths: DetectorWidths) -> np.ndarray:
    """Positions of beats in a stretch of contiguous samples.

    High-passed signal, five-point slope, squared and summed into an energy. A beat is a local
    maximum of the high-passed signal whose energy exceeds a share of the largest energy in its
    block and the two blocks beside it, and which is the highest such maximum within the
    refractory time (first one on ties). Nothing is divided, so integer input stays exact. The signal
    is mirrored at both ends, so that the filters reach them; the end samples themselves, which
    have a neighbour on one side only, are no maxima.
    """
    base, energy_half, refractory, block = widths.in_samples(fs)
    if len(x) < 3:
        return np.empty(0, np.int64)
    x = _mirrored(x, base + energy_half + 2)
    high = x[base:-base] * (2 * base + 1) - _moving_sum(x, base)
    slope = 2 * high[4:] + high[3:-1] - high[1:-3] - 2 * high[:-4]
    energy = _moving_sum(slope * slope, energy_half)
    inner = energy_half + 2
    high_here, left, right = high[inner:-inner], high[inner - 1 : -inner - 1], high[inner + 1 :]
    right = right[: len(high_here)]

    blocks = index // block
    starts = np.flatnonzero(np.r_[True, np.diff(blocks) > 0])
    peak = np.maximum.reduceat(energy, starts)
    near = peak.copy()
    near[1:] = np.maximum(near[1:], peak[:-1])
    near[:-1] = np.maximum(near[:-1], peak[1:])
    limit = np.repeat(near, np.diff(np.r_[starts, len(energy)]))

    found = np.flatnonzero(
        (energy * 10 > limit * widths.threshold_tenths) & (high_here > left) & (high_here >= right)
    )
    found = found[(found > 0) & (found < len(energy) - 1)]
    height, keep, step = high_here[found], np.ones(len(found), bool), 1
    while step < len(found):
        close = found[step:] - found[:-step] <= refractory
        if not close.any():
            break
        later_wins = height[step:] > height[:-step]
        keep[:-step] &= ~(close & later_wins)
        keep[step:] &= ~(close & ~later_wins)
        step += 1
    return found[keep]


def detect_peaks(
    samples: DataFrame,
    rates: DataFrame,
    keys: Sequence[str] = K.RECORD_COLS,
    widths: DetectorWidths = DetectorWidths(),
    segment_samples: int = SEGMENT_SAMPLES,
) -> DataFrame:
    """(keys, `peak_index`, `t_peak_sec`) of the beats on `lead_0`, whatever the segmentation.

    Samples of a record are contiguous in `sample_index`. At a record's ends the filters see its
    mirror image; its first and last sample are never beats.
    """
    keys = list(keys)
    out = samples.select(
        *keys, F.col("sample_index").alias("peak_index"), F.col("t_sec").alias("t_peak_sec")
    )
    margin = 3 * widths.threshold_block + widths.baseline + widths.energy + widths.refractory

    def detect(key: tuple, table: pa.Table) -> pa.Table:
        index, x, t = _sorted_columns(table, "lead_0", "t_sec")
        fs = table.column("fs")[0].as_py()
        peaks = _beats(_filled(x), index, fs, widths)
        if x.dtype.kind == "f":
            peaks = peaks[np.isfinite(x[peaks])]  # no beat on a sample that is not there
        peaks = peaks[_own(index[peaks], key[-1].as_py(), fs, margin, segment_samples)]
        return _keyed(key[:-1], keys, peak_index=index[peaks], t_peak_sec=t[peaks])

    needed = samples.select(*keys, "sample_index", "t_sec", "lead_0")
    grouped = _segmented(needed, rates, keys, margin, segment_samples)
    return grouped.applyInArrow(detect, out.schema)


# --- intervals -----------------------------------------------------------------------------


def sanitize_peaks(
    peaks: DataFrame, lengths: DataFrame, keys: Sequence[str] = K.RECORD_COLS
) -> DataFrame:
    """Peaks inside their record (`n_samples` in `lengths`), each position once."""
    keys = list(keys)
    inside = F.col("peak_index").between(F.lit(0), F.col("n_samples") - 1)
    return (
        peaks.join(lengths.select(*keys, "n_samples"), keys)
        .filter(inside)
        .drop("n_samples")
        .dropDuplicates([*keys, "peak_index"])
    )


def record_lengths(samples: DataFrame, keys: Sequence[str] = K.RECORD_COLS) -> DataFrame:
    return samples.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_samples"))


def rr_intervals(
    peaks: DataFrame, keys: Sequence[str] = K.RECORD_COLS, block_rows: int = 50_000_000
) -> DataFrame:
    """Beats numbered by position, with the time since the previous beat (NULL on the first).

    A block spans `block_rows` sample positions, which hold at most that many beats.
    """
    split = block_split(keys, "peak_index", block_rows)
    seen = drop_segments(
        with_previous(peaks, split, {"_prev_sec": "t_peak_sec"}, index="beat_index")
    )
    return seen.select(
        *keys, "beat_index", "peak_index", "t_peak_sec",
        (F.col("t_peak_sec") - F.col("_prev_sec")).alias("rr_interval_sec"),
    )


def beats_from_samples(
    samples: DataFrame,
    keys: Sequence[str] = K.RECORD_COLS,
    rates: DataFrame | None = None,
    widths: DetectorWidths = DetectorWidths(),
    segment_samples: int = SEGMENT_SAMPLES,
) -> tuple[DataFrame, DataFrame | None]:
    """(interval table, errors). Known `rates` save the passes that find them.

    Rates and peaks are checkpointed: both are small next to the samples and read more than once.
    """
    ensure_checkpoint_dir(samples.sparkSession)
    errors = None
    if rates is None:
        rates, errors = sampling_rates(samples, keys)
    peaks = detect_peaks(samples, rates, keys, widths, segment_samples).checkpoint()
    return rr_intervals(peaks, keys), errors


def processing_metrics(rr: DataFrame, records: DataFrame | None = None) -> DataFrame:
    """Beats, mean and deviation per record; records without beats count zero and stay NULL."""
    keys = K.RECORD_KEY
    rr_sec = F.col("rr_interval_sec")
    metrics = rr.groupBy(*keys).agg(
        F.count(F.lit(1)).cast("int").alias("n_beats"),
        (F.avg(rr_sec) * 1000).alias("mean_rr_ms"),
        (F.stddev_samp(rr_sec) * 1000).alias("sdnn_ms"),
    )
    if records is None:
        return metrics
    return records.select(*keys).distinct().join(metrics, keys, "left").fillna(0, ["n_beats"])
