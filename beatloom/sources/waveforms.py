"""Decoded multi-lead waveforms as sample rows. Narrow work: no shuffle, one pass.

A recording is one row, or as many rows as it has chunks: with a column `first_sample`, the position of
the chunk's first sample in its recording, no row has to hold a whole recording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FIRST_SAMPLE = "first_sample"


def _offset(waveforms: DataFrame) -> Column:
    whole = F.col(FIRST_SAMPLE) if FIRST_SAMPLE in waveforms.columns else F.lit(0)
    return whole.cast("long")


def _kept_samples(slice_seconds, offset: Column) -> tuple[Column, Column]:
    """(sampling rate as a whole number, first channel cut to the slice)."""
    fs = F.col("fs").try_cast("int")
    first = F.get("signal", F.lit(0))
    seconds = _whole_seconds(slice_seconds)
    if seconds is None:
        return fs, first
    # In long arithmetic, up to the samples there are; a rate that is not positive keeps none.
    left = fs.cast("long") * F.lit(seconds).cast("decimal(38,0)") - offset
    wanted = F.greatest(F.least(left, F.size(first)), F.lit(0))
    kept = F.when(fs > 0, F.slice(first, F.lit(1), wanted.cast("int"))).otherwise(
        F.slice(first, F.lit(1), F.lit(0))
    )
    return fs, kept


def _whole_seconds(slice_seconds) -> int | None:
    """A positive whole number of seconds, or None (no slicing) for anything else."""
    try:
        seconds = int(str(slice_seconds).strip())
    except ValueError:
        return None
    return seconds if seconds > 0 else None


def ingest_waveforms(
    waveforms: DataFrame, run_id: str, run_date: str, slice_seconds=None
) -> DataFrame:
    """One row per sample of the first two leads; a missing second lead reads as zeros.

    The leads are zipped before they are exploded so that no row drags the whole record along.
    """
    offset = _offset(waveforms)
    fs, kept = _kept_samples(slice_seconds, offset)
    two = F.size("signal") >= 2
    zipped = F.arrays_zip(
        kept.alias("a"),
        F.when(two, F.slice(F.get("signal", F.lit(1)), F.lit(1), F.size(kept))).alias("b"),
    )
    leads = (
        F.when(two, zipped)
        .otherwise(F.transform(kept, lambda v: F.struct(v.alias("a"), F.lit(0.0).alias("b"))))
        .alias("leads")
    )
    return waveforms.select("record_id", fs.alias("fs"), offset.alias("at"), leads).select(
        "record_id", "fs", "at", F.posexplode("leads").alias("position", "lead")
    ).withColumn("sample_index", F.col("at") + F.col("position")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(run_date).alias("run_date"),
        "record_id",
        "sample_index",
        (F.col("sample_index") / F.col("fs").cast("double")).alias("t_sec"),
        F.col("lead")["a"].cast("double").alias("lead_0"),
        F.col("lead")["b"].cast("double").alias("lead_1"),
    )


def waveform_quality(waveforms: DataFrame, run_id: str, slice_seconds=None) -> DataFrame:
    """Sampling rate, kept samples, channels (at most two) and annotation flag per record.

    Chunks that overlap, leave gaps or differ in rate or channels count as no samples at all.
    """
    offset = _offset(waveforms)
    fs, kept = _kept_samples(slice_seconds, offset)
    rows = waveforms.select(
        F.lit(run_id).alias("run_id"),
        "record_id",
        fs.alias("sampling_hz"),
        F.size(kept).cast("long").alias("n_samples"),
        F.when(F.size("signal") >= 2, 2).otherwise(1).alias("n_channels"),
        F.coalesce("has_annotation", F.lit(False)).alias("atr_exists"),
        offset.alias("_from"),
        F.size(F.get("signal", F.lit(0))).cast("long").alias("_size"),
    )
    if FIRST_SAMPLE not in waveforms.columns:
        return rows.drop("_from", "_size")
    same = lambda c: F.min(c).eqNullSafe(F.max(c))
    # Without a chunk's start twice, the sizes add up to the end only if nothing is missing.
    whole = (
        (F.sum("_size") == F.max(F.col("_from") + F.col("_size"))) & (F.min("_from") == 0)
        & (F.count_distinct("_from") == F.count(F.lit(1))) & same("sampling_hz") & same("n_channels")
    )
    return rows.groupBy("run_id", "record_id").agg(
        F.max("sampling_hz").alias("sampling_hz"),
        F.when(whole, F.sum("n_samples")).otherwise(0).alias("n_samples"),
        F.max("n_channels").alias("n_channels"),
        F.bool_or("atr_exists").alias("atr_exists"),
    )


def readable(quality: DataFrame) -> DataFrame:
    """Rows of `waveform_quality` whose record has samples and a positive sampling rate, and comes
    once: of a repeated record no one can tell which samples are meant."""
    good = quality.filter((F.col("sampling_hz") > 0) & (F.col("n_samples") > 0))
    repeated = quality.groupBy("record_id").count().filter("count > 1")
    return good.join(repeated, "record_id", "left_anti").select(*quality.columns)
