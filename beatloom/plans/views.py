"""The given tables seen as beat series, waveforms and catalogs. All views cover whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

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
from beatloom.session import ensure_checkpoint_dir

RUN_ID, RUN_DATE = "r1", "2024-01-31"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def beats(
    spark: SparkSession, sf_dir: str, record: str, seconds: float | None = None
) -> tuple[DataFrame, Split]:
    """Events of one record (event type or user) as its beats, and how they are cut.

    Every `seconds` of a record, without looking at the rows, or else where heavy records need it. The numbering here and the successive differences later run on one partitioning and in one order:
    beats of equal time are numbered by the event, so that it orders them as the number does.
    """
    events = table(spark, sf_dir, "events").select(
        F.lit(RUN_ID).alias("run_id"),
        F.lit(RUN_DATE).alias("run_date"),
        F.col(record).cast("string").alias("record_id"),
        F.col("event_id").alias("peak_index"),
        hrv.epoch_seconds("ts").alias("t_peak_sec"),
    )
    order = ["t_peak_sec", "peak_index"]
    split = (
        time_split(K.RECORD_KEY, order, seconds) if seconds
        else plan_split(events.select(*K.RECORD_KEY, *order), K.RECORD_KEY, order)
    )
    numbered = with_previous(events, split, {"_prev_sec": "t_peak_sec"}, index="beat_index")
    interval = F.col("t_peak_sec") - F.col("_prev_sec")
    rr = numbered.withColumn("rr_interval_sec", interval).drop("_prev_sec")
    if split.cuts is not None:
        # As a written interval table would be: the differences of a cut series read it twice.
        ensure_checkpoint_dir(spark)
        rr = rr.checkpoint()
    return rr, split


def intervals(
    spark: SparkSession, sf_dir: str, record: str, seconds: float | None = None
) -> DataFrame:
    """`beats` as a plain interval table."""
    rr, _ = beats(spark, sf_dir, record, seconds)
    return drop_segments(rr).select(
        *K.RECORD_COLS, "beat_index", "peak_index", "t_peak_sec", "rr_interval_sec"
    )


def deliver_events(
    spark: SparkSession, sf_dir: str, root: str, record: str, deliveries: int, lag_seconds: int
) -> tuple[DataFrame, int, float]:
    """Events as beats in files, in the order of their arrival, up to `lag_seconds` after they happened.

    Returns the delivered files as one table, the delay in seconds that no beat exceeds however the files
    of a delivery are mixed, and the time of the last beat. An empty table delivers nothing, and events without a time never come.
    """
    beats = table(spark, sf_dir, "events").select(
        F.lit(RUN_ID).alias("run_id"),
        F.lit(RUN_DATE).alias("run_date"),
        F.col(record).cast("string").alias("record_id"),
        hrv.epoch_seconds("ts").alias("t_peak_sec"),
        F.col("event_id").alias("peak_index"),
    )
    first, last = beats.agg(F.min("t_peak_sec"), F.max("t_peak_sec")).first()
    first, last = first or 0.0, last or 0.0
    span = (last + lag_seconds - first) / deliveries
    arrival = F.col("t_peak_sec") + F.pmod(F.xxhash64("peak_index"), F.lit(lag_seconds))
    number = F.least(F.floor((arrival - first) / span), F.lit(deliveries - 1)).cast("int")
    staged, inbox = f"{root}/staged", f"{root}/inbox"
    beats.withColumn("_delivery", number).write.partitionBy("_delivery").parquet(staged)
    beats.limit(0).write.parquet(inbox)
    parts = spark.read.schema(T.StructType([*beats.schema, T.StructField("_delivery", T.IntegerType())])).parquet(staged)
    for n in range(deliveries):  # one after the other: a stream takes files by their age
        parts.filter(F.col("_delivery") == n).drop("_delivery").write.mode("append").parquet(inbox)
    return spark.read.schema(beats.schema).parquet(inbox), int(span) + lag_seconds + 1, last


def waveforms(spark: SparkSession, sf_dir: str, fs: float = 360.0, leads: int = 1) -> DataFrame:
    """Each embedding vector as a record; the second lead, if any, is the vector reversed."""
    lead = F.col("embedding").cast("array<double>")
    signal = F.array(lead) if leads == 1 else F.array(lead, F.reverse(lead), lead)
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"),
        F.lit(fs).alias("fs"),
        signal.alias("signal"),
        (F.col("label") == 0).alias("has_annotation"),
    )


def chunked(waves: DataFrame, samples: int) -> DataFrame:
    """Waveforms as chunks of that many samples, each with its first sample's position."""
    length = F.size(F.get("signal", F.lit(0)))
    starts = waves.withColumn(
        "first_sample", F.explode(F.sequence(F.lit(0), length - 1, F.lit(samples)))
    )
    cut = F.transform("signal", lambda lead: F.slice(lead, F.col("first_sample") + 1, F.lit(samples)))
    return starts.withColumn("signal", cut)


def samples(
    spark: SparkSession, sf_dir: str, rows_per_segment: int = ROWS_PER_SEGMENT
) -> DataFrame:
    """Event values per event type as a signal of whole numbers, numbered in time order."""
    rr = table(spark, sf_dir, "events").select(
        F.lit(RUN_ID).alias("run_id"),
        F.lit(RUN_DATE).alias("run_date"),
        F.col("event_type").alias("record_id"),
        "event_id",
        hrv.epoch_seconds("ts").alias("t_sec"),
        F.round(F.col("value") * 100).cast("long").alias("lead_0"),
    )
    order = ["t_sec", "event_id"]
    split = plan_split(rr.select(*K.RECORD_KEY, *order), K.RECORD_KEY, order, rows_per_segment)
    return drop_segments(with_previous(rr, split, index="sample_index")).drop("event_id")


def unit_rates(signal: DataFrame) -> DataFrame:
    """One sample per second for every record, so that widths in seconds are widths in samples."""
    return signal.select(*K.RECORD_COLS).distinct().withColumn("fs", F.lit(1.0))


def artifacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as artifact rows: priority = run, order = record, status = layer."""
    def by_status(raw: str, processed: str, other: str) -> Column:
        status = F.col("o_orderstatus")
        return F.when(status == "F", raw).when(status == "O", processed).otherwise(other)

    kind = by_status(K.ECG, K.RR_INTERVALS, K.WINDOW_FEATURES)
    layer = by_status(K.RAW, K.PROCESSED, K.CURATED)
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("run_id"),
        F.col("o_orderkey").cast("string").alias("record_id"),
        layer.alias("layer"),
        kind.alias("artifact_type"),
        F.concat(layer, F.lit("/"), F.col("o_custkey").cast("string")).alias("uri"),
        F.when(F.col("o_totalprice") < 50000, "old_v0").otherwise(kind).alias("schema_ver"),
    )


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a history of service states: customer = run, status = service."""
    priority, day = F.col("o_orderpriority"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("run_id"),
        F.col("o_orderstatus").alias("service"),
        F.when(priority == "1-URGENT", K.FAILED).otherwise(priority).alias("status"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("notes"),
        (day + F.make_dt_interval(secs=F.col("o_orderkey").cast("decimal(18,6)") / 1000000)).alias(
            "created_at"
        ),
        F.when(priority != "5-LOW", day).alias("started_at"),
        F.when(priority == "2-HIGH", day).alias("ended_at"),
    )
