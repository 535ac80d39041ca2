"""Waveform files as a stream: whatever has arrived goes through the three stages of a run.

Takes the place of a timed rerun. With the default trigger the query handles all files that are
new since its last start and ends; started again by any timer, it continues from its checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from beatloom import constants as K
from beatloom import schemas
from beatloom.operators.signal import DetectorWidths
from beatloom.plans.features import FeatureParams
from beatloom.plans.run import Run
from beatloom.sources.records import RecordFilter


class BatchError(RuntimeError):
    """No record of a micro-batch could be worked on."""


def waveform_stream(spark: SparkSession, path: str, max_files: int = 1_000) -> DataFrame:
    """Parquet waveform files under `path`, at most `max_files` per micro-batch."""
    return (
        spark.readStream.schema(schemas.WAVEFORMS)
        .option("maxFilesPerTrigger", max_files)
        .parquet(path)
    )


def process_arrivals(
    waveforms: DataFrame,
    root: str,
    run_id: str,
    run_date: str,
    checkpoint: str,
    params: FeatureParams = FeatureParams(),
    widths: DetectorWidths = DetectorWidths(),
    slice_seconds=None,
    **trigger,
) -> StreamingQuery:
    """Start the query. Each micro-batch replaces exactly the records it brings, in every table, so
    a batch repeated after a failure leaves the same tables as one that ran once. Single broken
    records are counted in the run's metadata; a batch of nothing else is not committed."""

    def handle(batch: DataFrame, _: int) -> None:
        # Ids of one micro-batch, bounded by the files a trigger may take.
        arrived = [r.record_id for r in batch.select("record_id").distinct().collect()]
        if not arrived:
            return
        run = Run(
            batch.sparkSession, root, run_id, run_date, overwrite=True,
            records=RecordFilter(ids=tuple(arrived)),
        )
        for stage in (lambda: run.ingest(batch, slice_seconds), lambda: run.process(widths)):
            if (result := stage()).status == K.FAILED:
                # The batch stays open: the next start takes it again.
                raise BatchError(f"{result.service} failed for all {result.records_failed} records")
        run.aggregate(params)

    return (
        waveforms.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
