"""Writing layer tables: one Spark job per table, replaced by record, repeatable after a failure."""

from __future__ import annotations

from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.session import ensure_checkpoint_dir
from beatloom.sources.layers import artifact_path, escaped, path_exists, read_run, run_path


class PartialOutputError(RuntimeError):
    """Exactly one of two tables that belong together exists; rerun with overwrite."""


class OutputState(Enum):
    SKIP = "skip"
    RUN = "run"


def output_state(first_exists: bool, second_exists: bool, overwrite: bool) -> OutputState:
    """Skip when both outputs exist, run when neither does or on overwrite, else fail."""
    if overwrite or not (first_exists or second_exists):
        return OutputState.RUN
    if first_exists and second_exists:
        return OutputState.SKIP
    raise PartialOutputError("only one of two outputs exists; rerun with overwrite")


# --- completeness --------------------------------------------------------------------------


def _marker(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> str:
    return f"{run_path(spark, root, layer, artifact, run_id, run_date)}/_SUCCESS"


def is_complete(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> bool:
    """Whether the run's part of the table was written to its end."""
    return path_exists(spark, _marker(spark, root, layer, artifact, run_id, run_date))


def mark_complete(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> None:
    """Set the run's marker, also for a run without rows. Readers ignore the file."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_marker(spark, root, layer, artifact, run_id, run_date))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()


def mark_incomplete(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> None:
    """Take the marker away before the table changes."""
    _delete(spark, _marker(spark, root, layer, artifact, run_id, run_date))


def _delete(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written_records(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> DataFrame:
    """Records of the run that have rows; only partition values are read."""
    return read_run(spark, root, layer, artifact, run_id, run_date).select("record_id").distinct()


def split_pending(
    records: DataFrame, written: DataFrame, overwrite: bool
) -> tuple[DataFrame, DataFrame]:
    """(skipped, pending) of the listed `record_id`s: those with output are skipped."""
    if overwrite:
        return records.limit(0), records
    done = written.select("record_id").distinct()
    return (
        records.join(done, "record_id", "left_semi"),
        records.join(done, "record_id", "left_anti"),
    )


# --- writing -------------------------------------------------------------------------------


def write_layer(
    df: DataFrame, root: str, layer: str, artifact: str, by_record: bool = True,
    rebalance: bool = True,
) -> None:
    """Write rows into their run (and record) partitions, replacing just the partitions they touch.

    The rebalance hint packs small records into common tasks and splits a heavy one over several,
    so neither many tiny files nor one huge task results. Rows that come out of their source
    record by record are written where they are, without a shuffle.
    """
    partition = ["run_date", "run_id", *(["record_id"] if by_record else [])]
    (
        (df.hint("rebalance", F.col("record_id")) if rebalance else df)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(artifact_path(root, layer, artifact))
    )


def write_records(
    df: DataFrame, records: DataFrame, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> None:
    """Replace the listed records in a table with one partition per record.

    A listed record that has no rows any more loses its old partition.
    """
    spark = df.sparkSession
    base = run_path(spark, root, layer, artifact, run_id, run_date)
    stale = []
    if path_exists(spark, base):
        before = written_records(spark, root, layer, artifact, run_id, run_date)
        emptied = (
            before.join(records.select("record_id"), "record_id", "left_semi")
            .join(df.select("record_id").distinct(), "record_id", "left_anti")
        )
        stale = [r.record_id for r in emptied.toLocalIterator()]
    write_layer(df, root, layer, artifact)
    for record_id in stale:
        _delete(spark, f"{base}/record_id={escaped(spark, record_id)}")
    mark_complete(spark, root, layer, artifact, run_id, run_date)


def write_run_level(
    df: DataFrame, records: DataFrame, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> None:
    """Replace the listed records in a table with one partition per run; other records stay.

    The merged rows are checkpointed first, because they come from the partition they replace. If
    none are left, the old partition goes: an overwrite by no rows would not touch it.
    """
    spark = df.sparkSession
    mark_incomplete(spark, root, layer, artifact, run_id, run_date)
    others = read_run(spark, root, layer, artifact, run_id, run_date).join(
        records.select("record_id"), "record_id", "left_anti"
    )
    if path_exists(spark, artifact_path(root, layer, artifact)):
        ensure_checkpoint_dir(spark)
        df = df.unionByName(others.select(*df.columns)).checkpoint()
        if df.isEmpty():
            _delete(spark, run_path(spark, root, layer, artifact, run_id, run_date))
    write_layer(df, root, layer, artifact, by_record=False)
    mark_complete(spark, root, layer, artifact, run_id, run_date)


# --- looking -------------------------------------------------------------------------------


class NoRowsError(LookupError):
    """Nothing to preview for the run and record."""


# The columns a preview shows.
PREVIEW_COLUMNS = [
    "window_start_sec", "n_rr", "mean_rr_ms", "sdnn_ms", "rmssd_ms", "pnn50", "heart_rate_bpm",
    "window_valid",
]


def preview(window_ml: DataFrame, run_id: str, record_id: str, limit: int = 3) -> DataFrame:
    """First windows of one record, by start."""
    rows = window_ml.filter((F.col("run_id") == run_id) & (F.col("record_id") == record_id))
    if rows.isEmpty():
        raise NoRowsError(f"no windows for run {run_id!r}, record {record_id!r}")
    return rows.orderBy("window_start_sec").limit(max(0, limit)).select(
        *PREVIEW_COLUMNS
    )
