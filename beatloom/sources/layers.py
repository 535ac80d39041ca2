"""Reading the layer tables: <root>/<layer>/<artifact>/run_date=/run_id=/record_id=/part files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatloom import constants as K
from beatloom import schemas
from beatloom.sources.records import RecordFilter

# Most record ids to spell out in a partition filter.
MAX_LISTED = 1_000

SCHEMAS: dict[str, T.StructType] = {
    K.ECG: schemas.RAW_ECG,
    K.RR_INTERVALS: schemas.RR_INTERVALS,
    K.WINDOW_FEATURES: schemas.WINDOW_FEATURES,
    K.WINDOW_FEATURES_ML: schemas.WINDOW_FEATURES_ML,
    K.RECORD_FEATURES: schemas.RECORD_FEATURES,
}


def artifact_path(root: str, layer: str, artifact: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{artifact}"


def artifact_key(layer: str, artifact: str, run_date: str, run_id: str) -> str:
    """Object key of a run's part of a layer table, without scheme or root."""
    return f"{layer}/{artifact}/run_date={run_date}/run_id={run_id}"


def run_path(
    spark: SparkSession, root: str, layer: str, artifact: str, run_id: str, run_date: str
) -> str:
    """Folder of a run's part of a layer table, spelled as Spark's writer spells it."""
    spelled = [f"run_date={escaped(spark, run_date)}", f"run_id={escaped(spark, run_id)}"]
    return "/".join([artifact_path(root, layer, artifact), *spelled])


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in a path."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence through Hadoop, for any file system; its errors surface."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()).exists(location)


def read_layer(spark: SparkSession, root: str, layer: str, artifact: str) -> DataFrame:
    """A whole layer table with its declared schema; an unwritten one reads as empty.

    The schema is given, so ids that look like numbers or dates stay strings, and no file is
    opened to infer anything.
    """
    schema = SCHEMAS[artifact]
    path = artifact_path(root, layer, artifact)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_record_files(spark: SparkSession, root: str, layer: str, artifact: str) -> DataFrame:
    """The other layout in use: one file or folder per record, named after the artifact, under
    <root>/<layer>/run_date=/run_id=/record_id=/."""
    base = f"{root.rstrip('/')}/{layer}"
    schema = SCHEMAS[artifact]
    return (
        spark.read.schema(schema)
        .option("basePath", base)
        .parquet(f"{base}/run_date=*/run_id=*/record_id=*/{artifact}.parquet")
        .select(*schema.fieldNames())
    )


def read_run(
    spark: SparkSession,
    root: str,
    layer: str,
    artifact: str,
    run_id: str,
    run_date: str,
    records: RecordFilter | DataFrame | None = None,
) -> DataFrame:
    """One run's rows, optionally of some records: only the run's folder is listed, however many
    runs the table holds, and partition filters spare the other records.

    A short DataFrame of `record_id`s becomes a list in the filter, a longer one a semi-join.
    """
    schema, path = SCHEMAS[artifact], run_path(spark, root, layer, artifact, run_id, run_date)
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    base = artifact_path(root, layer, artifact)
    table = spark.read.schema(schema).option("basePath", base).parquet(path)
    table = table.select(*schema.fieldNames())
    if isinstance(records, RecordFilter):
        return table.filter(records.condition())
    if records is not None:
        first = [r.record_id for r in records.select("record_id").limit(MAX_LISTED + 1).collect()]
        if len(first) <= MAX_LISTED:
            return table.filter(F.col("record_id").isin(first) if first else F.lit(False))
        return table.join(records.select("record_id"), "record_id", "left_semi").select(
            *table.columns
        )
    return table


def read_rr(
    spark: SparkSession, root: str, run_id: str, run_date: str, records=None
) -> DataFrame:
    return read_run(spark, root, K.PROCESSED, K.RR_INTERVALS, run_id, run_date, records)
