"""Helpers the operators share: scratch tables in the shared folder, fresh names, checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from beatloom.session import ensure_checkpoint_dir

BROADCAST_BYTES = 16 << 20

_TABLES: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder, which `clear_scratch` will delete."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}"
    _TABLES.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared checkpoint folder: cut lineage, known size.

    Executors may be lost afterwards; the table is read from shared storage. `clear_scratch`
    deletes the tables of a session once its results are stored.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's scratch tables; results still unread depend on them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for owner, path in [t for t in _TABLES if t[0] is spark]:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
        _TABLES.remove((owner, path))


def broadcast_if_small(
    table: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES, array: str | None = None, item_bytes: int = 0
) -> DataFrame:
    """Broadcast hint for a written table of at most `limit` bytes at `row_bytes` a row in memory.

    Where a row has an `array` of any length, its items count as `item_bytes` each. Counting a written
    table reads only footers, or the array. A larger one keeps a shuffled join, whose heavy keys Spark
    splits at run time; the joined rows are the same.
    """
    size = table.count() * row_bytes
    if array and size <= limit:
        size += (table.agg(F.sum(F.size(array).cast("long"))).first()[0] or 0) * item_bytes
    return F.broadcast(table) if size <= limit else table


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
