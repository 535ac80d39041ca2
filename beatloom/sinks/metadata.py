"""Metadata tables as change logs: a write appends rows, a read takes the current row per key.

Nothing is rewritten in place, so a failed job leaves no half-updated table behind, and the cost
of an update does not grow with the table. Logs are partitioned by run; reading a run prunes.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatloom import constants as K
from beatloom import schemas
from beatloom.operators.catalog import fold_changes, latest
from beatloom.sources.layers import path_exists

TABLES: dict[str, tuple[T.StructType, list[str]]] = {
    "runs": (schemas.RUNS, K.RUN_KEY),
    "artifacts": (schemas.ARTIFACTS, K.ARTIFACT_KEY),
    "quality_metrics": (schemas.QUALITY_METRICS, K.RECORD_KEY),
    "service_runs": (schemas.SERVICE_RUNS, K.SERVICE_KEY),
    "processing_metrics": (schemas.PROCESSING_METRICS, K.RECORD_KEY),
}


class Metadata:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = f"{root.rstrip('/')}/metadata"

    def append(self, table: str, rows: DataFrame) -> None:
        """Record new versions of `rows`; columns the table has and `rows` lack are NULL."""
        schema, _ = TABLES[table]
        known = {f.name for f in rows.schema}
        stamped = rows.withColumns(
            {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in known}
        )
        if "created_at" not in known:
            stamped = stamped.withColumn("created_at", F.current_timestamp())
        (
            schemas.conform(stamped, schema)
            .withColumn("change_no", F.lit(time.time_ns()))
            .hint("rebalance")
            .write.mode("append")
            .partitionBy("run_id")
            .parquet(f"{self.root}/{table}")
        )

    def append_row(self, table: str, **values) -> None:
        schema, _ = TABLES[table]
        row = self.spark.createDataFrame(
            [tuple(values.get(f.name) for f in schema)], schema
        )
        self.append(table, row.withColumn("created_at", F.current_timestamp()))

    def changes(self, table: str) -> DataFrame:
        schema, _ = TABLES[table]
        logged = T.StructType([*schema.fields, T.StructField("change_no", T.LongType())])
        path = f"{self.root}/{table}"
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], logged)
        return self.spark.read.schema(logged).parquet(path)

    def current(self, table: str) -> DataFrame:
        """One row per business key."""
        schema, keys = TABLES[table]
        log = self.changes(table)
        if table == "runs":
            rows = fold_changes(
                log, keys, ["change_no"], ["run_date", "status", "notes"], first=["created_at"]
            )
        elif table == "service_runs":
            rows = fold_changes(
                log, keys, ["change_no"], ["status", "notes"],
                last_set=["started_at"], first=["created_at", "ended_at"],
            )
        else:
            rows = latest(log, keys, "change_no")
        return rows.select(*schema.fieldNames())
