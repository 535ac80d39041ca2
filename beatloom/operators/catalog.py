"""Run, artifact and metric tables: keyed upserts, discovery, lineage and their reports.

Latest-wins is an aggregate (`max_by` per key), not a ranking window: it combines map-side, so a
key with a very long history never gathers in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatloom import constants as K


def upsert(
    base: DataFrame, updates: DataFrame, keys: Sequence[str], order: str | Sequence[str]
) -> DataFrame:
    """`base` with `updates` applied: per key an update wins over the base row, whole; `order` picks
    among several updates, and among several base rows where there is none."""
    both = base.withColumn("_update", F.lit(0)).unionByName(updates.withColumn("_update", F.lit(1)))
    return latest(both, keys, ["_update", *_names(order)]).drop("_update")


def latest(df: DataFrame, keys: Sequence[str], order: str | Sequence[str]) -> DataFrame:
    """One row per key: the last by `order`."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    last = df.groupBy(*keys).agg(F.max_by(row, F.struct(*_names(order))).alias("_row"))
    return last.select(*keys, "_row.*").select(*df.columns)


def upsert_run(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Insert runs, or replace date, status and notes of known ones; `created_at` stays."""
    return _merge_lifecycle(
        base, updates, K.RUN_KEY, replaced=["run_date", "status", "notes"], first=["created_at"]
    )


def upsert_lifecycle(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Service states: status and notes are replaced, `started_at` only by a set value, and
    `ended_at` keeps the first value it ever got. `created_at` stays."""
    return _merge_lifecycle(
        base, updates, K.SERVICE_KEY,
        replaced=["status", "notes"], last_set=["started_at"], first=["created_at", "ended_at"],
    )


def _merge_lifecycle(
    base: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    replaced: Sequence[str],
    last_set: Sequence[str] = (),
    first: Sequence[str] = (),
) -> DataFrame:
    """Fold updates, ordered by their `created_at`, into the base rows of the same key."""
    both = base.withColumn("_update", F.lit(0)).unionByName(
        updates.withColumn("_update", F.lit(1))
    )
    return fold_changes(both, keys, ["_update", "created_at"], replaced, last_set, first).select(
        *base.columns
    )


def fold_changes(
    changes: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    replaced: Sequence[str],
    last_set: Sequence[str] = (),
    first: Sequence[str] = (),
) -> DataFrame:
    """Current rows of a change history, column by column, all as combinable aggregates."""
    at = F.struct(*order)

    def when_set(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), at)

    state = F.max_by(F.struct(*replaced), at).alias("_state")
    return (
        changes.groupBy(*keys)
        .agg(
            state,
            *[F.max_by(c, when_set(c)).alias(c) for c in last_set],
            *[F.min_by(c, when_set(c)).alias(c) for c in first],
        )
        .select(*keys, "_state.*", *last_set, *first)
    )


def _names(order: str | Sequence[str]) -> list[str]:
    return [order] if isinstance(order, str) else list(order)


# --- artifacts -----------------------------------------------------------------------------


def artifact_rows(
    records: DataFrame, layer: str, artifact_type: str, uri: str | Column,
    schema_ver: str | None = None,
) -> DataFrame:
    """One artifact row per record; a run-level table gives every record the same `uri`.

    `uri` is an object key: no scheme, no bucket. The version equals the type unless given.
    """
    return records.select("run_id", "record_id").distinct().select(
        "run_id",
        "record_id",
        F.lit(layer).alias("layer"),
        F.lit(artifact_type).alias("artifact_type"),
        (F.lit(uri) if isinstance(uri, str) else uri).alias("uri"),
        F.lit(schema_ver or artifact_type).alias("schema_ver"),
        F.current_timestamp().alias("created_at"),
    )


def discover_artifacts(
    artifacts: DataFrame, run_id: str, layer: str, artifact_type: str, schema_ver: str | None = None
) -> DataFrame:
    """Records (and uris) of a run's artifacts of one kind, by record."""
    found = (
        (F.col("run_id") == run_id)
        & (F.col("layer") == layer)
        & (F.col("artifact_type") == artifact_type)
    )
    if schema_ver is not None:
        found = found & (F.col("schema_ver") == schema_ver)
    return artifacts.filter(found).select("record_id", "uri").orderBy("record_id")


def lineage(artifacts: DataFrame, run_id: str) -> DataFrame:
    return (
        artifacts.filter(F.col("run_id") == run_id)
        .select("layer", "artifact_type", "schema_ver", "record_id")
        .orderBy("layer", "record_id", "artifact_type")
    )


def artifact_consistency(artifacts: DataFrame) -> DataFrame:
    """Rows and distinct uris per run and artifact type."""
    return artifacts.groupBy("run_id", "layer", "artifact_type").agg(
        F.count(F.lit(1)).alias("artifact_rows"), F.countDistinct("uri").alias("distinct_uris")
    )


# --- runs ----------------------------------------------------------------------------------


def run_status(outcomes: DataFrame, keys: Sequence[str] = K.SERVICE_KEY) -> DataFrame:
    """Counts and state from one `outcome` (ok, skipped, failed) per record; skips are successes."""
    def times(outcome: str) -> Column:
        return F.count_if(F.col("outcome") == outcome)

    counts = outcomes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("records_total"),
        times("ok").alias("records_ok"),
        times("skipped").alias("records_skipped"),
        times("failed").alias("records_failed"),
    )
    done = F.col("records_ok") + F.col("records_skipped")
    return counts.withColumn(
        "status",
        F.when(F.col("records_failed") == 0, K.SUCCEEDED)
        .when(done > 0, K.PARTIAL_SUCCESS)
        .otherwise(K.FAILED),
    )


def run_summary(runs: DataFrame, artifacts: DataFrame, features: DataFrame) -> DataFrame:
    """Artifact and feature rows of every run, zero where there are none."""
    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("run_id").agg(F.count(F.lit(1)).alias(name))

    return (
        runs.select("run_id")
        .join(counted(artifacts, "artifact_rows"), "run_id", "left")
        .join(counted(features, "feature_rows"), "run_id", "left")
        .fillna(0, ["artifact_rows", "feature_rows"])
    )


def orphans(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent."""
    known = parents.select(F.col(parent_key).alias(child_key)).distinct()
    return children.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def latest_n(df: DataFrame, order: str | Sequence[str], n: int) -> DataFrame:
    """The n newest rows; partitions are cut to n before they meet."""
    return df.orderBy(*[F.desc(c) for c in _names(order)]).limit(n)
