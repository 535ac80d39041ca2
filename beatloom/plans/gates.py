"""Contract gates over a run's tables: every violation is a row, nothing is collected.

A: catalog and service states. B0: the interval table has times. B: windows. C: modelling tables and
what must agree between all of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.operators import quality

GATES = ("A", "B0", "B", "C")
REPORT = "gate string, check string, record_id string, detail string"


@dataclass(frozen=True)
class GateTables:
    """The tables of the checked runs; what is None is not checked."""

    rr: DataFrame | None = None
    curated: DataFrame | None = None
    window_ml: DataFrame | None = None
    records: DataFrame | None = None
    listed: DataFrame | None = None
    artifacts: DataFrame | None = None
    service_runs: DataFrame | None = None
    runs: DataFrame | None = None


Check = tuple[str, str, DataFrame]


def _catalog_checks(t: GateTables) -> Iterator[Check]:
    if t.artifacts is not None:
        yield "A", "artifact_version", quality.version_mismatches(t.artifacts)
        kept = (F.col("layer") == K.PROCESSED) & (F.col("artifact_type") == K.RR_INTERVALS)
        found = t.artifacts.groupBy("run_id").agg(F.count_if(kept).alias("interval_tables"))
        yield "A", "no_interval_table", found.filter("interval_tables = 0")
    if t.service_runs is not None:
        yield "A", "failure_not_ended", quality.unended_failures(t.service_runs)
    if t.runs is not None:
        dates = t.runs.select("run_id", F.col("run_date").cast("string").alias("run_date"))
        yield "A", "run_date", quality.bad_run_dates(dates)
    tables = [x.select("run_id", "run_date") for x in (t.rr, t.curated, t.records) if x is not None]
    if tables:
        every = reduce(DataFrame.unionByName, tables)
        yield "A", "several_run_dates", quality.several_run_dates(every)


def _interval_checks(t: GateTables) -> Iterator[Check]:
    if t.rr is not None:
        yield "B0", "missing_column", quality.missing_columns(t.rr, K.RR_INTERVALS)
        listed = t.rr if t.listed is None else t.listed
        yield "B0", "no_beat_times", quality.untimed_records(t.rr, listed)


def _window_checks(t: GateTables, width: float) -> Iterator[Check]:
    if t.curated is None:
        return
    yield "B", "missing_column", quality.missing_columns(t.curated, K.WINDOW_FEATURES)
    yield "B", "misaligned_window", quality.misaligned_windows(t.curated, width)
    yield "B", "coverage", quality.bad_coverage(t.curated, width)
    if t.rr is not None:
        yield "B", "window_count", quality.window_count_mismatches(t.rr, t.curated, width)


def _table_checks(t: GateTables, width: float) -> Iterator[Check]:
    if t.window_ml is not None:
        yield "C", "missing_window_column", quality.missing_columns(t.window_ml, K.WINDOW_FEATURES_ML)
        yield "C", "window_key", quality.bad_window_keys(t.window_ml)
        yield "C", "window_fraction", quality.bad_fractions(t.window_ml, quality.WINDOW_FRACTIONS)
        yield "C", "window_derived", quality.bad_derived(t.window_ml)
        if t.curated is not None:
            yield "C", "window_parity", quality.key_parity(t.curated, t.window_ml)
    if t.records is not None:
        yield "C", "missing_record_column", quality.missing_columns(t.records, K.RECORD_FEATURES)
        yield "C", "fraction", quality.bad_fractions(t.records)
        yield "C", "derived", quality.bad_derived(t.records)
        yield "C", "distribution", quality.bad_distribution(t.records)
        yield "C", "coverage_rollup", quality.bad_coverage_rollup(t.records, width)
        listed = t.records if t.listed is None else t.listed
        yield "C", "not_one_row", quality.not_one_row(t.records, listed)
        if t.curated is not None and t.rr is not None:
            yield "C", "interval_count", quality.count_mismatches(t.curated, t.records, t.rr)


def gate_report(
    tables: GateTables, gates: Sequence[str] = GATES, width_sec: float = K.WINDOW_SEC
) -> DataFrame:
    """(gate, check, record_id, detail) of every violation; `detail` is the offending row as JSON."""
    unknown = set(gates) - set(GATES)
    if unknown:
        raise ValueError(f"no such gate: {', '.join(sorted(unknown))}")
    checks = [
        *_catalog_checks(tables), *_interval_checks(tables),
        *_window_checks(tables, width_sec), *_table_checks(tables, width_sec),
    ]
    rows = [_rows(*check) for check in checks if check[0] in gates]
    if not rows:
        raise ValueError("none of the tables these gates look at is given")
    return reduce(DataFrame.unionByName, rows)


def _rows(gate: str, check: str, wrong: DataFrame) -> DataFrame:
    record = F.col("record_id") if "record_id" in wrong.columns else F.lit(None)
    return wrong.select(
        F.lit(gate).alias("gate"), F.lit(check).alias("check"), record.cast("string").alias("record_id"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in wrong.columns])).alias("detail"),
    )
