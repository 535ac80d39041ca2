"""All contract gates of a run in one measured pass: one scan per table, two shuffles for all of them.

Every table is projected to narrow rows of counters under (run, record, window); tables without windows or
records leave those NULL. The rows of all tables are summed per window, which settles repeated keys and
parity, and the sums once more per record and per run together, by grouping sets. Both sums combine
map-side, so a record with very many rows costs a few partial sums.

`observed` counts the row conditions of a table while it is written, without reading it again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.functions.hrv import valid_run_date
from beatloom.operators import quality
from beatloom.plans.gates import GATES, GateTables

METRICS = "gate string, check string, run_id string, record_id string, violations long"

_LEVELS = ["run_id", "record_id"]
_KEYS = [*_LEVELS, "window"]


def row_conditions(artifact: str, width_sec: float = K.WINDOW_SEC) -> dict[str, Column]:
    """Conditions that every row of an artifact has to meet, by the name of their check."""
    return {
        K.WINDOW_FEATURES: {
            "misaligned_window": quality.is_aligned(width_sec), "coverage": quality.coverage_ok(width_sec),
        },
        K.WINDOW_FEATURES_ML: {
            "window_fraction": quality.fractions_ok(quality.WINDOW_FRACTIONS), "window_derived": quality.derived_ok(),
        },
        K.RECORD_FEATURES: {
            "fraction": quality.fractions_ok(quality.RECORD_FRACTIONS), "derived": quality.derived_ok(),
            "distribution": quality.distribution_ok(), "coverage_rollup": quality.coverage_rollup_ok(width_sec),
        },
    }.get(artifact, {})


def observed(
    df: DataFrame, artifact: str, width_sec: float = K.WINDOW_SEC, name: str | None = None
) -> tuple[DataFrame, Observation]:
    """`df`, and the numbers of its rows and of violations that the action on it will have counted.

    A table without one of the columns that a condition needs is an AnalysisException here.
    """
    seen = Observation(name or f"{artifact} checks")
    wrong = [F.count_if(~ok).alias(check) for check, ok in row_conditions(artifact, width_sec).items()]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *wrong), seen


# --- counters -------------------------------------------------------------------------------


def _completed(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Absent columns as NULL: that they are absent is a violation of its own."""
    absent = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("double") for c in absent}) if absent else df


def _counter(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("long")


def _facts(df: DataFrame, window: Column | None = None, **values: Column) -> DataFrame:
    def own(name: str) -> Column:
        known = F.col(name) if name in df.columns else F.lit(None)
        return known.cast("string").alias(name)

    dated = [F.col("run_date").cast("string").alias("run_date")] if values.pop("dated", False) else []
    at = (F.lit(None) if window is None else window).cast("long").alias("window")
    return df.select(*map(own, _LEVELS), at, *dated, *[v.alias(k) for k, v in values.items()])


def _measured(df: DataFrame, artifact: str, width: float) -> dict[str, Column]:
    return {name: _counter(~ok) for name, ok in row_conditions(artifact, width).items()}


def _table_facts(t: GateTables, width: float) -> list[DataFrame]:
    one, start = F.lit(1).cast("long"), F.col("window_start_sec")
    out = []
    if t.rr is not None:
        rr = _completed(t.rr, ["t_peak_sec", "rr_interval_sec"])
        out.append(_facts(
            rr, dated=True, rr_rows=one, timed=_counter(F.col("t_peak_sec").isNotNull()), last=F.col("t_peak_sec"),
            source_n=_counter(F.col("rr_interval_sec").isNotNull()),
        ))
    if t.curated is not None:
        df = _completed(t.curated, quality.REQUIRED_COLUMNS[K.WINDOW_FEATURES])
        out.append(_facts(
            df, start, dated=True, curated_rows=one, window_n=F.col("n_rr").cast("long"),
            **_measured(df, K.WINDOW_FEATURES, width),
        ))
    if t.window_ml is not None:
        df = _completed(t.window_ml, quality.REQUIRED_COLUMNS[K.WINDOW_FEATURES_ML])
        out.append(_facts(df, start, ml_rows=one, **_measured(df, K.WINDOW_FEATURES_ML, width)))
    if t.records is not None:
        df = _completed(t.records, quality.REQUIRED_COLUMNS[K.RECORD_FEATURES])
        out.append(_facts(
            df, dated=True, record_rows=one, record_n=F.col("n_rr").cast("long"),
            **_measured(df, K.RECORD_FEATURES, width),
        ))
    if t.listed is not None:
        out.append(_facts(t.listed, listed=one))
    if t.artifacts is not None:
        kept = (F.col("layer") == K.PROCESSED) & (F.col("artifact_type") == K.RR_INTERVALS)
        out.append(_facts(
            t.artifacts, artifact_rows=one, interval_tables=_counter(kept), version=_counter(quality.bad_version()),
        ))
    if t.service_runs is not None:
        unended = (F.col("status") == K.FAILED) & F.col("ended_at").isNull()
        out.append(_facts(t.service_runs.drop("record_id"), unended=_counter(unended)))
    if t.runs is not None:
        wrong = ~valid_run_date(F.col("run_date").cast("string"))
        out.append(_facts(t.runs.drop("record_id"), bad_date=_counter(wrong)))
    return out


_COUNTERS = (
    "rr_rows", "timed", "source_n", "curated_rows", "window_n", "misaligned_window", "coverage", "ml_rows",
    "window_fraction", "window_derived", "record_rows", "record_n", "fraction", "derived", "distribution",
    "coverage_rollup", "listed", "artifact_rows", "interval_tables", "version", "unended", "bad_date",
)


def _summed(t: GateTables, width: float) -> DataFrame:
    """Sums per (run, record) and per run; `_level` is 0 and 1."""
    facts = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), _table_facts(t, width))
    for name in _COUNTERS:
        if name not in facts.columns:
            facts = facts.withColumn(name, F.lit(0).cast("long"))
    for name, kind in (("last", "double"), ("run_date", "string")):
        if name not in facts.columns:
            facts = facts.withColumn(name, F.lit(None).cast(kind))
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _COUNTERS]
    windows = facts.groupBy(*_KEYS).agg(
        *sums, F.max("last").alias("last"), F.min("run_date").alias("first_date"), F.max("run_date").alias("last_date")
    )
    # A key that repeats, or has rows but no start, is one violation; so is a key on one side only.
    repeated = (F.col("ml_rows") > 1) | (F.col("window").isNull() & (F.col("ml_rows") > 0))
    one_sided = (F.col("curated_rows") > 0) != (F.col("ml_rows") > 0)
    windows = windows.withColumns({"window_key": _counter(repeated), "window_parity": _counter(one_sided)})
    return (
        windows.groupingSets([_LEVELS, ["run_id"]], *_LEVELS)
        .agg(
            F.grouping("record_id").alias("_level"), *sums,
            F.sum("window_key").alias("window_key"), F.sum("window_parity").alias("window_parity"),
            F.max("last").alias("last"), F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"),
        )
    )


# --- checks ---------------------------------------------------------------------------------

Check = tuple[str, str, Callable[[], Column]]


def _record_checks(t: GateTables, width: float) -> list[Check]:
    def summed(name: str) -> Callable[[], Column]:
        return lambda: F.col(name)

    def wanted(rows: str) -> Column:
        return F.col("listed" if t.listed is not None else rows) > 0

    def window_count() -> Column:
        expected = F.floor(F.col("last") / F.lit(float(width))) + 1
        return _counter((F.col("rr_rows") > 0) & ~expected.eqNullSafe(F.col("curated_rows")))

    def interval_count() -> Column:
        there = F.col("rr_rows") + F.col("curated_rows") + F.col("record_rows") > 0
        agree = (F.col("window_n") == F.col("record_n")) & (F.col("source_n") == F.col("record_n"))
        return _counter(there & ~agree)

    out: list[Check] = []
    if t.artifacts is not None:
        out.append(("A", "artifact_version", summed("version")))
    if t.rr is not None:
        out.append(("B0", "no_beat_times", lambda: _counter(wanted("rr_rows") & (F.col("timed") == 0))))
    if t.curated is not None:
        out += [("B", c, summed(c)) for c in row_conditions(K.WINDOW_FEATURES)]
        if t.rr is not None:
            out.append(("B", "window_count", window_count))
    if t.window_ml is not None:
        out += [("C", c, summed(c)) for c in ("window_key", *row_conditions(K.WINDOW_FEATURES_ML))]
        if t.curated is not None:
            out.append(("C", "window_parity", summed("window_parity")))
    if t.records is not None:
        out += [("C", c, summed(c)) for c in row_conditions(K.RECORD_FEATURES)]
        out.append(("C", "not_one_row", lambda: _counter(wanted("record_rows") & (F.col("record_rows") != 1))))
        if t.curated is not None and t.rr is not None:
            out.append(("C", "interval_count", interval_count))
    return out


def _run_checks(t: GateTables) -> list[Check]:
    out: list[Check] = []
    if t.artifacts is not None:
        none = lambda: _counter((F.col("artifact_rows") > 0) & (F.col("interval_tables") == 0))
        out.append(("A", "no_interval_table", none))
    if t.service_runs is not None:
        out.append(("A", "failure_not_ended", lambda: F.col("unended")))
    if t.runs is not None:
        out.append(("A", "run_date", lambda: F.col("bad_date")))
    if any(x is not None for x in (t.rr, t.curated, t.records)):
        out.append(("A", "several_run_dates", lambda: _counter(F.col("first_date") != F.col("last_date"))))
    return out


def _missing(t: GateTables) -> list[tuple]:
    """Violations of the schemas alone, which no row has to be read for."""
    tables = (
        ("B0", "missing_column", K.RR_INTERVALS, t.rr), ("B", "missing_column", K.WINDOW_FEATURES, t.curated),
        ("C", "missing_window_column", K.WINDOW_FEATURES_ML, t.window_ml),
        ("C", "missing_record_column", K.RECORD_FEATURES, t.records),
    )
    out = []
    for gate, check, artifact, df in tables:
        absent = 0 if df is None else len(set(quality.REQUIRED_COLUMNS[artifact]) - set(df.columns))
        if absent:
            out.append((gate, check, None, None, absent))
    return out


def gate_metrics(
    tables: GateTables, gates: Sequence[str] = GATES, width_sec: float = K.WINDOW_SEC
) -> DataFrame:
    """(gate, check, run_id, record_id, violations) of every check with violations; no rows if all pass.

    The checks are those of `gate_report`, counted. Checks of whole runs have no record_id, those of schemas
    neither. Keys are compared as strings.
    """
    unknown = set(gates) - set(GATES)
    if unknown:
        raise ValueError(f"no such gate: {', '.join(sorted(unknown))}")
    by_level = [
        F.when(
            F.col("_level") == level,
            F.struct(F.lit(gate).alias("gate"), F.lit(check).alias("check"), count().alias("violations")),
        )
        for level, checks in enumerate((_record_checks(tables, width_sec), _run_checks(tables)))
        for gate, check, count in checks
        if gate in gates
    ]
    if not by_level:
        raise ValueError("none of the tables these gates look at is given")
    found = F.filter(F.array(*by_level), lambda c: c["violations"] > 0)
    rows = _summed(tables, width_sec).select("run_id", "record_id", F.inline(found)).select(
        "gate", "check", "run_id", "record_id", "violations"
    )
    absent = [m for m in _missing(tables) if m[0] in gates]
    if not absent:
        return rows
    return rows.unionByName(rows.sparkSession.createDataFrame(absent, METRICS))
