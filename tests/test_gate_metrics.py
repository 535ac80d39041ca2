"""Gates in one pass: same findings as the reports, one scan per table, counts while writing."""

from pyspark.sql import functions as F

import pytest

from beatloom import constants as K
from beatloom.plans import gate_metrics as gm
from beatloom.plans import queries
from beatloom.plans.features import feature_tables
from beatloom.plans.gates import GateTables, gate_report

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def faulty(spark):
    t = queries._faulty_run(spark, SF)
    kept = {n: getattr(t, n) for n in t.__dataclass_fields__}
    return GateTables(**{n: df if df is None else df.checkpoint() for n, df in kept.items()})


def test_every_check_of_every_gate_is_planted(spark, faulty):
    found = {(r.gate, r["check"]) for r in gm.gate_metrics(faulty, width_sec=queries.BY_USER.width_sec).collect()}
    checks = {(g, c) for g, c, _ in [*gm._record_checks(faulty, 1.0), *gm._run_checks(faulty)]}
    columns = {("B", "missing_column"), ("C", "missing_window_column"), ("C", "missing_record_column")}
    assert found == checks | columns


def test_same_findings_as_the_report(spark, faulty):
    # The report needs the columns that are missing here.
    whole = GateTables(
        **{
            **{n: getattr(faulty, n) for n in faulty.__dataclass_fields__},
            "window_ml": faulty.window_ml.withColumn("rr_cv", F.lit(None).cast("double")),
        }
    )
    width = queries.BY_USER.width_sec
    report = gate_report(whole, width_sec=width).groupBy("gate", "check", "record_id").agg(
        F.count(F.lit(1)).alias("n")
    )
    want = {(r.gate, r["check"], r.record_id): r.n for r in report.collect() if "missing" not in r["check"]}
    got = {}
    for r in gm.gate_metrics(whole, width_sec=width).collect():
        if "missing" not in r["check"]:
            key = (r.gate, r["check"], r.record_id)
            got[key] = got.get(key, 0) + r.violations
    assert got == want


def test_one_scan_per_table_and_two_shuffles(spark, faulty):
    plan = gm.gate_metrics(faulty)._jdf.queryExecution().executedPlan().toString()
    tables = sum(getattr(faulty, n) is not None for n in faulty.__dataclass_fields__)
    assert plan.count("Scan ExistingRDD") == tables + 1  # the rows about columns are given, not read
    assert plan.count("Exchange hashpartitioning") == 2


def test_good_tables_have_no_rows(spark, worked_example):
    made = feature_tables(worked_example)
    good = GateTables(rr=worked_example, curated=made.curated, window_ml=made.window_ml, records=made.record)
    found = gm.gate_metrics(good).collect()
    # S has no beats between its windows at 0 and 300, so its number of windows is right as well.
    assert found == []


def test_empty_tables_and_chosen_gates(spark, worked_example):
    made = feature_tables(worked_example)
    none = GateTables(rr=worked_example, curated=made.curated.limit(0))
    rows = gm.gate_metrics(none, ["B"]).collect()
    assert [(r["check"], r.record_id, r.violations) for r in sorted(rows, key=lambda r: r.record_id)] == [
        ("window_count", "R", 1), ("window_count", "S", 1)
    ]
    with pytest.raises(ValueError):
        gm.gate_metrics(none, ["D"])
    with pytest.raises(ValueError):
        gm.gate_metrics(GateTables(listed=worked_example), ["C"])


def test_observed_while_writing(spark, worked_example, tmp_path):
    curated = feature_tables(worked_example).curated.withColumn(
        "window_coverage_sec", F.when(F.col("record_id") == "S", -1.0).otherwise(F.col("window_coverage_sec"))
    )
    rows, seen = gm.observed(curated, K.WINDOW_FEATURES)
    rows.write.parquet(str(tmp_path / "windows"))
    assert seen.get == {"rows": 4, "misaligned_window": 0, "coverage": 2}
