"""Segmented look-back, numbering and medians equal their plain definitions."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from beatloom.functions import ordered
from beatloom.functions.ordered import block_split, drop_segments, plan_split, time_split, with_previous
from beatloom.functions.quantiles import exact_median, value_counts


def as_set(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def plain(df, *order):
    w = Window.partitionBy("k").orderBy(*order)
    total = w.rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumns(
        {
            "before": F.lag("v").over(w),
            "position": (F.row_number().over(w) - 1).cast("long"),
            "upto": F.sum("i").over(total),
        }
    )


def skewed(spark, ties):
    rng = random.Random(3)
    rows = [("hot", i, rng.choice(ties), rng.random()) for i in range(1500)]
    rows += [("cold", i, float(i // 2), None if i % 3 else rng.random()) for i in range(40)]
    return spark.createDataFrame(rows, "k string, i long, t double, v double").repartition(5)


@pytest.mark.parametrize("rows_per_segment", [25, 200])
@pytest.mark.parametrize("ties", [[1.0], [1.0, 1.0, 1.0, 2.0, 5.5, 9.0], [x / 7 for x in range(900)]])
def test_cut_equals_plain(spark, ties, rows_per_segment):
    df = skewed(spark, ties)
    split = plan_split(df, ["k"], ["t", "i"], rows_per_segment)
    assert split.cut_any
    rows = split.assign(df).groupBy(*split.partition).count()
    # Quantile cuts are approximate only where values repeat below the tie threshold.
    assert rows.agg(F.max("count")).first()[0] <= 3 * rows_per_segment
    got = with_previous(df, split, {"before": "v"}, "position", {"upto": "i"})
    columns = ["k", "i", "before", "position", "upto"]
    assert as_set(got, *columns) == as_set(plain(df, "t", "i"), *columns)


@pytest.mark.parametrize("ties", [[1.0, 2.0], [x / 7 for x in range(900)]])
def test_levels_equal_plain(spark, monkeypatch, ties):
    monkeypatch.setattr(ordered, "MAX_CUTS_PER_KEY", 4)
    df = skewed(spark, ties)
    split = plan_split(df, ["k"], ["t", "i"], 40)
    assert split.finer is not None
    rows = split.assign(df).groupBy(*split.partition).count()
    assert rows.agg(F.max("count")).first()[0] <= 3 * 40
    got = with_previous(df, split, {"before": "v"}, "position", {"upto": "i"})
    again = with_previous(got, split, {"before2": "v"})
    columns = ["k", "i", "before", "position", "upto"]
    assert as_set(again, *columns) == as_set(plain(df, "t", "i"), *columns)
    assert as_set(again, "k", "i", "before2") == as_set(plain(df, "t", "i"), "k", "i", "before")
    assert not any(c.startswith("_") for c in drop_segments(again).columns)


def test_no_heavy_key_means_no_cut(spark):
    df = skewed(spark, [1.0, 2.0])
    split = plan_split(df, ["k"], ["t", "i"], 10_000)
    assert not split.cut_any and split.partition == ["k"]
    assert plan_split(df.limit(0), ["k"], ["t", "i"]).cut_any is False


def test_blocks_equal_plain(spark):
    df = skewed(spark, [1.0, 2.0])
    got = with_previous(df, block_split(["k"], "i", 97), {"before": "v"}, "position", {"upto": "i"})
    columns = ["k", "i", "before", "position", "upto"]
    assert as_set(got, *columns) == as_set(plain(df, "i"), *columns)
    assert set(drop_segments(got).columns) == {"k", "i", "t", "v", "before", "position", "upto"}


@pytest.mark.parametrize("seconds", [0.25, 3.0, 1e6])
def test_time_segments_equal_plain(spark, seconds):
    df = skewed(spark, [-7.0, 1.0, 1.0, 2.0, 5.5, 9.0])
    split = time_split(["k"], ["t", "i"], seconds)
    got = with_previous(df, split, {"before": "v"}, "position", {"upto": "i"})
    again = with_previous(got, split, {"before2": "v"})
    columns = ["k", "i", "before", "position", "upto"]
    assert as_set(again, *columns) == as_set(plain(df, "t", "i"), *columns)
    assert as_set(again, "k", "i", "before2") == as_set(plain(df, "t", "i"), "k", "i", "before")


def test_planning_stores_nothing_without_heavy_keys(spark, monkeypatch):
    def refuse(*_):
        raise AssertionError("a checkpoint")

    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.checkpoint", refuse)
    assert not plan_split(skewed(spark, [1.0]), ["k"], ["t", "i"]).cut_any


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(-3, 3)), min_size=1, max_size=60))
def test_median(spark, values):
    df = spark.createDataFrame([(k, float(v)) for k, v in values], "k string, v double")
    counts = value_counts(df, ["k"], "v")
    expected = sorted(map(tuple, df.groupBy("k").agg(F.median("v")).collect()))
    for rows_per_segment in (2, 1000):
        got = exact_median(counts, ["k"], "v", rows_per_segment=rows_per_segment)
        assert sorted(map(tuple, got.collect())) == expected
