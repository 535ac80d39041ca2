"""Windows of a beat stream equal those of the batch plan, in any order of arrival."""

import random

import pytest
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.functions.ordered import time_split
from beatloom.operators import windows
from beatloom.plans.features import FeatureParams
from beatloom.streaming.live_windows import end_of_stream, late_beats, live_windows, publish_windows

SCHEMA = "run_id string, run_date string, record_id string, t_peak_sec double, peak_index long"
PARAMS = FeatureParams(min_rr=3)
DELAY = 400  # seconds


def series(record, seconds, seed):
    chance, t, out = random.Random(seed), 0.0, []
    while (t := t + chance.choice([0.6, 0.8, 0.81, 1.3, 40.0])) < seconds:
        out.append(("r", "2024-01-01", record, t, len(out)))
    return out


def batch_windows(spark, beats):
    df = spark.createDataFrame(beats, SCHEMA)
    by = "PARTITION BY record_id ORDER BY t_peak_sec, peak_index"
    rr = df.withColumns({
        "rr_interval_sec": F.expr(f"t_peak_sec - lag(t_peak_sec) OVER ({by})"),
        "beat_index": F.expr(f"row_number() OVER ({by})"),
    })
    split = time_split(K.RECORD_KEY, ["t_peak_sec", "beat_index"], 1e9)
    return windows.window_summary(windows.successive_differences(rr, split=split), min_rr=PARAMS.min_rr)


def arrive(spark, tmp_path, deliveries, end=True, max_files=1):
    """Deliver files one after the other, run to the end, return (windows, late beats)."""
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "out", "checkpoint"))
    for rows in deliveries:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
    if end:
        end_of_stream(spark.read.parquet(inbox), 1e7).write.mode("append").parquet(inbox)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", max_files).parquet(inbox)
    summary = live_windows(stream, f"{DELAY} seconds", PARAMS)
    query = publish_windows(summary, out, checkpoint)
    query.awaitTermination()
    assert query.exception() is None
    return spark.read.schema(summary.schema).parquet(out), late_beats(query)


def rows_of(df):
    cells = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in sorted(df.dtypes)]
    return sorted((tuple(r) for r in df.select(cells).collect()), key=repr)


def test_shuffled_arrivals_equal_the_batch(spark, tmp_path):
    beats = series("a", 3000, 1) + series("b", 2000, 2) + [("r", "2024-01-01", "lone", 700.0, 0)]
    beats += [("r", "2024-01-01", "a", beats[5][3], 10_000)]  # a tie
    chance = random.Random(3)
    due = {b: b[3] + chance.uniform(0, DELAY - 10) for b in beats}
    inbox = sorted(beats, key=due.get)
    cut = [inbox[i : i + 30] for i in range(0, len(inbox), 30)][:12]
    cut[-1] += inbox[12 * 30 :]
    got, late = arrive(spark, tmp_path, cut)
    want = batch_windows(spark, beats)
    assert late == 0 and want.count() > 10
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_late_beats_are_counted_and_change_nothing(spark, tmp_path):
    beats = series("a", 1500, 4)
    early = [b for b in beats if b[3] < 1200]
    rest = [b for b in beats if b[3] >= 1200]
    straggler = ("r", "2024-01-01", "a", 33.25, 9_999)
    untimed = ("r", "2024-01-01", "a", None, 9_998)
    # The watermark that drops rows is the one with which the micro-batch before closed windows.
    got, late = arrive(spark, tmp_path, [early, rest, [straggler, untimed]])
    assert late == 1
    assert rows_of(got) == rows_of(batch_windows(spark, beats))


def test_windows_stay_open_until_the_delay_is_over(spark, tmp_path):
    beats = [("r", "2024-01-01", "a", float(t), t) for t in range(1000)]
    got, late = arrive(spark, tmp_path, [beats], end=False)
    # The watermark stands at 599 seconds.
    assert late == 0 and [r.window_start_sec for r in got.collect()] == [0.0]


@pytest.mark.parametrize("seed", [7])
def test_a_restart_continues(spark, tmp_path, seed):
    beats = series("a", 2400, seed)
    first, second = [b for b in beats if b[3] < 1100], [b for b in beats if b[3] >= 1100]
    got, _ = arrive(spark, tmp_path, [first], end=False)
    assert 0 < got.count() < batch_windows(spark, beats).count()
    got, late = arrive(spark, tmp_path, [second])
    assert late == 0 and rows_of(got) == rows_of(batch_windows(spark, beats))
