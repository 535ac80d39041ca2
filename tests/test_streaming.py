"""Records that arrive in several files end up as in one batch run."""

from pyspark.sql import functions as F
from test_run import DAY, waveform

from beatloom import schemas
from beatloom.operators import quality
from beatloom.plans.run import run_all
from beatloom.sources.layers import read_run
from beatloom.streaming.arrivals import process_arrivals, waveform_stream


def rounded(df):
    return df.select([F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def test_arrivals_equal_one_batch(spark, tmp_path):
    inbox, live, batch = (str(tmp_path / n) for n in ("inbox", "live", "batch"))
    rows = [waveform("a", 20, seed=4), waveform("b", 25, seed=5)]

    for row in rows:
        spark.createDataFrame([row], schemas.WAVEFORMS).coalesce(1).write.mode("append").parquet(inbox)
    stream = waveform_stream(spark, inbox, max_files=1)
    query = process_arrivals(stream, live, "r", DAY, str(tmp_path / "ck"))
    query.awaitTermination()
    assert query.exception() is None and len(query.recentProgress) >= 2
    run_all(spark, batch, "r", DAY, spark.createDataFrame(rows, schemas.WAVEFORMS))
    for layer, artifact in (
        ("processed", "rr_intervals_v1"), ("curated", "window_features_v1"),
        ("ml_ready", "window_features_ml_v1"), ("ml_ready", "record_features_v1"),
    ):
        streamed = read_run(spark, live, layer, artifact, "r", DAY)
        whole = read_run(spark, batch, layer, artifact, "r", DAY)
        assert whole.count() > 0
        assert quality.differing_rows(rounded(streamed), rounded(whole)).isEmpty()
