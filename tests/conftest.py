import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Many short plans: the quick compiler alone costs less than both.
        .config("spark.driver.extraJavaOptions", "-XX:TieredStopAtLevel=1")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getCheckpointDir() is None:
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return session


def beat_rows(spark, rows, run_id="r", run_date="2024-01-01"):
    """(record, beat, t, rr) tuples as an interval table."""
    return spark.createDataFrame(
        [(run_id, run_date, r, b, b, t, rr) for r, b, t, rr in rows],
        "run_id string, run_date string, record_id string, beat_index long, peak_index long,"
        " t_peak_sec double, rr_interval_sec double",
    )


@pytest.fixture(scope="session")
def worked_example(spark):
    """Two records whose features are worked out by hand."""
    return beat_rows(
        spark,
        [
            ("R", 0, 10.0, None), ("R", 1, 10.8, 0.80), ("R", 2, 11.7, 0.90), ("R", 3, 12.45, 0.75),
            ("R", 4, 300.0, 0.85), ("R", 5, 300.7, 0.70), ("R", 6, 599.9, 0.70),
            ("S", 0, 5.0, None), ("S", 1, 5.9, 0.9), ("S", 2, 310.0, 1.0), ("S", 3, 311.0, 1.0),
        ],
    )
