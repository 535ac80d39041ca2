"""The command line runs the stages and reports failure by its exit code."""

import pytest
from test_run import DAY, waveform

from beatloom import schemas
from beatloom.__main__ import main


def test_stages_and_preview(spark, tmp_path, capsys):
    waves, root = str(tmp_path / "waves"), str(tmp_path / "lake")
    spark.createDataFrame([waveform("7", 20, seed=9)], schemas.WAVEFORMS).write.parquet(waves)
    base = ["--root", root, "--run-id", "c", "--run-date", DAY]
    assert main(["aggregate", *base]) == 1
    assert main(["ingest", *base, "--waveforms", waves, "--ids", "7,8"]) == 1
    assert main(["process", *base]) == 0
    assert main(["aggregate", *base]) == 0
    assert main(["preview", *base, "--record-id", "7"]) == 0
    assert "heart_rate_bpm" in capsys.readouterr().out
    assert main(["preview", *base, "--record-id", "8"]) == 1
    assert main(["process", "--root", root, "--run-id", "c", "--run-date", "2024-13-01"]) == 1
    with pytest.raises(SystemExit):
        main(["run", *base])
