"""The feature plan: one shuffle of the beats feeds all three feature tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from beatloom import constants as K
from beatloom.functions.ordered import Split
from beatloom.operators import rollups, windows
from beatloom.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class FeatureParams:
    width_sec: float = K.WINDOW_SEC
    min_rr: int = K.MIN_RR_PER_WINDOW
    pnn50_ms: float = K.PNN50_MS
    pnn20_ms: float = K.PNN20_MS


@dataclass(frozen=True)
class FeatureTables:
    curated: DataFrame
    window_ml: DataFrame
    rollups: DataFrame
    record: DataFrame


def feature_tables(
    rr: DataFrame,
    records: DataFrame | None = None,
    params: FeatureParams = FeatureParams(),
    split: Split | None = None,
    checkpoint: bool = False,
) -> FeatureTables:
    """Curated windows, window modelling table and record features of an interval table.

    `checkpoint=True` stores the window summary (hundreds of times smaller than `rr`) before it is
    used by the three outputs; use it when more than one of them is written.
    """
    diffs = windows.successive_differences(rr, params.width_sec, split)
    summary = windows.window_summary(
        diffs, params.width_sec, params.min_rr, params.pnn50_ms, params.pnn20_ms
    )
    if checkpoint:
        ensure_checkpoint_dir(rr.sparkSession)
        summary = summary.checkpoint()
    curated = windows.curated_windows(summary)
    rolled = rollups.record_rollups(rr, summary, records)
    if checkpoint:
        rolled = rolled.checkpoint()
    return FeatureTables(
        curated, windows.window_features_ml(curated), rolled, rollups.record_features(rolled)
    )
