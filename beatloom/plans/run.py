"""A run from waveforms to feature tables, in three stages over the layer tables.

Each stage reads its inputs from the catalog, works on all pending records in common Spark jobs,
publishes data before it publishes metadata, and records its state. A rerun picks up what is
missing; with `overwrite` it replaces the selected records.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beatloom import constants as K
from beatloom.operators import catalog, quality, signal
from beatloom.plans.features import FeatureParams, feature_tables
from beatloom.plans.gates import GATES, GateTables, gate_report
from beatloom.session import ensure_checkpoint_dir
from beatloom.sinks import tables
from beatloom.sinks.generations import COMPACT_ABOVE, Publication
from beatloom.sinks.metadata import Metadata
from beatloom.sources import waveforms as wf
from beatloom.sources.layers import artifact_key, read_rr, read_run
from beatloom.sources.records import RecordFilter, RecordFilterError, parse_record_filter


class NoInputError(LookupError):
    """The stage before has left nothing to work on."""


class CountInvariantError(RuntimeError):
    """Window and record interval counts disagree; `offenders` has the records."""

    def __init__(self, message: str, offenders: DataFrame):
        super().__init__(message)
        self.offenders = offenders


class RunDateError(ValueError):
    """The run date is not a real yyyy-MM-dd date."""


@dataclass(frozen=True)
class StageResult:
    service: str
    status: str
    records_total: int = 0
    records_ok: int = 0
    records_skipped: int = 0
    records_failed: int = 0
    windows_total: int = 0
    window_rows: int = 0
    record_rows: int = 0
    notes: str = ""


def valid_run_date(text: str | None) -> bool:
    """A real calendar date, spelled the one way ISO 8601 extends it."""
    try:
        return date.fromisoformat(text or "").isoformat() == text
    except ValueError:
        return False


def _listed(counts: dict[str, int]) -> str:
    return ", ".join(f"{name} {count}" for name, count in counts.items())


class Run:
    """One (run id, run date) under a root path of any Hadoop file system."""

    def __init__(
        self, spark: SparkSession, root: str, run_id: str, run_date: str, overwrite: bool = False,
        ids: str | None = None, range: str | None = None, limit: str | int | None = None,
        records: RecordFilter | None = None, generations: bool = False,
    ):
        """`records` is a selection made elsewhere, in place of the three texts. With `generations` the
        two modelling tables are published together, instead of one partition after the other."""
        if not run_id or not run_id.strip():
            raise ValueError("run_id is empty")
        if not valid_run_date(run_date):
            raise RunDateError(f"not a yyyy-MM-dd date: {run_date!r}")
        ensure_checkpoint_dir(spark)
        self.spark, self.root = spark, root
        self.run_id, self.run_date, self.overwrite = run_id.strip(), run_date, overwrite
        self.metadata = Metadata(spark, root)
        self.published = (
            Publication(spark, root, K.ML_READY, self.run_id, run_date) if generations else None
        )
        self._selection, self._records = (ids, range, limit), records

    # --- small helpers ---

    def _selected(self) -> RecordFilter | None:
        return self._records or parse_record_filter(*self._selection)

    def _check_date(self) -> None:
        """A run has one date; under another its tables would be looked for in the wrong place."""
        known = self.metadata.current("runs").filter(F.col("run_id") == self.run_id).first()
        if known is not None and known.run_date.isoformat() != self.run_date:
            raise RunDateError(f"run {self.run_id!r} has the date {known.run_date}, not {self.run_date}")

    def _service(self, service: str, status: str, notes: str, started=False, ended=False) -> None:
        now = datetime.now(UTC)
        self.metadata.append_row(
            "service_runs", run_id=self.run_id, service=service, status=status, notes=notes,
            started_at=now if started else None, ended_at=now if ended else None,
        )

    def _run_state(self, status: str, notes: str) -> None:
        self.metadata.append_row(
            "runs", run_id=self.run_id, run_date=date.fromisoformat(self.run_date),
            status=status, notes=notes,
        )

    def _stamp(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"run_id": F.lit(self.run_id), "run_date": F.lit(self.run_date)})

    def _written(self, layer: str, artifact: str) -> DataFrame:
        return tables.written_records(
            self.spark, self.root, layer, artifact, self.run_id, self.run_date
        )

    def _register(self, records: DataFrame, layer: str, kind: str, uri, version=None) -> None:
        rows = catalog.artifact_rows(self._stamp(records), layer, kind, uri, version)
        self.metadata.append("artifacts", rows)

    def _record_uri(self, layer: str, artifact: str):
        key = artifact_key(layer, artifact, self.run_date, self.run_id)
        return F.concat(F.lit(f"{key}/record_id="), "record_id")

    def _outcomes(self, service: str, **parts: DataFrame) -> StageResult:
        """Counts and state of the stage, from the records in each outcome."""
        rows = None
        for outcome, records in parts.items():
            part = records.select("record_id", F.lit(outcome).alias("outcome"))
            rows = part if rows is None else rows.unionByName(part)
        keyed = rows.withColumns({"run_id": F.lit(self.run_id), "service": F.lit(service)})
        row = catalog.run_status(keyed).first()
        if row is None:
            return StageResult(service, K.SUCCEEDED)
        return StageResult(
            service, row.status, row.records_total, row.records_ok, row.records_skipped,
            row.records_failed,
        )

    @staticmethod
    def _notes(result: StageResult) -> str:
        names = ("records_total", "records_ok", "records_skipped", "records_failed")
        return _listed({name: getattr(result, name) for name in names})

    def _discover(self, layer: str, kind: str, version: str | None = None) -> DataFrame:
        return catalog.discover_artifacts(
            self.metadata.current("artifacts"), self.run_id, layer, kind, version
        ).select("record_id")

    # --- stages ---

    def ingest(self, waveforms: DataFrame, slice_seconds=None) -> StageResult:
        """Waveforms (record_id, fs, signal, has_annotation), whole or in chunks (with first_sample),
        to the raw sample table."""
        self._check_date()
        self._run_state(K.RUNNING, "ingesting waveforms")
        try:
            chosen = self._selected()
            wanted = (
                chosen.frame(self.spark) if chosen else waveforms.select("record_id").distinct()
            )
            skipped, pending = tables.split_pending(
                wanted, self._written(K.RAW, K.ECG), self.overwrite
            )
            # Settled before writing: afterwards the written table would answer differently.
            skipped, pending = skipped.checkpoint(), pending.checkpoint()
            # One look at the signals' sizes, one pass to write them.
            measured = wf.waveform_quality(
                waveforms.join(pending, "record_id", "left_semi"), self.run_id, slice_seconds
            ).checkpoint()
            good = wf.readable(measured)
            readable = good.select("record_id")
            broken = pending.join(readable, "record_id", "left_anti")
            todo = waveforms.join(readable, "record_id", "left_semi")
            samples = wf.ingest_waveforms(todo, self.run_id, self.run_date, slice_seconds)
            tables.write_layer(samples, self.root, K.RAW, K.ECG, rebalance=False)
            uri = self._record_uri(K.RAW, K.ECG)
            self._register(readable, K.RAW, K.ECG, uri, K.RAW_SCHEMA_VER)
            self.metadata.append("quality_metrics", good)
            result = self._outcomes(K.INGESTION, ok=readable, skipped=skipped, failed=broken)
        except Exception as error:
            self._run_state(K.FAILED, str(error))
            raise
        self._run_state(result.status, "ingesting waveforms")
        return result

    def process(self, widths: signal.DetectorWidths = signal.DetectorWidths()) -> StageResult:
        """Raw samples to the beat interval table."""
        self._check_date()
        self._service(K.PROCESSING, K.RUNNING, "detecting beats", started=True)
        try:
            result = self._process(widths)
        except Exception as error:
            self._service(K.PROCESSING, K.FAILED, str(error), ended=True)
            raise
        self._service(K.PROCESSING, result.status, result.notes or self._notes(result), ended=True)
        return result

    def _process(self, widths: signal.DetectorWidths) -> StageResult:
        available, chosen = self._discover(K.RAW, K.ECG), self._selected()
        wanted = available.filter(chosen.condition()) if chosen else available
        if wanted.isEmpty():
            if chosen:
                raise RecordFilterError("the record filter matches no raw record")
            return StageResult(K.PROCESSING, K.SUCCEEDED, notes="no raw records")

        # A record without a single beat has no rows, yet it is done.
        beatless = self.metadata.current("processing_metrics").filter(
            (F.col("run_id") == self.run_id) & (F.col("n_beats") == 0)
        )
        written = self._written(K.PROCESSED, K.RR_INTERVALS).unionByName(
            beatless.select("record_id")
        )
        skipped, pending = tables.split_pending(wanted, written, self.overwrite)
        skipped, pending = skipped.checkpoint(), pending.checkpoint()

        raw = read_run(
            self.spark, self.root, K.RAW, K.ECG, self.run_id, self.run_date, pending
        )
        keys = ["record_id"]  # one run at a time: the run's ids need not travel with the samples
        rr, errors = signal.beats_from_samples(raw, keys, widths=widths)
        rr = self._stamp(rr)
        present = raw.select("record_id").distinct()
        done = (
            pending.join(present, "record_id", "left_semi")
            .join(errors.select("record_id"), "record_id", "left_anti")
            .checkpoint()
        )
        broken = pending.join(done, "record_id", "left_anti")
        tables.write_records(
            rr.select("run_id", "run_date", "record_id", "beat_index", "peak_index", "t_peak_sec",
                      "rr_interval_sec"),
            done, self.root, K.PROCESSED, K.RR_INTERVALS, self.run_id, self.run_date,
        )
        saved = read_rr(self.spark, self.root, self.run_id, self.run_date, done)
        self.metadata.append(
            "processing_metrics", signal.processing_metrics(saved, self._stamp(done))
        )
        uri = self._record_uri(K.PROCESSED, K.RR_INTERVALS)
        self._register(done, K.PROCESSED, K.RR_INTERVALS, uri)
        return self._outcomes(K.PROCESSING, ok=done, skipped=skipped, failed=broken)

    def aggregate(self, params: FeatureParams = FeatureParams()) -> StageResult:
        """Beat intervals to curated windows and the two modelling tables."""
        self._check_date()
        self._service(K.AGGREGATION, K.RUNNING, "building features", started=True)
        try:
            result = self._aggregate(params)
        except Exception as error:
            self._service(K.AGGREGATION, K.FAILED, str(error), ended=True)
            raise
        self._service(K.AGGREGATION, result.status, result.notes, ended=True)
        return result

    def modelling(self, artifact: str) -> DataFrame:
        """One of the run's two modelling tables, from where this run keeps them."""
        if self.published:
            return self.published.read(artifact)
        return read_run(self.spark, self.root, K.ML_READY, artifact, self.run_id, self.run_date)

    def _complete(self, artifact: str) -> bool:
        if self.published:
            return artifact in self.published.newest().artifacts
        return tables.is_complete(
            self.spark, self.root, K.ML_READY, artifact, self.run_id, self.run_date
        )

    def _aggregate(self, params: FeatureParams) -> StageResult:
        state = tables.output_state(
            self._complete(K.RECORD_FEATURES), self._complete(K.WINDOW_FEATURES_ML), self.overwrite
        )
        if state is tables.OutputState.SKIP:
            return StageResult(
                K.AGGREGATION, K.SUCCEEDED, notes="skipped; both outputs already exist"
            )
        available = self._discover(K.PROCESSED, K.RR_INTERVALS, K.RR_INTERVALS)
        if available.isEmpty():
            raise NoInputError("no interval tables are registered for the run")
        chosen = self._selected()
        records = (available.filter(chosen.condition()) if chosen else available).checkpoint()
        if records.isEmpty():
            raise RecordFilterError("the record filter matches no processed record")

        skipped, pending = tables.split_pending(
            records, self._written(K.CURATED, K.WINDOW_FEATURES), self.overwrite
        )
        skipped, pending = skipped.checkpoint(), pending.checkpoint()
        rr = read_rr(self.spark, self.root, self.run_id, self.run_date, records)
        made = feature_tables(rr, self._stamp(records), params, checkpoint=True)
        self._check_counts(made.rollups)

        self._publish(made, records, pending)
        uri = self._record_uri(K.CURATED, K.WINDOW_FEATURES)
        with_windows = made.curated.select("record_id").distinct()
        self._register(
            pending.join(with_windows, "record_id", "left_semi"), K.CURATED, K.WINDOW_FEATURES, uri
        )
        for artifact in (K.WINDOW_FEATURES_ML, K.RECORD_FEATURES):
            key = (
                self.published.key(artifact) if self.published
                else artifact_key(K.ML_READY, artifact, self.run_date, self.run_id)
            )
            self._register(records, K.ML_READY, artifact, key)

        counts = {
            "records_total": records.count(),
            "records_skipped": skipped.count(),
            "records_with_windows": with_windows.count(),
            "windows_total": made.curated.count(),
        }
        total, windows = counts["records_total"], counts["windows_total"]
        return StageResult(
            K.AGGREGATION, K.SUCCEEDED, total, total, counts["records_skipped"],
            windows_total=windows, window_rows=windows, record_rows=total, notes=_listed(counts),
        )

    def check(self, gates=GATES, params: FeatureParams = FeatureParams()) -> DataFrame:
        """Every violation of the contract in this run's tables (see `gates.gate_report`)."""
        def of(layer: str, artifact: str) -> DataFrame:
            return read_run(self.spark, self.root, layer, artifact, self.run_id, self.run_date)

        def logged(table: str) -> DataFrame:
            return self.metadata.current(table).filter(F.col("run_id") == self.run_id)

        registered = self._discover(K.ML_READY, K.RECORD_FEATURES)
        tables_ = GateTables(
            of(K.PROCESSED, K.RR_INTERVALS), of(K.CURATED, K.WINDOW_FEATURES),
            self.modelling(K.WINDOW_FEATURES_ML), self.modelling(K.RECORD_FEATURES),
            self._stamp(registered), logged("artifacts"), logged("service_runs"), logged("runs"),
        )
        return gate_report(tables_, gates, params.width_sec)

    def _check_counts(self, rolled: DataFrame) -> None:
        wrong = quality.rollup_count_mismatches(rolled).checkpoint()
        number = wrong.count()
        if number:
            raise CountInvariantError(f"{number} records count other intervals than their windows", wrong)

    def _publish(self, made, records: DataFrame, pending: DataFrame) -> None:
        where = {"root": self.root, "run_id": self.run_id, "run_date": self.run_date}
        tables.write_records(
            made.curated.join(pending, "record_id", "left_semi").select(*made.curated.columns),
            pending, layer=K.CURATED, artifact=K.WINDOW_FEATURES, **where,
        )
        if self.published:
            both = {K.WINDOW_FEATURES_ML: made.window_ml, K.RECORD_FEATURES: made.record}
            if len(self.published.publish(both, records).batches) > COMPACT_ABOVE:
                self.published.compact()
            return
        # Neither table counts as complete until both are written.
        for artifact in (K.WINDOW_FEATURES_ML, K.RECORD_FEATURES):
            tables.mark_incomplete(self.spark, layer=K.ML_READY, artifact=artifact, **where)
        for artifact, table in (
            (K.WINDOW_FEATURES_ML, made.window_ml), (K.RECORD_FEATURES, made.record)
        ):
            tables.write_run_level(table, records, layer=K.ML_READY, artifact=artifact, **where)


def run_all(
    spark: SparkSession, root: str, run_id: str, run_date: str, waveforms: DataFrame,
    ids: str | None = None, range: str | None = None, limit: str | int | None = None,
    overwrite: bool = False, slice_seconds=None, params: FeatureParams = FeatureParams(),
    widths: signal.DetectorWidths = signal.DetectorWidths(), generations: bool = False,
) -> list[StageResult]:
    """All three stages with one record selection; stops after a stage with failed records."""
    run = Run(spark, root, run_id, run_date, overwrite, ids, range, limit, generations=generations)
    results = [run.ingest(waveforms, slice_seconds)]
    if results[-1].records_failed == 0:
        results.append(run.process(widths))
    if results[-1].records_failed == 0 and results[-1].service == K.PROCESSING:
        results.append(run.aggregate(params))
    return results
