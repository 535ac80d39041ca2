"""Tables published together: whole generations, whatever is cut off on the way."""

import pytest
from pyspark.sql import functions as F
from test_run import waveform

from beatloom import constants as K
from beatloom import schemas
from beatloom.plans.run import Run, run_all
from beatloom.sinks.generations import Manifest, Publication, PublishConflictError

ML, REC = K.WINDOW_FEATURES_ML, K.RECORD_FEATURES


def rows(spark, schema, *pairs):
    """(record, n_rr) rows of a table, NULL elsewhere."""
    df = spark.createDataFrame(list(pairs), "record_id string, n_rr long")
    missing = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return schemas.conform(df.withColumns(missing), schema)


def both(spark, windows, records):
    return {ML: rows(spark, schemas.WINDOW_FEATURES_ML, *windows), REC: rows(spark, schemas.RECORD_FEATURES, *records)}


def ids(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "record_id string")


def seen(run, manifest=None):
    return {
        a: sorted((r.record_id, r.n_rr) for r in run.read(a, manifest).collect()) for a in (ML, REC)
    }


@pytest.fixture
def run(spark, tmp_path):
    return Publication(spark, str(tmp_path), K.ML_READY, "run 1/a", "2024-01-01")


def test_generations_replace_listed_records(spark, run):
    assert seen(run) == {ML: [], REC: []} and run.newest() == Manifest()
    first = run.publish(both(spark, [("a", 1), ("a", 2), ("b", 3), ("c", 4)], [("a", 2), ("b", 1), ("c", 1)]), ids(spark, "a", "b", "c"))
    # b gets new rows, c is emptied, d is new, a stays where it is.
    second = run.publish(both(spark, [("b", 30), ("d", 5)], [("b", 9), ("d", 1)]), ids(spark, "b", "c", "d", "d"))
    want = {ML: [("a", 1), ("a", 2), ("b", 30), ("d", 5)], REC: [("a", 2), ("b", 9), ("d", 1)]}
    assert seen(run) == want and second.generation == 2
    # A reader of the older generation is not disturbed.
    assert seen(run, first)[ML] == [("a", 1), ("a", 2), ("b", 3), ("c", 4)]
    stored = spark.read.parquet(f"{run.base}/{ML}/batch={second.batches[1]}")
    assert sorted(r.record_id for r in stored.collect()) == ["b", "d"]  # others are not written again
    back = run.read(ML)
    assert back.schema.names == schemas.WINDOW_FEATURES_ML.names
    assert back.select("run_id", "run_date").distinct().collect() == [("run 1/a", "2024-01-01")]


def test_publication_cut_off_between_tables(spark, run):
    run.publish(both(spark, [("a", 1)], [("a", 1)]), ids(spark, "a"))
    broken = both(spark, [("a", 2)], [("a", 2)])
    broken[REC] = broken[REC].withColumn("n_rr", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        run.publish(broken, ids(spark, "a"))
    assert seen(run) == {ML: [("a", 1)], REC: [("a", 1)]}
    after = run.publish(both(spark, [("a", 3)], [("a", 3)]), ids(spark, "a"))
    assert after.generation == 2 and seen(run) == {ML: [("a", 3)], REC: [("a", 3)]}


def test_two_writers_of_one_generation(spark, run):
    run.publish(both(spark, [("a", 1)], [("a", 1)]), ids(spark, "a"))
    with pytest.raises(PublishConflictError):
        run.commit(Manifest(1, (ML, REC), ("other",)))
    assert seen(run)[ML] == [("a", 1)]
    with pytest.raises(ValueError):
        run.publish({ML: run.read(ML)}, ids(spark, "a"))


def test_compaction_and_removal(spark, run):
    assert run.compact() == Manifest() and run.remove_unreferenced() == 0
    for i in range(3):
        run.publish(both(spark, [("a", i), (f"r{i}", i)], [("a", i)]), ids(spark, "a", f"r{i}"))
    run.write_batch(4, both(spark, [("a", 99)], [("a", 99)]), ids(spark, "a"))  # never committed
    want = {ML: [("a", 2), ("r0", 0), ("r1", 1), ("r2", 2)], REC: [("a", 2)]}
    before = run.newest()
    after = run.compact()
    assert len(after.batches) == 1 and seen(run) == want == seen(run, before)
    assert run.remove_unreferenced(keep=2) == 1 and seen(run, before) == want
    assert run.remove_unreferenced() == 3 and seen(run) == want
    # An emptied record stays empty after compaction and comes back by a later publication.
    run.publish(both(spark, [], []), ids(spark, "a"))
    run.compact()
    assert seen(run) == {ML: [("r0", 0), ("r1", 1), ("r2", 2)], REC: []}
    run.publish(both(spark, [("a", 7)], [("a", 7)]), ids(spark, "a"))
    assert seen(run)[REC] == [("a", 7)]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    """A run up to its intervals."""
    root = str(tmp_path_factory.mktemp("published"))
    waves = spark.createDataFrame([waveform("100", seed=1), waveform("101", seed=2)], schemas.WAVEFORMS)
    results = run_all(spark, root, "r1", "2024-01-01", waves, generations=True)
    assert [r.status for r in results] == [K.SUCCEEDED] * 3
    return root


def test_run_publishes_both_tables(spark, staged):
    run = Run(spark, staged, "r1", "2024-01-01", generations=True)
    assert run.check().isEmpty()
    assert run.published.newest().generation == 1
    assert run.aggregate().notes.startswith("skipped")
    before = {r.record_id: r.created_at for r in run.modelling(REC).collect()}
    assert set(before) == {"100", "101"} and run.modelling(ML).count() == 2
    keys = {r.uri for r in run.metadata.current("artifacts").filter("layer = 'ml_ready'").collect()}
    assert keys == {run.published.key(a) for a in (ML, REC)}
    again = Run(spark, staged, "r1", "2024-01-01", overwrite=True, ids="101", generations=True)
    assert again.aggregate().record_rows == 1
    after = {r.record_id: r.created_at for r in run.modelling(REC).collect()}
    assert after["100"] == before["100"] and after["101"] > before["101"]
    assert run.published.newest().generation == 2 and run.check().isEmpty()


def test_failed_publication_of_a_run(spark, staged, monkeypatch):
    run = Run(spark, staged, "r1", "2024-01-01", overwrite=True, generations=True)
    before = run.published.newest()

    def lost(self, new):
        raise RuntimeError("store gone")

    monkeypatch.setattr(Publication, "commit", lost)
    with pytest.raises(RuntimeError, match="store gone"):
        run.aggregate()
    assert run.published.newest() == before and run.modelling(ML).count() == 2
