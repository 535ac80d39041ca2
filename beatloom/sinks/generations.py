"""Tables of a run published together: batches of rows, and a manifest that says which of them count.

A publication appends one batch per table, and the ids of the records it replaces, next to what is
there; then one rename makes a manifest of the next generation visible. Readers take the newest
manifest, so they see all tables before a publication or all tables after it, also if it was cut off
between two tables. Rows of other records are not written again: of each record the newest batch that
replaced it counts. `compact` folds the batches into one; `remove_unreferenced` deletes what no kept
manifest names.

<root>/<layer>/_generations/run_date=/run_id=/manifest-<generation>.json
                                             /<artifact>/batch=<generation>-<unique>/part files
                                             /replaced/batch=<generation>-<unique>/part files

The rename is atomic on file systems that have one (HDFS and the like). Where a rename is a copy, the
manifest is still one small object that appears whole; two writers of one run at once are refused
there only if the second looks after the first is done.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beatloom import schemas
from beatloom.sources.layers import SCHEMAS, escaped, path_exists

REPLACED = "replaced"
COMPACT_ABOVE = 16  # batches a reader may have to look through
_REPLACED = T.StructType([T.StructField("record_id", T.StringType())])
_BATCH = T.StructField("batch", T.StringType())


class PublishConflictError(RuntimeError):
    """Another writer published the same generation first; publish again."""


@dataclass(frozen=True)
class Manifest:
    """What counts as published: `batches` in order of age, each with rows for every one of `artifacts`."""

    generation: int = 0
    artifacts: tuple[str, ...] = ()
    batches: tuple[str, ...] = ()


@dataclass(frozen=True)
class Publication:
    """The tables of one run in one layer that are published together."""

    spark: SparkSession
    root: str
    layer: str
    run_id: str
    run_date: str

    @property
    def base(self) -> str:
        run = f"run_date={escaped(self.spark, self.run_date)}/run_id={escaped(self.spark, self.run_id)}"
        return f"{self.root.rstrip('/')}/{self.layer}/_generations/{run}"

    def key(self, artifact: str) -> str:
        """Object key of a table's batches, without scheme or root."""
        return f"{self.layer}/_generations/run_date={self.run_date}/run_id={self.run_id}/{artifact}"

    # --- manifests ---

    def _path(self, text: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(text)

    def _fs(self):
        return self._path(self.base).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str, prefix: str) -> list[str]:
        if not path_exists(self.spark, folder):
            return []
        found = [s.getPath().getName() for s in self._fs().listStatus(self._path(folder))]
        return sorted(name for name in found if name.startswith(prefix))

    def _manifests(self) -> list[str]:
        return self._names(self.base, "manifest-")

    def _load(self, name: str) -> Manifest:
        stream = self._fs().open(self._path(f"{self.base}/{name}"))
        try:
            read = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Manifest(read["generation"], tuple(read["artifacts"]), tuple(read["batches"]))

    def newest(self) -> Manifest:
        """The manifest that counts; generation 0 without tables if nothing was published."""
        names = self._manifests()
        return self._load(names[-1]) if names else Manifest()

    def commit(self, new: Manifest) -> None:
        """Make `new` the newest manifest by one rename that fails if its generation exists."""
        jvm, name = self.spark._jvm, f"manifest-{new.generation:010d}.json"
        hidden, final = self._path(f"{self.base}/.{name}-{uuid.uuid4().hex}"), self._path(f"{self.base}/{name}")
        text = json.dumps({"generation": new.generation, "artifacts": new.artifacts, "batches": new.batches})
        stream = self._fs().create(hidden, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            final.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        plain = self.spark.sparkContext._gateway.new_array(rename, 1)
        plain[0] = rename.NONE
        try:
            files.rename(self._fs().makeQualified(hidden), self._fs().makeQualified(final), plain)
        except Py4JJavaError as error:
            self._fs().delete(hidden, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise PublishConflictError(f"generation {new.generation} exists") from error
            raise

    # --- writing ---

    def write_batch(self, generation: int, tables: Mapping[str, DataFrame], records: DataFrame) -> str:
        """Store rows of every table and the replaced records; nothing counts before `commit`."""
        batch = f"{generation:010d}-{uuid.uuid4().hex}"
        for artifact, rows in tables.items():
            stored = schemas.conform(rows, self._stored(artifact))
            stored.hint("rebalance").write.parquet(f"{self.base}/{artifact}/batch={batch}")
        replaced = records.select("record_id").distinct()
        replaced.write.parquet(f"{self.base}/{REPLACED}/batch={batch}")
        return batch

    def publish(self, tables: Mapping[str, DataFrame], records: DataFrame) -> Manifest:
        """Replace the listed records in all tables at once; one without rows is emptied.

        `tables` maps artifact names to rows, the same names every time. Rows of records that are not
        listed are an error of the caller: they would not be found again.
        """
        before = self.newest()
        if before.artifacts and set(before.artifacts) != set(tables):
            raise ValueError(f"the run's tables are {sorted(before.artifacts)}, not {sorted(tables)}")
        batch = self.write_batch(before.generation + 1, tables, records)
        after = Manifest(before.generation + 1, tuple(sorted(tables)), (*before.batches, batch))
        self.commit(after)
        return after

    def compact(self) -> Manifest:
        """Fold all batches into one. Readers of older generations still find theirs."""
        before = self.newest()
        if len(before.batches) < 2:
            return before
        tables = {a: self.read(a, before) for a in before.artifacts}
        batch = self.write_batch(before.generation + 1, tables, self._replaced(before))
        after = Manifest(before.generation + 1, before.artifacts, (batch,))
        self.commit(after)
        return after

    def remove_unreferenced(self, keep: int = 1) -> int:
        """Delete manifests but the newest `keep` and batches that none of those names.

        Not beside a running publication: its batch is not named yet. Returns how many batches went.
        """
        if keep < 1:
            raise ValueError("at least one manifest stays")
        names = self._manifests()
        for name in names[:-keep]:
            self._fs().delete(self._path(f"{self.base}/{name}"), False)
        kept = {f"batch={b}" for name in names[-keep:] for b in self._load(name).batches}
        gone = set()
        for status in self._fs().listStatus(self._path(self.base)) if path_exists(self.spark, self.base) else ():
            if status.isDirectory():
                folder = f"{self.base}/{status.getPath().getName()}"
                for name in set(self._names(folder, "batch=")) - kept:
                    self._fs().delete(self._path(f"{folder}/{name}"), True)
                    gone.add(name)
        return len(gone)

    # --- reading ---

    def _stored(self, artifact: str) -> T.StructType:
        """The table's columns without the run's, which stand in the path."""
        return T.StructType([f for f in SCHEMAS[artifact] if f.name not in ("run_id", "run_date")])

    def _batches(self, folder: str, schema: T.StructType, batches: tuple[str, ...]) -> DataFrame:
        base = f"{self.base}/{folder}"
        reader = self.spark.read.schema(T.StructType([*schema, _BATCH])).option("basePath", base)
        return reader.parquet(*[f"{base}/batch={b}" for b in batches])

    def _replaced(self, manifest: Manifest) -> DataFrame:
        """The newest batch of every record. Batch names begin with their generation, so they sort by age."""
        rows = self._batches(REPLACED, _REPLACED, manifest.batches)
        return rows.groupBy("record_id").agg(F.max("batch").alias("batch"))

    def read(self, artifact: str, manifest: Manifest | None = None) -> DataFrame:
        """The published rows with the declared schema, as of `manifest` (by default the newest).

        Nothing published reads as empty. One batch is read as it is; of several, each record's newest
        rows are found by a join with the narrow table of replaced records.
        """
        schema, manifest = SCHEMAS[artifact], manifest or self.newest()
        if artifact not in manifest.artifacts:
            return self.spark.createDataFrame([], schema)
        rows = self._batches(artifact, self._stored(artifact), manifest.batches)
        if len(manifest.batches) > 1:
            rows = rows.join(self._replaced(manifest), ["record_id", "batch"], "left_semi")
        run = {"run_id": F.lit(self.run_id), "run_date": F.lit(self.run_date)}
        return rows.withColumns(run).select(*schema.fieldNames())
