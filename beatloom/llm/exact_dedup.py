"""Exact dedup by progressive refinement: length, then prefix hash, then the full hash.

Each level looks only at rows that share the level before with another row. Lengths and prefixes
are counted with map-side combining, so a group holding a third of all rows costs a few partial
counts. A filter of the surviving (length, prefix) pairs, of bounded size however many there are,
marks which rows get a full SHA-256 while they are read; texts are not shuffled for it. A row marked
by chance is hashed and turns out to be alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.kept import keep_chosen
from beatloom.llm.shared import text_or_empty, written
from beatloom.llm.sieve import marked, sieve

PREFIX = 256


def _keyed(docs: DataFrame) -> DataFrame:
    t = text_or_empty()
    return docs.select(
        F.col("doc_id"),
        t.alias("_t"),
        F.octet_length(t).alias("_len"),
        F.xxhash64(F.substring(t, 1, PREFIX)).alias("_prefix"),
    )


def _shared(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).count().filter("count > 1").select(*keys)


def digests(docs: DataFrame, all_rows: bool = False) -> DataFrame:
    """A written row (doc_id, _row, _sha, _shared) per document.

    `_shared` says that length and prefix may occur again, and is set wherever they do; only then, or
    with `all_rows`, is `_sha` set.
    `_row` is unique within the table.
    """
    rows = _keyed(docs)
    lengths = written(_shared(rows, "_len"), "dedup-lengths")
    # One row per distinct length: bounded by the longest text, not by the number of rows.
    same_length = rows.join(lengths, "_len", "left_semi")
    pairs = written(_shared(same_length, "_len", "_prefix"), "dedup-prefixes")
    found = marked(rows, sieve(pairs, "_len", "_prefix"), ("_len", "_prefix"), "_hit")
    full = F.unhex(F.sha2("_t", 256))
    sha = full if all_rows else F.when(F.col("_hit"), full)
    return written(
        found.select(
            "doc_id", F.monotonically_increasing_id().alias("_row"), sha.alias("_sha"),
            F.col("_hit").alias("_shared"),
        ),
        "dedup-digests",
    )


def copy_groups(rows: DataFrame) -> DataFrame:
    """Texts that occur more than once: (_sha, _keep_id, _keep_row, _size, _tied), written.

    Rows are counted per (text, doc_id) first; the largest doc_id stays, NULL before all others.
    """
    per_id = (
        rows.filter("_shared").groupBy("_sha", "doc_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("_row").alias("row"))
    )
    groups = per_id.groupBy("_sha").agg(
        F.sum("n").alias("_size"), F.max(F.struct("doc_id", "row", "n")).alias("best")
    )
    return written(
        groups.filter("_size > 1").select(
            "_sha", F.col("best.doc_id").alias("_keep_id"), F.col("best.row").alias("_keep_row"),
            "_size", (F.col("best.n") > 1).alias("_tied"),
        ),
        "dedup-groups",
    )


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 for every row.

    NULL texts count as empty and equal one another. The row with the largest doc_id stays; NULL ids
    lose against any other; of repeated rows with the same id and text exactly one is kept. Other
    columns are ignored, an empty table gives no rows.
    """
    rows = digests(docs, all_rows=True)
    groups = copy_groups(rows)
    plain = rows.filter("NOT _shared").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "_sha",
    )
    # A large group's rows meet one row of `groups`: a skewed join that Spark splits at run time.
    joined = rows.filter("_shared").join(groups, "_sha", "left")
    alone = F.col("_size").isNull()
    grouped = joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("_keep_id")).alias("keep_id"),
        F.coalesce("_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        "_sha",
    )
    return plain.unionByName(grouped).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("_sha")).alias("text_sha256")
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns, that `exact_dedup` keeps."""
    fate = copy_groups(digests(docs)).withColumn("_chosen", F.lit(True))
    return keep_chosen(docs, fate)
