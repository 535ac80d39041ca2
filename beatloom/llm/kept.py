"""Keep the chosen row of each group of texts, with all columns of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.shared import fresh, text_or_empty
from beatloom.llm.sieve import marked, sieve


def keep_chosen(docs: DataFrame, fate: DataFrame) -> DataFrame:
    """Rows of `docs` less those that lose within their group.

    `fate` is a written table with a row per text that is in some group: `_sha` (SHA-256, binary),
    `_chosen` (whether the row that stays has this text), `_keep_id` (its doc_id) and `_tied` (whether
    several rows have both). Of tied rows, equal in id and text, an arbitrary one stays. Texts
    without a row in `fate` stay: most of them miss the filter of its digests and pass where they
    are read, the others meet it in a join, whose heavy texts Spark splits at run time.
    """
    names = {c: fresh(docs, c) for c in ("_sha", "_chosen", "_keep_id", "_tied")}
    sha, chosen, keep_id, tied = names.values()
    hit = fresh(docs, "_hit")
    digested = docs.withColumn(sha, F.unhex(F.sha2(text_or_empty(), 256)))
    found = marked(digested, sieve(fate, "_sha"), (sha,), hit)
    own = [F.col(f"`{c}`") for c in docs.columns]
    judged = found.filter(F.col(hit)).join(fate.select(*names).toDF(*names.values()), sha, "left")
    best = F.col(chosen) & F.col("doc_id").eqNullSafe(F.col(keep_id))
    stay = judged.filter(F.col(chosen).isNull() | (best & ~F.col(tied))).select(*own)
    out = found.filter(~F.col(hit)).select(*own).unionByName(stay)
    if fate.filter("_chosen AND _tied").isEmpty():
        return out
    row = fresh(docs, "_first")
    one = judged.filter(best & F.col(tied)).groupBy(sha).agg(F.first(F.struct(*own)).alias(row))
    return out.unionByName(one.select(f"{row}.*"))
