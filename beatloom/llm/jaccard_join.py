"""N-gram Jaccard self-join with Bayesian candidate pruning (after BayesLSH, Satuluri 2012).

Documents with equal shingle sets form a class, which takes part once. Class signatures are cut into
bands; classes that share a band value are candidates. Buckets are compared in blocks of bounded
size inside tasks: MinHash values are compared step by step, a pair is dropped as soon as the
posterior probability of reaching the threshold falls below the tolerance, and the rest is verified
on the shingles themselves. A pair is compared only in the first band it shares, so no pair is
counted twice and none has to be sent anywhere as a row: tasks return partner lists, then counts and
a spanning star per block.

With 32 bands of 4 a pair of similarity 0.8 shares no band with odds of 5e-8, and pruning at 1e-7
loses it with odds of the same order.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import binary_rows, slices, whole_groups
from beatloom.llm.components import components
from beatloom.llm.kept import keep_chosen
from beatloom.llm.shared import broadcast_if_small, text_or_empty, written
from beatloom.llm.shingles import MinHash, Shingler

THRESHOLD = 0.8
BANDS, BAND_SIZE = 32, 4
TOLERANCE = 1e-7
STEP = 16
BLOCK = 512

_GROUP = ["h", "bi", "bj"]


def least_matches(seen: int, threshold: float, tolerance: float) -> int:
    """Fewest of `seen` equal MinHash values with which a pair stays in the race.

    Under a uniform prior the similarity has a Beta posterior; P(s >= t | m of n) equals
    P(Binomial(n + 1, t) <= m).
    """
    total = 0.0
    for m in range(seen + 1):
        total += comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        if total >= tolerance:
            return m
    return seen


def shingle_rows(docs: DataFrame) -> DataFrame:
    """Written: doc_id, _row, _sha, _key (digest of the shingle set), n, sig, shingles per document."""
    schema = (
        "doc_id long, _row long, _sha binary, _key binary, n int, sig binary, shingles binary"
    )

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingler, minhash = Shingler(), MinHash(BANDS * BAND_SIZE)
        for part in slices(batches):
            sets = [shingler(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("_row"), part.column("_sha"),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int32()),
                    binary_rows([minhash(s) for s in sets]),
                    binary_rows(sets),
                ],
                ["doc_id", "_row", "_sha", "_key", "n", "sig", "shingles"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("_row"),
        F.unhex(F.sha2(text_or_empty(), 256)).alias("_sha"), text_or_empty().alias("text"),
    )
    return written(rows.mapInArrow(shingled, schema), "jaccard-shingles")


def classes_of(rows: DataFrame) -> DataFrame:
    """Written: one row per distinct non-empty shingle set: rep (its smallest _row), size, sig."""
    return written(
        rows.filter("n > 0").groupBy("_key").agg(
            F.min("_row").alias("rep"), F.count(F.lit(1)).alias("size"),
            F.min("doc_id").alias("least_id"), F.first("sig").alias("sig"),
        ),
        "jaccard-classes",
    )


def _bucket_blocks(classes: DataFrame, block: int) -> DataFrame:
    """(h, bi, bj, band, side, rep, sig): every class in each block pair of its shared buckets."""
    width = 4 * BAND_SIZE
    values = F.array(*[
        F.struct(
            F.lit(k).alias("band"),
            F.xxhash64(F.lit(k), F.substring("sig", 1 + k * width, width)).alias("h"),
        )
        for k in range(BANDS)
    ])
    bands = classes.select("rep", F.inline(values))
    shared = bands.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = written(bands.join(shared, "h"), "jaccard-buckets")
    parts = F.ceil(F.col("n") / F.lit(block)).cast("int")
    placed = members.withColumns({"parts": parts, "b": F.pmod(F.xxhash64("rep"), parts).cast("int")})
    pairs = placed.select(
        "h", "band", "rep", "b", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("o")
    )
    return pairs.select(
        "h", F.least("b", "o").alias("bi"), F.greatest("b", "o").alias("bj"), "band", "b", "rep"
    ).join(classes.select("rep", "sig"), "rep")


def _by_group(df: DataFrame) -> DataFrame:
    return df.repartition(*_GROUP).sortWithinPartitions(*_GROUP)


def candidates(
    classes: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK
) -> DataFrame:
    """Written: (h, bi, bj, rep, partners): the pairs that pruning leaves, as lists of partners.

    Partners of a class are listed once, on one side; the other side has a row as well.
    """
    schema = "h long, bi int, bj int, rep long, partners array<long>"
    size = BANDS * BAND_SIZE
    least = {n: least_matches(n, threshold, tolerance) for n in range(STEP, size + 1, STEP)}

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, _GROUP):
            sigs = np.frombuffer(
                b"".join(table.column("sig").to_pylist()), np.uint32
            ).reshape(-1, size)
            reps, side, band, bi, bj, h = (
                table.column(c).to_numpy() for c in ("rep", "b", "band", "bi", "bj", "h")
            )
            out: list[tuple] = []
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi - lo < 2:
                    continue
                if bi[lo] == bj[lo]:
                    a, b = np.triu_indices(hi - lo, 1)
                else:
                    left, right = np.flatnonzero(side[lo:hi] == bi[lo]), np.flatnonzero(side[lo:hi] == bj[lo])
                    a, b = np.repeat(left, len(right)), np.tile(right, len(left))
                a, b = _race(sigs[lo:hi], a, b, int(band[lo]), least)
                if not len(a):
                    continue
                order = np.argsort(a, kind="stable")
                a, b = a[order], b[order]
                starts = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                lists = dict(zip(a[starts].tolist(), np.split(reps[lo:hi][b], starts[1:]), strict=True))
                for i in sorted({*lists, *b.tolist()}):
                    out.append((h[lo], bi[lo], bj[lo], reps[lo + i], lists.get(i, ())))
            yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [*_GROUP, "rep", "partners"]
        )

    blocks = _by_group(_bucket_blocks(classes, block))
    return written(blocks.mapInArrow(pruned, schema), "jaccard-candidates")


def _race(
    sigs: np.ndarray, a: np.ndarray, b: np.ndarray, band: int, least: dict[int, int], most: int = 1 << 18
) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (a, b) that no earlier band has and that survive all steps, `most` at a time."""
    left, right = [], []
    for at in range(0, len(a), most):
        x, y = a[at : at + most], b[at : at + most]
        equal = np.zeros(len(x), np.int32)
        for n in sorted(least):
            same = sigs[x, n - STEP : n] == sigs[y, n - STEP : n]
            equal += same.sum(axis=1, dtype=np.int32)
            owned = np.ones(len(x), bool)
            for k in range((n - STEP) // BAND_SIZE, min(n // BAND_SIZE, band)):
                at_k = k * BAND_SIZE - (n - STEP)
                owned &= ~same[:, at_k : at_k + BAND_SIZE].all(axis=1)
            stay = owned & (equal >= least[n])
            x, y, equal = x[stay], y[stay], equal[stay]
        left.append(x)
        right.append(y)
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def verified(
    rows: DataFrame, classes: DataFrame, pairs: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Written: (rep, root, n_links) per class and block: exact links counted by the documents on
    the other side, and the smallest class its block ties it to."""
    schema = "rep long, root long, n_links long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cuts in whole_groups(batches, _GROUP):
            reps, sizes = table.column("rep").to_numpy(), table.column("size").to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in table.column("shingles").to_pylist()]
            partners = table.column("partners").to_pylist()
            links, root = np.zeros(len(reps), np.int64), reps.copy()
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                place = {r: lo + i for i, r in enumerate(reps[lo:hi].tolist())}
                parent = list(range(lo, hi))

                def top(i: int, lo: int = lo, parent: list[int] = parent) -> int:
                    while parent[i - lo] != i:
                        parent[i - lo] = parent[parent[i - lo] - lo]
                        i = parent[i - lo]
                    return i

                for i in range(lo, hi):
                    for j in _linked(sets, i, [place[r] for r in partners[i] or ()], threshold):
                        links[i] += sizes[j]
                        links[j] += sizes[i]
                        x, y = top(i), top(j)
                        if x != y:
                            x, y = (x, y) if reps[x] < reps[y] else (y, x)
                            parent[y - lo] = x
                for i in range(lo, hi):
                    root[i] = reps[top(i)]
            found = links > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(reps[found]), pa.array(root[found]), pa.array(links[found])],
                ["rep", "root", "n_links"],
            )

    asked = written(pairs.select("rep").distinct(), "jaccard-asked")
    needed = rows.select(F.col("_row").alias("rep"), "shingles").join(
        broadcast_if_small(asked, 80), "rep", "left_semi"
    )
    filled = pairs.join(needed, "rep").join(classes.select("rep", "size"), "rep")
    return written(_by_group(filled).mapInArrow(counted, schema), "jaccard-links")


def _linked(sets: list[np.ndarray], i: int, others: list[int], threshold: float) -> list[int]:
    """Those of `others` whose Jaccard similarity with set i reaches the threshold."""
    found = []
    for at in range(0, len(others), 256):
        part = others[at : at + 256]
        lengths = np.array([len(sets[j]) for j in part])
        values = np.concatenate([sets[j] for j in part])
        place = np.searchsorted(sets[i], values)
        hit = sets[i][np.minimum(place, len(sets[i]) - 1)] == values
        common = np.add.reduceat(hit.astype(np.int64), np.r_[0, np.cumsum(lengths)[:-1]])
        # common / union >= threshold in whole thousandths, so that 0.8 is exactly 4/5
        union = lengths + len(sets[i]) - common
        ok = 1000 * common >= round(1000 * threshold) * union
        found.extend(np.array(part)[ok].tolist())
    return found


def _joined(docs: DataFrame, threshold: float, tolerance: float, block: int):
    rows = shingle_rows(docs)
    classes = classes_of(rows)
    links = verified(rows, classes, candidates(classes, threshold, tolerance, block), threshold)
    roots = components(links.select(F.col("rep").alias("u"), F.col("root").alias("v")))
    summed = links.groupBy("rep").agg(F.sum("n_links").alias("n_links"))
    placed = written(
        classes.select("_key", "rep", "size", "least_id")
        .join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .join(summed, "rep", "left")
        .select(
            "_key", "size", "least_id", F.coalesce("root", "rep").alias("root"),
            (F.coalesce("n_links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        ),
        "jaccard-placed",
    )
    return rows, placed


def jaccard_join(
    docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK
) -> DataFrame:
    """doc_id, class_id, class_size, n_links per row: links are other rows at `threshold` or more.

    Shingles are five words between white space; a text of one to four words is one shingle. A class
    is a connected component of links and bears its smallest doc_id (NULL if it has no other). Texts
    without words (NULL, empty, blank) link to nothing: class_id is their own doc_id, n_links 0.
    Repeated rows and copies link to one another. Other columns are ignored; an empty table gives
    none.
    """
    rows, placed = _joined(docs, threshold, tolerance, block)
    named = placed.groupBy("root").agg(F.min("least_id").alias("class_id"), F.sum("size").alias("class_size"))
    known = written(
        placed.join(named, "root").select("_key", "class_id", "class_size", "n_links"), "jaccard-named"
    )
    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    blank = rows.filter("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), one.alias("class_size"), zero.alias("n_links")
    )
    return (
        rows.filter("n > 0").select("doc_id", "_key").join(known, "_key")
        .select("doc_id", "class_id", "class_size", "n_links").unionByName(blank)
    )


def drop_near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns, less all but one of every class: the smallest doc_id stays."""
    rows, placed = _joined(docs, threshold, TOLERANCE, BLOCK)
    grown = placed.groupBy("root").agg(F.sum("size").alias("n")).filter("n > 1")
    members = rows.select("_key", "_sha", "doc_id").join(
        placed.join(grown, "root", "left_semi").select("_key", "root"), "_key"
    )
    per_text = members.groupBy("root", "_sha", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    texts = written(per_text, "jaccard-members")
    best = texts.groupBy("root").agg(F.min(F.struct("doc_id", "_sha", "n")).alias("best"))
    fate = texts.select("root", "_sha").distinct().join(best, "root").select(
        "_sha", (F.col("_sha") == F.col("best._sha")).alias("_chosen"),
        F.col("best.doc_id").alias("_keep_id"), (F.col("best.n") > 1).alias("_tied"),
    )
    return keep_chosen(docs, written(fate, "jaccard-fate"))
