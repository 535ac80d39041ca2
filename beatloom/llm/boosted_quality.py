"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of a text are a few NumPy counts, the same for training and scoring; ids, labels, language
and source are not among them. Trees are grown on quantile bins of a bounded sample of labelled
documents, level by level, from one histogram of gradients per node; they are complete binary trees,
so the forest flattens into three arrays and all rows walk down all trees at once:
node = 2 * node + 1 + (value > threshold).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatloom.llm.arrow import slices
from beatloom.llm.shared import text_or_empty

# At most about this many labelled documents train the trees (a bound on memory, not a filter of
# scored rows); which ones depends on a hash of doc_id alone.
TRAIN_ROWS = 20_000
FOLDS, HELD_FOLD = 5, 0
CUT = 0.3

FEATURES = (
    "log_chars", "log_words", "word_length", "distinct_words", "top_word", "one_letter_words",
    "symbols", "upper", "digits", "punctuation", "exclamations", "pipes", "white", "non_ascii",
    "log_lines", "line_length", "duplicate_lines", "short_lines", "repeat_pairs", "bare_words",
)
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", np.uint8)


def statistics(text: str | None) -> list[float]:
    """FEATURES of one text; all zero for NULL and empty texts."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    count = np.bincount(raw, minlength=256)
    n, chars = len(words), len(text)
    inked = max(1, sum(map(len, words)))
    seen = Counter(words)
    pairs = set(zip(words, words[1:], strict=False))
    lines = [line for line in text.split("\n") if line.strip()]
    return [
        np.log1p(chars), np.log1p(n), inked / n, len(seen) / n, seen.most_common(1)[0][1] / n,
        sum(c for w, c in seen.items() if len(w) == 1) / n,
        count[_SYMBOLS].sum() / n, count[65:91].sum() / inked, count[48:58].sum() / inked,
        count[_PUNCTUATION].sum() / n, count[33] / n, count[124] / n,
        (chars - inked) / chars, count[128:].sum() / len(raw),
        np.log1p(len(lines)), chars / len(lines), 1 - len(set(lines)) / len(lines),
        sum(len(line) < 30 for line in lines) / len(lines),
        1 - len(pairs) / max(1, n - 1),
        sum(c for w, c in seen.items() if not any(map(str.isalpha, w))) / n,
    ]


@dataclass(frozen=True)
class Forest:
    """`feature` and `threshold` (trees, inner nodes), `value` (trees, leaves) and the base score."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for every row of features."""
        total = np.full(len(rows), self.base)
        if len(self.feature):
            depth = int(np.log2(self.value.shape[1]))
            trees, at = np.arange(len(self.feature))[None, :], np.arange(len(rows))[:, None]
            node = np.zeros((len(rows), len(self.feature)), np.int64)
            for _ in range(depth):
                right = rows[at, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            total += self.value[trees, node - self.feature.shape[1]].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(
    rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 64,
    rate: float = 0.15, ridge: float = 1.0, least: float = 5.0,
) -> Forest:
    """Logistic boosting; without rows of both labels the forest is empty and gives their share."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(np.unique(labels)) < 2:
        empty = np.zeros((0, inner))
        return Forest(empty.astype(np.int64), empty, np.zeros((0, leaves)), base)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in rows.T]
    binned = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, rows.T, strict=True)], 1)
    width, n_features = bins, rows.shape[1]
    total = np.full(len(rows), base)
    features, thresholds, values = [], [], []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        gradient, hessian = chance - labels, chance * (1 - chance)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, bins, np.int64)
        node = np.zeros(len(rows), np.int64)
        for level in range(depth):
            first, number = 2**level - 1, 2**level
            place = (node - first)[:, None] * n_features + np.arange(n_features)
            place = (place * width + binned).ravel()
            shape = (number, n_features, width)
            g, h = (
                np.bincount(place, np.repeat(w, n_features), number * n_features * width).reshape(shape)
                for w in (gradient, hessian)
            )
            gl, hl = g.cumsum(2), h.cumsum(2)
            gt, ht = gl[..., -1:], hl[..., -1:]
            gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
            gain[(hl < least / 4) | (ht - hl < least / 4)] = 0
            best = gain.reshape(number, -1).argmax(axis=1)
            useful = gain.reshape(number, -1).max(axis=1) > 1e-9
            feature[first : first + number] = np.where(useful, best // width, 0)
            cut[first : first + number] = np.where(useful, best % width, bins)
            node = 2 * node + 1 + (binned[np.arange(len(rows)), feature[node]] > cut[node])
        leaf = node - inner
        g, h = np.bincount(leaf, gradient, leaves), np.bincount(leaf, hessian, leaves)
        value = -rate * g / (h + ridge)
        total += value[leaf]
        # A bin's upper edge is the threshold; past the last edge nothing goes right.
        threshold = np.array([
            edges[f][c] if c < len(edges[f]) else np.inf for f, c in zip(feature, cut, strict=True)
        ])
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(np.array(features), np.array(thresholds), np.array(values), base)


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """crc32 of the id's text modulo `folds`; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def training_sample(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of labelled documents outside the held fold, about `rows` at most.

    Several labels of one id count as their mean; of several documents with one id one is used.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold() != HELD_FOLD))
        .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
    )
    number = known.count()
    parts = 1_000_000
    share = parts if number <= rows else int(parts * rows / number)
    # At most about `rows` pairs of numbers, so their broadcast is bounded.
    sample = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(parts)) < share)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    wanted = texts.join(F.broadcast(sample), "doc_id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            rows = [statistics(t) for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("label"), pa.array(rows, pa.list_(pa.float64()))],
                ["doc_id", "label", "x"],
            )

    found = wanted.mapInArrow(featured, "doc_id long, label int, x array<double>")
    one = found.groupBy("doc_id").agg(F.min(F.struct("x", "label")).alias("r")).select("doc_id", "r.*")
    table = one.toArrow().sort_by("doc_id")
    x = np.array(table.column("x").to_pylist(), float).reshape(-1, len(FEATURES))
    return x, table.column("label").to_numpy().astype(float)


def quality_scores(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score and predicted for every document.

    NULL and empty texts are scored on zero statistics; a NULL id is not held out; repeated rows are
    scored each; other columns are ignored; an empty table gives no rows. Without usable labels
    every score is 0.5, with one label only its smoothed share.
    """
    forest = fit(*training_sample(docs, labels, rows))
    schema = "doc_id long, held_out boolean, score double, predicted int"

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            x = np.array([statistics(t) for t in part.column("text").to_pylist()])
            score = forest.score(x)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"), part.column("held_out"), pa.array(score),
                    pa.array((score >= cut).astype(np.int32)),
                ],
                ["doc_id", "held_out", "score", "predicted"],
            )

    texts = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(fold() == HELD_FOLD, F.lit(False)).alias("held_out"),
        text_or_empty().alias("text"),
    )
    return texts.mapInArrow(scored, schema)
