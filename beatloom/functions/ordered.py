"""Previous-row values and row numbers that survive a key holding a large share of all rows.

`Window.partitionBy(key)` puts every row of a key into one task. Here a heavy key is first cut
into ordered segments, the window runs per (key, segment), and one small row per segment carries
the last values and the row count over to the next segment. Results equal the plain window.

Three ways to cut:

* `time_split` cuts every key at multiples of a time span; it needs no pass. A segment has as many rows as
  the span has beats, so it suits series with a highest rate, and a day of one record is as long as a day of any.
* `plan_split` measures the keys and cuts only the heavy ones at quantiles of the order column, in
  several levels if one level of `MAX_CUTS_PER_KEY` cuts leaves segments too long: a segment has about
  `rows_per_segment` rows, however large the key or the table is.
* `block_split` cuts every key at multiples of a unique integer order column; it needs no pass.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatloom.session import ensure_checkpoint_dir

ROWS_PER_SEGMENT = 2_000_000
# A week: about 600,000 beats at one a second.
SECONDS_PER_SEGMENT = 604_800.0
# Cuts of one level: the length of an array per heavy key. Longer keys get another level.
MAX_CUTS_PER_KEY = 4_096
BROADCAST_BYTES = 32 << 20

_SEG, _SUB, _COARSE = "_segment", "_subsegment", "_coarse"


@dataclass(frozen=True)
class Split:
    """How the rows of `keys`, ordered by `order`, are cut into segments."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    rows_per_segment: int
    cuts: DataFrame | None = None
    most_cuts: int = 0
    has_ties: bool = False
    small: bool = True
    finer: Split | None = None
    blocks: bool = False
    seconds: float = 0.0

    @property
    def cut_any(self) -> bool:
        return self.blocks or self.cuts is not None

    @property
    def partition(self) -> list[str]:
        return [*self.keys, *self.segments] if self.cut_any else list(self.keys)

    @property
    def segments(self) -> list[str]:
        """Columns that name a segment of a key, in its order."""
        return [_SEG, _SUB] if self.finer is None else [*_coarse(self.keys), *self.finer.segments]

    def _block(self, index: str) -> Column:
        if self.seconds:
            return F.floor(F.col(index) / F.lit(float(self.seconds))).cast("long")
        return F.expr(f"{index} div {self.rows_per_segment}")

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the segment columns, unless `df` already has them or nothing is cut."""
        if not self.cut_any or set(self.segments) <= set(df.columns):
            return df
        if self.blocks:
            return df.withColumns({_SEG: self._block(self.order[0]), _SUB: F.lit(0).cast("long")})
        if self.finer is not None:
            return self.finer.assign(self._coarsely(df))
        return self._level(df)

    def _coarsely(self, df: DataFrame) -> DataFrame:
        return self._level(df).withColumnsRenamed(dict(zip((_SEG, _SUB), _coarse(self.keys))))

    def _level(self, df: DataFrame) -> DataFrame:
        value = F.col(self.order[0])
        cuts = F.broadcast(self.cuts) if self.small else self.cuts
        rows = df.join(cuts, list(self.keys), "left").withColumn(_SEG, F.lit(0))
        # Binary search for the number of cuts <= value, one generated projection per step.
        for step in _halving_steps(self.most_cuts):
            reached = f"get(_cuts, {_SEG} + {step - 1}) <= {self.order[0]}"
            rows = rows.withColumn(_SEG, F.expr(f"{_SEG} + if({reached}, {step}, 0)"))
        # A value holding several cuts on its own gets a segment for itself, cut further by the
        # tie-breaker, a unique running number: at most `rows_per_segment` rows share a quotient.
        tied = F.coalesce(F.array_contains("_ties", value), F.lit(False))
        whole = F.lit(0).cast("long")
        tie_block = self._block(self.order[1]) if len(self.order) > 1 else whole
        segment = F.col(_SEG).cast("long") * 2 - tied.cast("long")
        # Of a key cut on a level above, every part has a number; of an uncut key none.
        above = [k for k in self.keys if k.startswith(_COARSE)]
        uncut = F.when(F.col(above[0]).isNotNull(), whole) if above else F.lit(None).cast("long")
        return rows.withColumns(
            {
                _SEG: F.when(F.col("_cuts").isNotNull(), segment).otherwise(uncut),
                _SUB: F.when(tied, tie_block).otherwise(whole),
            }
        ).drop("_cuts", "_ties")


def _coarse(keys: Sequence[str]) -> list[str]:
    """Names of a level's segment columns where another level follows."""
    level = sum(k.startswith(_COARSE) for k in keys) // 2
    return [f"{_COARSE}{level}", f"{_COARSE}{level}_sub"]


def _halving_steps(most: int) -> list[int]:
    return [1 << p for p in reversed(range(max(1, most).bit_length()))]


def block_split(
    keys: Sequence[str], order: str, rows_per_segment: int = ROWS_PER_SEGMENT
) -> Split:
    """Cut every key by a unique integer order column: no segment can exceed `rows_per_segment`."""
    return Split(tuple(keys), (order,), rows_per_segment, blocks=True)


def time_split(
    keys: Sequence[str], order: Sequence[str], seconds: float = SECONDS_PER_SEGMENT
) -> Split:
    """Cut every key at multiples of `seconds` of the first order column, without looking at the rows.

    Equal times stay in one segment, in the order of the other columns.
    """
    return Split(tuple(keys), tuple(order), 0, blocks=True, seconds=seconds)


def plan_split(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> Split:
    """Measure `df` and decide which keys to cut, and where.

    One narrow counting pass; if there are heavy keys, it is repeated to store them, and another one reads only
    their rows. Keys and the
    first order column must be non-NULL in the rows that are ordered later. Heavy keys and cuts are
    checkpointed tables with at most a row per `rows_per_segment` rows of `df`; the driver sees
    their totals only.
    """
    keys, order = tuple(keys), tuple(order)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = sizes.filter(F.col("_n") > rows_per_segment)
    seen = heavy.agg(F.count(F.lit(1)).alias("keys"), F.max("_n").alias("largest")).first()
    if not seen["keys"]:  # the usual case: nothing is stored
        return Split(keys, order, rows_per_segment)

    ensure_checkpoint_dir(df.sparkSession)
    heavy = heavy.checkpoint()
    few = seen["keys"] * 64 <= BROADCAST_BYTES
    marked = df.join(F.broadcast(heavy) if few else heavy, list(keys))
    pieces = min(MAX_CUTS_PER_KEY, math.ceil(seen["largest"] / rows_per_segment))
    fractions = [i / pieces for i in range(1, pieces)]
    quantiles = marked.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        F.percentile_approx(order[0], fractions, max(10_000, 8 * pieces)).alias("_q"),
    )
    # Keep only as many cuts as the key's own size asks for.
    wanted = F.least(F.ceil(F.col("_n") / F.lit(rows_per_segment)), F.lit(pieces))
    thinned = F.filter(
        "_q",
        lambda _, i: F.floor((i + F.lit(1)) * wanted / F.lit(pieces))
        > F.floor(i * wanted / F.lit(pieces)),
    )
    repeated = F.filter(
        "_q", lambda v, i: F.coalesce(F.get("_q", i + F.lit(1)) == v, F.lit(False))
    )
    cuts = (
        quantiles.withColumn("_q", thinned)
        .select(*keys, F.array_distinct("_q").alias("_cuts"), F.array_distinct(repeated).alias("_ties"))
        .checkpoint()
    )
    made = cuts.agg(
        F.max(F.size("_cuts")).alias("most"), F.max(F.size("_ties")).alias("ties"),
        F.sum(F.size("_cuts")).alias("all"),
    ).first()
    split = Split(
        keys, order, rows_per_segment, cuts, most_cuts=made["most"], has_ties=made["ties"] > 0,
        small=16 * made["all"] + 64 * seen["keys"] <= BROADCAST_BYTES,
    )
    if seen["largest"] <= MAX_CUTS_PER_KEY * rows_per_segment:
        return split
    # Segments of the largest keys are still too long: they are cut again, as keys of their own.
    # What is tied is already in segments of its own, and not cut further.
    longer = [*keys, *_coarse(keys)]
    coarse = split._coarsely(df.select(*keys, *order)).filter(F.col(longer[-2]).isNotNull())
    finer = plan_split(coarse, longer, order, rows_per_segment)
    return replace(split, finer=finer) if finer.cut_any else split


def with_previous(
    df: DataFrame,
    split: Split,
    previous: Mapping[str, str] | None = None,
    index: str | None = None,
    running: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add `{new column: source column of the previous row}` and a 0-based row `index` per key.

    `running` adds `{new column: source column summed up to and including this row}`.

    The segment columns stay on the result, so that a second call with the same split reuses the
    partitioning; `drop_segments` removes them.
    """
    previous, running = dict(previous or {}), dict(running or {})
    rows = split.assign(df)
    ordered = Window.partitionBy(*split.partition).orderBy(*split.order)
    added = {name: F.lag(source).over(ordered) for name, source in previous.items()}
    upto = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added |= {name: F.sum(source).over(upto) for name, source in running.items()}
    if index or split.cut_any:
        added["_position"] = F.row_number().over(ordered).cast("long")
    out = rows.withColumns(added)

    if split.cut_any:
        at = [*split.keys, *split.segments]
        carry = _carry(rows, split, previous, running)
        # One row per segment after a key's first. One level of planned cuts without ties makes no
        # more of them than there are cuts, whose size was checked. Otherwise the join runs on
        # the partitioning the rows already have.
        bounded = split.small and not (split.blocks or split.has_ties or split.finer)
        out = out.join(F.broadcast(carry) if bounded else carry, at, "left")
        first = F.col("_position") == 1
        for name in previous:
            out = out.withColumn(name, F.when(first, F.col(f"_carry_{name}")).otherwise(F.col(name)))
        for name in running:
            ahead = F.coalesce(F.col(f"_carry_{name}"), F.lit(0))
            out = out.withColumn(name, F.col(name) + ahead)
        out = out.withColumn("_position", F.col("_position") + F.coalesce("_before", F.lit(0)))
        out = out.drop("_before", *[f"_carry_{name}" for name in [*previous, *running]])
    if index:
        out = out.withColumn(index, F.col("_position") - 1)
    return out.drop("_position")


def _carry(
    rows: DataFrame, split: Split, previous: Mapping[str, str], running: Mapping[str, str]
) -> DataFrame:
    """Per cut segment: the last values of the segment before it, rows and sums ahead of it."""
    at = [*split.keys, *split.segments]
    last = F.col(split.order[0]) if len(split.order) == 1 else F.struct(*split.order)
    tails = (
        rows.filter(F.col(split.segments[0]).isNotNull())
        .groupBy(*at)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.max_by(source, last).alias(f"_last_{name}") for name, source in previous.items()],
            *[F.sum(source).alias(f"_sum_{name}") for name, source in running.items()],
        )
    )
    along = Window.partitionBy(*split.keys).orderBy(*split.segments)
    ahead = along.rowsBetween(Window.unboundedPreceding, -1)
    return tails.select(
        *at,
        F.sum("_rows").over(ahead).alias("_before"),
        *[F.lag(f"_last_{name}").over(along).alias(f"_carry_{name}") for name in previous],
        *[F.sum(f"_sum_{name}").over(ahead).alias(f"_carry_{name}") for name in running],
    ).filter(F.col("_before").isNotNull())


def drop_segments(df: DataFrame) -> DataFrame:
    return df.drop(_SEG, _SUB, *[c for c in df.columns if c.startswith(_COARSE)])
