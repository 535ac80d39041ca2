"""Exact medians and quantiles per key without gathering a key's values in one task."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatloom.functions.ordered import ROWS_PER_SEGMENT, drop_segments, plan_split, with_previous


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How often each non-NULL value occurs per key, combined map-side."""
    return (
        df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    )


def exact_median(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    out: str = "median",
    rows_per_segment: int = ROWS_PER_SEGMENT,
) -> DataFrame:
    """Median from `value_counts`, the two middle values averaged.

    Running totals over the distinct values place every value's ranks; the running total is cut
    into segments for keys with very many distinct values. `counts` is read more than once:
    hand in a written or checkpointed table if it is costly.
    """
    keys = list(keys)
    split = plan_split(counts, keys, [value], rows_per_segment)
    placed = drop_segments(with_previous(counts, split, running={"_end": "n"}))
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    start, end, total = F.col("_end") - F.col("n"), F.col("_end"), F.col("_total")

    def at(rank):
        return F.max(F.when((start <= rank) & (rank < end), F.col(value)))

    low, high = at(F.floor((total - 1) / 2)), at(F.floor(total / 2))
    return placed.join(totals, keys).groupBy(*keys).agg(((low + high) / 2).alias(out))


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    fractions: Sequence[float],
    out: str = "quantiles",
    accuracy: int = 10_000,
    beside: Sequence[Column] = (),
) -> DataFrame:
    """Discrete quantiles (the smallest value that at least the fraction of values reaches) per key.

    A mergeable sketch brackets every quantile between two values of known rank error. A second
    pass counts the values below a bracket and, per distinct value, those inside; counts combine
    map-side. Only the distinct values inside, about 4 / `accuracy` of a key's, are then put in
    order. `accuracy` sets that share and the sketch's size, never the result. `beside` are named
    aggregates of `value` per key, computed in the first pass and kept beside the quantiles.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value, F.col(value).alias("_v"))
    around = [b for f in fractions for b in (max(0.0, f - 2 / accuracy), min(1.0, f + 2 / accuracy))]
    brackets = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", around, accuracy).alias("_b"), F.count(F.lit(1)).alias("_n"),
        *([F.struct(*beside).alias("_beside")] if beside else []),
    )
    kept = ["_beside"] if beside else []
    # Per fraction a row is below its bracket (counted without a value), inside (with), or of no use.
    tags = F.array(*[
        F.when(
            F.col("_v") <= F.get("_b", F.lit(2 * i + 1)),
            F.struct(
                F.lit(i).alias("f"),
                F.when(F.col("_v") >= F.get("_b", F.lit(2 * i)), F.col("_v")).alias("inside"),
            ),
        )
        for i in range(len(fractions))
    ])
    counted = (
        rows.join(brackets, keys)
        .select(*keys, "_n", *kept, F.inline(F.array_compact(tags)))
        .groupBy(*keys, "_n", *kept, "f", "inside")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    upto = Window.partitionBy(*keys, "f").orderBy(F.col("inside").asc_nulls_first())
    reached = counted.withColumn("_end", F.sum("n").over(upto))
    wanted = F.element_at(F.array(*map(F.lit, map(float, fractions))), F.col("f") + 1) * F.col("_n")
    hit = F.min(F.when(F.col("_end") >= wanted, F.col("inside")))
    each = reached.groupBy(*keys, *kept, "f").agg(hit.alias("q"))
    pairs = F.sort_array(F.collect_list(F.struct("f", "q")))
    found = each.groupBy(*keys, *kept).agg(F.transform(pairs, lambda p: p["q"]).alias(out))
    return found.select(*keys, out, "_beside.*") if beside else found
