"""Which records a job works on: explicit ids, an inclusive number range, a limit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class RecordFilterError(ValueError):
    """The requested records cannot be read from the arguments, or none of them exist."""


@dataclass(frozen=True)
class RecordFilter:
    """Requested records: a list of ids, or the bounds of a range of whole numbers."""

    ids: tuple[str, ...] | None = None
    bounds: tuple[int, int] | None = None

    def frame(self, spark: SparkSession) -> DataFrame:
        """The requested ids as rows, whether they exist or not."""
        if self.ids is not None:
            return spark.createDataFrame([(i,) for i in self.ids], "record_id string").distinct()
        low, high = self.bounds
        return spark.range(low, high + 1).select(F.col("id").cast("string").alias("record_id"))

    def condition(self, record_id: str = "record_id") -> Column:
        """A predicate, so that it prunes partitions and reaches the file scan."""
        if self.ids is not None:
            return F.col(record_id).isin(*self.ids)
        # Only the plain spelling of a number is in the range: "7", not "007".
        number = F.expr(f"try_cast({record_id} as bigint)")
        plain = number.cast("string") == F.col(record_id)
        return plain & number.between(*self.bounds)


def _number(text: str, what: str) -> int:
    try:
        return int(text.strip())
    except ValueError as error:
        raise RecordFilterError(f"{what} is not a whole number: {text!r}") from error


def parse_record_filter(
    ids: str | None = None, range: str | None = None, limit: str | int | None = None
) -> RecordFilter | None:
    """Read the three arguments; ids win over the range, the limit cuts the requested list.

    None means no filter. The limit applies before the request meets the available records.
    """
    ids = ids if ids and ids.strip() else None
    range = range if range and range.strip() else None
    limit = str(limit) if limit is not None and str(limit).strip() else None
    if ids is None and range is None:
        if limit is not None:
            raise RecordFilterError("a limit needs ids or a range to cut")
        return None

    if ids is not None:
        wanted = [name for part in ids.split(",") if (name := part.strip())]
        if not wanted:
            raise RecordFilterError("no ids between the separators")
    else:
        low_text, dash, high_text = range.strip().partition("-")
        if not dash:
            raise RecordFilterError(f"range is not start-end: {range!r}")
        low, high = _number(low_text, "range start"), _number(high_text, "range end")
        if low > high:
            raise RecordFilterError(f"range start {low} is above its end {high}")

    if limit is not None:
        most = _number(limit, "limit")
        if most < 1:
            raise RecordFilterError("limit must be at least 1")
        if ids is not None:
            wanted = wanted[:most]
        else:
            high = min(high, low + most - 1)
    return RecordFilter(ids=tuple(wanted)) if ids is not None else RecordFilter(bounds=(low, high))


def filter_records(
    df: DataFrame,
    ids: str | None = None,
    range: str | None = None,
    limit: str | int | None = None,
    require_match: bool = True,
) -> DataFrame:
    """Rows of the requested records. Fails if a filter was given and nothing matches it."""
    wanted = parse_record_filter(ids, range, limit)
    if wanted is None:
        return df
    kept = df.filter(wanted.condition())
    if require_match and kept.isEmpty():
        raise RecordFilterError("the record filter matches no available record")
    return kept
