"""A Bloom filter as a broadcast table: which rows may share a key with a table of any size.

Every key sets BITS bits of one 64-bit word. A filter has at most SLOTS words, one row each, so its
broadcast is bounded whatever the number of keys, and the plan is the same at every size. A key that
is in the table is always found; beyond about ten keys a word more rows without one are found as
well, so whoever uses the filter has to join the rows it finds with the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatloom.llm.shared import fresh

# A word takes about 50 bytes in a broadcast hash table: 13 MB in all.
SLOTS = 1 << 18
BITS = 4


def _slot_and_mask(keys: tuple[str, ...]) -> tuple[Column, Column]:
    """Word number and bits of a row's key; the bits come from other parts of the hash."""
    h = F.xxhash64(*keys)
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        at = F.shiftrightunsigned(h, 40 + 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
    return F.pmod(h, F.lit(SLOTS).cast("long")), mask


def sieve(table: DataFrame, *keys: str) -> DataFrame:
    """(_slot, _bits): the filter of the table's keys, combined map-side. NULL keys count as keys."""
    slot, mask = _slot_and_mask(keys)
    return table.select(slot.alias("_slot"), mask.alias("_mask")).groupBy("_slot").agg(
        F.bit_or("_mask").alias("_bits")
    )


def marked(df: DataFrame, words: DataFrame, keys: tuple[str, ...], flag: str) -> DataFrame:
    """`df` with the boolean `flag`: FALSE only where no row of the filter's table has these keys.

    The keys need the types they have in that table. Rows stay where they are.
    """
    slot, mask = _slot_and_mask(keys)
    at, need, bits = (fresh(df, c) for c in ("_slot", "_mask", "_bits"))
    found = df.withColumns({at: slot, need: mask}).join(
        F.broadcast(words.toDF(at, bits)), at, "left"
    )
    hit = F.coalesce(F.col(bits).bitwiseAND(F.col(need)) == F.col(need), F.lit(False))
    return found.withColumn(flag, hit).drop(at, need, bits)
