"""Quality rules: a threshold table compiled into one projection of built-in functions.

Measures of a text (NULL: no words) are columns; each row of the table bounds one measure; a text
is kept if the base rule and every bound hold. There is no user function, shuffle or join: a row is
judged by itself, so hot sources, copies and repeated ids do not matter.

Repeated 3-word windows are found inside the row: windows become 64-bit hashes, a primitive sort
order brings equal ones together, and only texts with a repeat pay for the positions. Two different
windows of one text share a hash with odds of n^2 / 2^65 (1e-10 for 40,000 words).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beatloom.llm.shared import fresh

# Fixed values of the contract: white space between words, symbols, base rule.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

STOP_WORDS = (
    "a and are be for from in is it of on or that the this to was with "
    "au avec dans de des du elle en est et la le les par pas pour que qui sur un une "
    "als auf das dem den der die ein eine für ich im ist mit nicht sich und von zu "
    "al como con del el es las lo los más no por se su y"
).split()
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ"


@dataclass(frozen=True)
class Bound:
    """A text fails the rule when `value` (SQL over the measures) leaves [least, most]."""

    rule: str
    value: str
    least: float | None = None
    most: float | None = None

    def fails(self) -> Column:
        value, broken = F.expr(self.value), F.lit(False)
        if self.least is not None:
            broken = broken | (value < F.lit(self.least))
        if self.most is not None:
            broken = broken | (value > F.lit(self.most))
        return F.coalesce(broken, F.lit(False))


# Ratios to words, capitals or lines of at least one, so that no denominator is zero.
RULES: tuple[Bound, ...] = (
    Bound("word_length", "word_chars / greatest(n_words, 1)", least=3.0, most=10.0),
    Bound("symbols", "n_symbols / greatest(n_words, 1)", most=0.1),
    Bound("letters", "n_letter_words / greatest(n_words, 1)", least=0.8),
    Bound("stop_words", "n_stop_words", least=2.0),
    Bound("capitals", "n_capitals / greatest(word_chars, 1)", most=0.4),
    Bound("exclamations", "n_exclamations / greatest(n_words, 1)", most=0.5),
    Bound("duplicate_lines", "n_dup_lines / greatest(n_lines, 1)", most=0.4),
    Bound("bullet_lines", "n_bullet_lines / greatest(n_lines, 1)", most=0.9),
    Bound("ellipsis_lines", "n_ellipsis_lines / greatest(n_lines, 1)", most=0.3),
)


def _removed(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def with_measures(docs: DataFrame, text: str = "text") -> tuple[DataFrame, str]:
    """`docs` with one struct column of measures, and that column's name.

    Every intermediate array is a column of its own and is used at least twice by the step above,
    so the optimizer does not move it into a lambda, where it would be made anew per element. The
    measures leave through `inline`, because a later filter on them would else be pushed down to
    the scan with all arrays written out in it.
    """
    m = fresh(docs, "_quality")
    own = docs.columns
    w, h, s, p, ln = (f"{m}_{x}" for x in ("words", "hashes", "sorted", "places", "lines"))
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    trimmed = F.btrim(t, F.lit(SPACES))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )
    spaced = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    one = docs.withColumns({w: words, ln: spaced})
    two = one.withColumn(
        h,
        F.expr(
            f"transform(slice({w}, 1, greatest(size({w}) - 2, 0)),"
            f" (x, i) -> xxhash64(x, {w}[i + 1], {w}[i + 2]))"
        ),
    )
    three = two.withColumn(
        s,
        F.expr(
            f"if(size(array_distinct({h})) < size({h}),"
            f" sort_array(transform({h}, (x, i) -> struct(x AS h, i AS i))), NULL)"
        ),
    )
    same = f"(coalesce(get({s}, k - 1).h = x.h, false) OR coalesce(get({s}, k + 1).h = x.h, false))"
    four = three.withColumn(
        p, F.expr(f"sort_array(transform(filter({s}, (x, k) -> {same}), x -> x.i))")
    )
    # A repeated window covers its three words, less those the next one covers as well.
    covered = F.expr(
        f"coalesce(aggregate(transform({p}, (x, k) -> coalesce(least(3, get({p}, k + 1) - x), 3)),"
        f" 0L, (a, x) -> a + x), 0L)"
    )
    measures = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, SPACES, "")).cast("long").alias("word_chars"),
        _removed(t, SYMBOLS).alias("n_symbols"),
        (F.size(ln) - F.size(F.array_distinct(ln))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size(ln).cast("long").alias("n_lines"),
        F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]*\p{L}[^\x20\x09-\x0D]*"))
        .cast("long")
        .alias("n_letter_words"),
        F.size(F.array_intersect(w, F.array(*map(F.lit, STOP_WORDS)))).cast("long").alias("n_stop_words"),
        _removed(t, CAPITALS).alias("n_capitals"),
        _removed(t, "!").alias("n_exclamations"),
        F.size(F.filter(ln, lambda line: line.rlike(r"^[\x20\x09-\x0D]*[-*•]")))
        .cast("long")
        .alias("n_bullet_lines"),
        F.size(F.filter(ln, lambda line: line.rlike(r"(\.\.\.|…)[\x20\x09-\x0D]*$")))
        .cast("long")
        .alias("n_ellipsis_lines"),
    )
    return four.select(*[F.col(f"`{c}`") for c in own], F.inline(F.array(F.struct(measures.alias(m))))), m


def _base_failed() -> Column:
    return F.expr(
        f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"
    )


def quality_rules(docs: DataFrame, rules: Sequence[Bound] = RULES) -> DataFrame:
    """doc_id, measures, base_failed, kept and the names of the rules each row breaks.

    One row per input row, in any order: NULL and empty texts have no words and fail the base
    rule; repeated rows are judged alike; other columns are ignored; an empty table gives none.
    """
    measured, m = with_measures(docs.select("doc_id", "text"))
    flat = measured.select("doc_id", f"{m}.*").withColumn("base_failed", _base_failed())
    broken = F.array_compact(F.array(*[F.when(r.fails(), F.lit(r.rule)) for r in rules]))
    judged = flat.withColumn("broken_rules", broken if rules else F.array().cast("array<string>"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))


def keep_good(docs: DataFrame, rules: Sequence[Bound] = RULES) -> DataFrame:
    """The rows of `docs`, all columns, that `quality_rules` keeps."""
    measured, m = with_measures(docs)
    row = fresh(docs, "_document")
    rows = measured.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row), f"{m}.*")
    holds = ~_base_failed()
    for r in rules:
        holds = holds & ~r.fails()
    return rows.filter(holds).select(f"{row}.*")
