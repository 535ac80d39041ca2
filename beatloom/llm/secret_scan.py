"""Secret scans: base patterns, and weak credential parts linked by an interval join within scopes.

One native pass over the texts keeps, per pattern, the lengths of the gaps and of the matches
(`split` beside `regexp_extract_all`); everything after it runs on those narrow numbers. Matches of
the distinct texts are exploded, a running sum per (text, pattern) turns lengths into positions,
and two range windows of `reach` code points, before and behind each part, are the interval join: they
see what lies in the scope without making pairs, so a text full of parts stays n log n.

Base kinds (always reported): assign, access, hex. Weak kinds, reported only with their complement,
which must not overlap them (a value is no proof of itself):

* ident: an identifier assigned (`login: x`, `access_key_id=...`), if a secret is in its scope;
* short: a secret assigned that the base rule drops for its length, and run: a mixed token of 20 or
  more characters, if an identifier or access id is in its scope;
* endpoint: a URL, if an identifier and a secret that do not overlap each other are in its scope.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beatloom.llm.shared import fresh, text_or_empty, written
from beatloom.llm.sieve import marked, sieve

REACH = 160

# Fixed values of the contract, letters of the words in either case.
ASSIGN_HEAD = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?"""
)
ASSIGN_VALUE = "[A-Za-z0-9+/_.=-]"
ASSIGN = f"{ASSIGN_HEAD}({ASSIGN_VALUE}+)"
ASSIGN_LEAST = 12
# Runs are maximal, so the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"

SHORT_LEAST = 4
IDENT = (
    r"(?i:user_?name|user|login|account|client_?id|access_?key(?:_?id)?|key_?id)"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
)
RUN = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"(?i:https?|s3|ftp|ssh|jdbc:[a-z]+)://[A-Za-z0-9.-]+(?::[0-9]+)?[A-Za-z0-9/._~%-]*"

KINDS = ("assign", "access", "hex", "ident", "short", "run", "endpoint")
BASE = KINDS[:3]
# What counts as either half of a credential.
IDENTIFIERS = ("ident", "access")
CREDENTIALS = ("assign", "hex", "short", "run")


@dataclass(frozen=True)
class Pattern:
    """A text is searched only if it holds one of `hints` (any text, if there are none); `value` is
    the group whose length and looks decide about a match."""

    name: str
    regex: str
    hints: tuple[str, ...] = ()
    value: int = 0


PATTERNS: tuple[Pattern, ...] = (
    Pattern("assign", ASSIGN, (":", "="), value=2),
    Pattern("access", ACCESS, ("AKIA",)),
    Pattern("hex", HEX),
    Pattern("ident", IDENT, (":", "=")),
    Pattern("run", RUN),
    Pattern("endpoint", ENDPOINT, ("://",)),
)
_MATCH = "array<struct<gap:int,len:int,value:int,mixed:boolean>>"


def _found(text: Column, p: Pattern) -> Column:
    """Matches of one pattern, each with the length of the gap before it."""
    whole = F.regexp_extract_all(text, F.lit(p.regex), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(p.regex), F.lit(p.value)) if p.value else whole
    worth = text.rlike(p.regex)
    if p.hints:
        worth = reduce(or_, [F.contains(text, F.lit(h)) for h in p.hints]) & worth
    rows = F.transform(
        F.arrays_zip(
            F.split(text, p.regex, -1).alias("g"), whole.alias("m"), value.alias("v")
        ),
        lambda x: F.struct(
            F.length(x["g"]).alias("gap"),
            F.length(x["m"]).alias("len"),
            F.length(x["v"]).alias("value"),
            (x["v"].rlike("[0-9]") & x["v"].rlike("[a-z]") & x["v"].rlike("[A-Z]")).alias("mixed"),
        ),
    )
    # The gap after the last match has no match beside it.
    return F.when(worth, F.filter(rows, lambda x: x["len"].isNotNull())).otherwise(
        F.array().cast(_MATCH)
    )


def scan_texts(
    docs: DataFrame, keep: Sequence[str] = ("doc_id",), patterns: Sequence[Pattern] = PATTERNS
) -> DataFrame:
    """`keep`, the text's SHA-256 and one array of matches per pattern; a written, narrow table."""
    t = fresh(docs, "_t")
    texts = docs.select(*keep, text_or_empty().alias(t))
    found = [_found(F.col(t), p).alias(p.name) for p in patterns]
    return written(texts.select(*keep, F.sha2(t, 256).alias("_sha"), *found), "secret-scan")


def _any_match(patterns: Sequence[Pattern] = PATTERNS) -> Column:
    sizes = [F.size(p.name) for p in patterns]
    return sum(sizes[1:], sizes[0]) > 0


def _ends(scanned: DataFrame, patterns: Sequence[Pattern] = PATTERNS) -> DataFrame:
    """(_sha, pattern, gap, len, value, mixed, end) of every match, per distinct text."""
    texts = (
        scanned.filter(_any_match(patterns))
        .groupBy("_sha")
        .agg(*[F.first(p.name).alias(p.name) for p in patterns])
    )
    matches = texts.select(
        "_sha",
        F.inline(F.array(*[
            F.struct(F.lit(p.name).alias("pattern"), F.col(p.name).alias("found")) for p in patterns
        ])),
    ).select("_sha", "pattern", F.posexplode("found").alias("_at", "_m"))
    along = Window.partitionBy("_sha", "pattern").orderBy("_at")
    return matches.select(
        "_sha", "pattern", "_m.*",
        F.sum(F.col("_m.gap") + F.col("_m.len")).over(along).alias("end"),
    )


def linked_spans(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """(_sha, kind, start, end) of every base span and every linked weak span, per distinct text."""
    base_value = F.col("value") >= ASSIGN_LEAST
    kind = (
        F.when(F.col("pattern") != "assign", F.col("pattern"))
        .when(base_value, "assign")
        .when(F.col("value") >= SHORT_LEAST, "short")
    )
    parts = (
        _ends(scanned).select("_sha", kind.alias("kind"), (F.col("end") - F.col("len")).alias("start"), "end", "mixed")
        .filter("kind IS NOT NULL AND (kind != 'run' OR mixed)")
    )
    # Interval join: each part is two points. From its end it looks ahead for parts that start at most
    # `reach` on, from its start back for parts that end at most `reach` before, so it never meets
    # itself or a part that overlaps it. Of what lies there the first end and the last start are kept:
    # some identifier is disjoint from some secret if one of them ends before the other's last start.
    points = parts.select("*", F.explode(F.array(
        F.struct(F.col("start").alias("at"), F.lit(True).alias("opens")),
        F.struct(F.col("end").alias("at"), F.lit(False).alias("opens")),
    )).alias("_p"))
    along = Window.partitionBy("_sha").orderBy("_p.at")
    ahead, back = along.rangeBetween(0, reach), along.rangeBetween(-reach, 0)
    opens = F.col("_p.opens")

    def reached(kinds: tuple[str, ...], edge: str) -> Column:
        extreme, value = (F.min if edge == "end" else F.max), F.when(F.col("kind").isin(*kinds), F.col(edge))
        before = extreme(F.when(~opens, value)).over(back)
        behind = extreme(F.when(opens, value)).over(ahead)
        return F.when(opens, before).otherwise(behind)

    sides = {"ident": IDENTIFIERS, "secret": CREDENTIALS}
    looks = points.withColumns({
        f"_{name}_{edge}": reached(kinds, edge) for name, kinds in sides.items() for edge in ("start", "end")
    })
    # Equal parts of one kind and place cannot be: matches of a kind do not overlap.
    seen = looks.groupBy("_sha", "kind", "start", "end").agg(
        *[F.max(f"_{name}_start").alias(f"_{name}_start") for name in sides],
        *[F.min(f"_{name}_end").alias(f"_{name}_end") for name in sides],
    )
    has_ident, has_secret = F.col("_ident_end").isNotNull(), F.col("_secret_end").isNotNull()
    apart = (F.col("_ident_end") <= F.col("_secret_start")) | (F.col("_secret_end") <= F.col("_ident_start"))
    linked = (
        F.col("kind").isin(*BASE)
        | ((F.col("kind") == "ident") & has_secret)
        | (F.col("kind").isin("short", "run") & has_ident)
        | ((F.col("kind") == "endpoint") & apart)
    )
    return seen.filter(linked).select("_sha", "kind", "start", "end")


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def span_lists(scanned: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per distinct text with spans: counts, base list and whole list."""
    order = F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))])
    entry = F.struct("start", order[F.col("kind")].alias("at"), "kind", "end")
    grouped = linked_spans(scanned, reach).groupBy("_sha").agg(
        F.sort_array(F.collect_list(entry)).alias("_all"),
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
    )
    base = F.filter("_all", lambda s: s["at"] < len(BASE))
    return grouped.select(
        "_sha", *[f"n_{k}" for k in BASE], _listed(base).alias("_base"), _listed(F.col("_all")).alias("spans")
    )


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans, one row per input row.

    NULL and empty texts have no spans (base_sha256 of the empty string); repeated rows and copies
    get equal rows; other columns are ignored; an empty table gives none. Equal starts are listed
    in the order of KINDS.
    """
    scanned = scan_texts(docs)
    plain = scanned.filter(~_any_match()).select("doc_id")
    hit = scanned.filter(_any_match()).select("doc_id", "_sha").join(span_lists(scanned, reach), "_sha", "left")
    zero = [F.lit(0).cast("long").alias(f"n_{k}") for k in BASE]
    none = plain.select("doc_id", *zero, F.lit("").alias("_base"), F.lit("").alias("spans"))
    some = hit.select(
        "doc_id",
        *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE],
        F.coalesce("_base", F.lit("")).alias("_base"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
    return none.unionByName(some).select(
        "doc_id", *[f"n_{k}" for k in BASE], F.sha2("_base", 256).alias("base_sha256"), "spans"
    )


MASK = "[SECRET]"
# An assignment long enough by itself, also where a shorter match of ASSIGN takes its head.
LONG_ASSIGN = Pattern("long", f"{ASSIGN_HEAD}({ASSIGN_VALUE}{{{ASSIGN_LEAST},}})", (":", "="), value=2)


def _cuts(scanned: DataFrame, reach: int) -> DataFrame:
    """(_sha, _cuts): the stretches to mask of each distinct text, in order and without overlaps.

    Of base assignments only the value is masked, of other secrets the whole match.
    """
    linked = linked_spans(scanned, reach).filter("kind NOT IN ('assign', 'endpoint')")
    value = _ends(scanned, [PATTERNS[0], LONG_ASSIGN]).filter(F.col("value") >= ASSIGN_LEAST)
    spans = linked.select("_sha", "start", "end").unionByName(
        value.select("_sha", (F.col("end") - F.col("value")).alias("start"), "end")
    )
    along = Window.partitionBy("_sha").orderBy("start", "end")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start") >= F.max("end").over(before), F.lit(True))
    merged = (
        spans.withColumn("_opens", opens.cast("int"))
        .withColumn("_cut", F.sum("_opens").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_sha", "_cut")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
    )
    return merged.groupBy("_sha").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_cuts"))


def mask_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """All rows and columns of `docs`; the values of base and linked weak spans become MASK.

    Overlapping spans are merged and each text is cut once, by positions, so nothing of a span is
    left and nothing outside of spans changes. URLs stay, but for the secrets in them. n_chars, where
    there is one, follows the new text. Texts are joined with their cuts by SHA-256; those that miss the
    filter of the cuts' digests pass where they are read.
    """
    scanned = scan_texts(docs, keep=(), patterns=(*PATTERNS, LONG_ASSIGN))
    cuts = written(_cuts(scanned, reach), "secret-cuts")
    sha, cut = fresh(docs, "_sha"), fresh(docs, "_cuts")
    hit, own = fresh(docs, "_hit"), F.col("text")
    digested = docs.withColumn(sha, F.sha2(text_or_empty(), 256))
    found = marked(digested, sieve(cuts, "_sha"), (sha,), hit)
    joined = found.filter(F.col(hit)).join(cuts.toDF(sha, cut), sha, "left")

    def before(c: Column, i: Column) -> Column:
        last = F.coalesce(F.get(F.col(cut), i - 1)["end"], F.lit(0))
        return F.substring(own, (last + 1).cast("int"), (c["start"] - last).cast("int"))

    tail = F.substring(own, (F.element_at(cut, -1)["end"] + 1).cast("int"), F.length(own))
    pieces = F.concat(F.transform(cut, before), F.array(tail))
    masked = joined.withColumn("text", F.when(F.col(cut).isNull(), own).otherwise(F.array_join(pieces, MASK)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = found.filter(~F.col(hit)).select(*columns).unionByName(masked.select(*columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
