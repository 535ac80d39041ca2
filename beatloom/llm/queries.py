"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beatloom.llm import (
    alignment,
    boosted_quality,
    exact_dedup,
    html_text,
    jaccard_join,
    packing,
    periodic,
    pfor,
    quality_rules,
    repeats,
    secret_scan,
    sentencepiece_backend,
    token_counts,
)

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(_table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_backend.sentencepiece_tokens(_table(spark, sf_dir, "documents"))


def op3_packed_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pfor.packed_tokens(_table(spark, sf_dir, "documents"))


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_quality.quality_scores(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    )


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(_table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_spans(_table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(_table(spark, sf_dir, "documents"), tails=True)


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.aligned_tokens(_table(spark, sf_dir, "documents"))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": op1_html_extraction,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_packed_token_ids": op3_packed_token_ids,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_token_counts": op7_token_counts,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_secret_scan": op10_secret_scan,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_tokenizer_alignment": op12_tokenizer_alignment,
    "op13_suffix_dedup": op13_suffix_dedup,
}
ORACLES: dict[str, str] = {}

# --- SQL ------------------------------------------------------------------------------------

_STOP = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES["op6_quality_rules"] = rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, regexp_extract_all(t, '{_WORD}') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS ln FROM texts),
windows AS (
  SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
repeated AS (
  SELECT rid, i FROM windows
  QUALIFY count(*) OVER (PARTITION BY rid, a, b, c) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n
  FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid),
measured AS (
  SELECT doc_id, len(w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(ln) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) AS n_letter_words,
    len(list_filter(list_distinct(w), lambda x: x IN ({_STOP}))) AS n_stop_words,
    length(regexp_replace(t, '[^{quality_rules.CAPITALS}]', '', 'g')) AS n_capitals,
    length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclamations,
    len(list_filter(ln, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]'))) AS n_bullet_lines,
    len(list_filter(ln, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines
  FROM words LEFT JOIN covered USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed
  AND word_chars / greatest(n_words, 1) BETWEEN 3 AND 10
  AND n_symbols / greatest(n_words, 1) <= 0.1 AND n_letter_words / greatest(n_words, 1) >= 0.8
  AND n_stop_words >= 2 AND n_capitals / greatest(word_chars, 1) <= 0.4
  AND n_exclamations / greatest(n_words, 1) <= 0.5 AND n_dup_lines / greatest(n_lines, 1) <= 0.4
  AND n_bullet_lines / greatest(n_lines, 1) <= 0.9
  AND n_ellipsis_lines / greatest(n_lines, 1) <= 0.3 AS kept
FROM judged"""

ORACLES["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""


def _spans_sql() -> str:
    """Matches of every pattern with their positions, from gaps and matches in turn."""
    parts = []
    for p in secret_scan.PATTERNS:
        regex = p.regex.replace("'", "''")
        parts.append(f"""
  SELECT rid, '{p.name}' AS pattern, string_split_regex(t, '{regex}') AS g,
    regexp_extract_all(t, '{regex}', 0) AS m, regexp_extract_all(t, '{regex}', {p.value}) AS v FROM texts""")
    return " UNION ALL".join(parts)


_ORDER = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(secret_scan.KINDS))
_IDENTIFIERS, _CREDENTIALS = (", ".join(f"'{k}'" for k in ks) for ks in (secret_scan.IDENTIFIERS, secret_scan.CREDENTIALS))

ORACLES["op10_secret_scan"] = rf"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS t FROM documents),
found AS ({_spans_sql()}),
matches AS (
  SELECT rid, pattern, k, length(g[k]) AS gap, length(m[k]) AS n, length(v[k]) AS value,
    regexp_matches(v[k], '[0-9]') AND regexp_matches(v[k], '[a-z]') AND regexp_matches(v[k], '[A-Z]') AS mixed
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS k FROM found)),
placed AS (
  SELECT *, sum(gap + n) OVER (PARTITION BY rid, pattern ORDER BY k) AS e FROM matches),
parts AS (
  SELECT row_number() OVER () AS id, rid, (e - n)::BIGINT AS s, e::BIGINT AS e,
    CASE WHEN pattern <> 'assign' THEN pattern WHEN value >= {secret_scan.ASSIGN_LEAST} THEN 'assign'
      WHEN value >= {secret_scan.SHORT_LEAST} THEN 'short' END AS kind
  FROM placed WHERE pattern <> 'run' OR mixed),
near AS (
  SELECT p.id, p.kind, q.s, q.e, q.kind IN ({_IDENTIFIERS}) AS is_ident, q.kind IN ({_CREDENTIALS}) AS is_secret
  FROM parts p JOIN parts q ON p.rid = q.rid
    AND (q.s - p.e BETWEEN 0 AND {secret_scan.REACH} OR p.s - q.e BETWEEN 0 AND {secret_scan.REACH})),
linked AS (
  SELECT id FROM near WHERE (kind = 'ident' AND is_secret) OR (kind IN ('short', 'run') AND is_ident)
  UNION
  SELECT a.id FROM near a JOIN near b ON a.id = b.id AND a.kind = 'endpoint' AND a.is_ident AND b.is_secret
    AND (a.e <= b.s OR b.e <= a.s)),
spans AS (
  SELECT rid, s, kind, kind || ':' || s || ':' || e AS span, CASE kind {_ORDER} END AS kind_at FROM parts
  WHERE kind IN ('assign', 'access', 'hex') OR id IN (SELECT id FROM linked)),
lists AS (
  SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(span, ',' ORDER BY s, kind_at) FILTER (kind_at < 3) AS base, string_agg(span, ',' ORDER BY s, kind_at) AS spans
  FROM spans GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM texts LEFT JOIN lists USING (rid)"""
