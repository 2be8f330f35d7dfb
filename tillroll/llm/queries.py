"""The corpus queries by name, with their DuckDB statements where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import (
    bpe,
    contamination,
    conversations,
    language,
    neardup,
    negatives,
    packing,
    quality,
    secrets,
    statements as added,
    syncmers,
    token_counts,
    token_files,
    toxicity,
)
from tillroll.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def _path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = _path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(documents(spark, sf_dir), path, public_tokenizers.PATTERN)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), _path("byte_bpe_50k.json"), end=0)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read(token_files.write(documents(spark, sf_dir), _path("word_bpe_49k.json"), end=2))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), _path("word_bpe_49k.json"), limit=2048)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages_of(documents(spark, sf_dir))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return secrets.scan(docs, secrets.train(docs))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), k=3, threshold=85)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_of(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_conversations(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination.contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def all_queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_quality_rules,
            op2_byte_bpe,
            op3_packing,
            op4_token_files,
            op5_token_counts,
            op6_language,
            op7_secret_scan,
            op8_near_duplicates,
            op9_toxicity,
            op10_fingerprints,
            op11_conversation_repair,
            op12_hard_negatives,
            op13_decontamination,
        )
    }


def _op1_statement() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted({w for words in quality.STOP_WORDS.values() for w in words.split()}))
    listed = ", ".join(f"'{name}'" for name in sorted(quality.STOP_WORDS))
    tests = []
    for rule in quality.RULES:
        limits = [f"{rule.metric} < {rule.least}"] * (rule.least is not None) + [f"{rule.metric} > {rule.most}"] * (
            rule.most is not None
        )
        held = "stop_words_known AND " if rule.metric == "stop_word_ratio" else ""
        tests.append(f"CASE WHEN {held}({' OR '.join(limits)}) THEN '{rule.metric}' END")
    ratios = {
        "mean_word_length": "word_chars / n_words",
        "symbol_ratio": "n_symbols / n_words",
        "shouted_ratio": "n_upper / word_chars",
        "stop_word_ratio": "n_stops / n_words",
        "dup_line_ratio": "n_dup_lines / n_lines",
        "bullet_line_ratio": "n_bullets / n_lines",
        "ellipsis_line_ratio": "n_ellipses / n_lines",
    }
    divided = ", ".join(
        f"CASE WHEN {whole} = 0 THEN 0.0 ELSE CAST({part} AS DOUBLE) / {whole} END AS {name}"
        for name, (part, whole) in ((n, r.split(" / ")) for n, r in ratios.items())
    )
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r,
    lower(regexp_extract(coalesce(lang, ''), '^[A-Za-z]*')) AS named
  FROM documents
), s AS (
  SELECT *,
    CASE WHEN named NOT IN ('', 'und') THEN named IN ({listed})
      ELSE 2 * length(regexp_replace(text, '[^\p{{Latin}}]+', '', 'g')) >= length(regexp_replace(text, '[^\p{{L}}]+', '', 'g'))
    END AS stop_words_known, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), windows AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM s)
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS times FROM windows), range(0, 3) AS t(k)
  WHERE times > 1 GROUP BY r
), counted AS (
  SELECT doc_id, stop_words_known, len(words) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^{quality.SYMBOLS}]+', '', 'g')) AS BIGINT) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g')) AS n_upper,
    len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS n_stops,
    len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣·]'))) AS n_bullets,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipses
  FROM s LEFT JOIN covered USING (r)
), ratios AS (
  SELECT *, {divided},
    n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED} * n_words AS base_failed
  FROM counted
), judged AS (
  SELECT *, list_filter([{", ".join(tests)}], lambda x: x IS NOT NULL) AS fails FROM ratios
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND len(fails) = 0 AS kept, array_to_string(fails, ' ') AS failed, {", ".join(ratios)}
FROM judged"""


def statements() -> dict[str, str]:
    return {"op1_quality_rules": _op1_statement()} | added.statements()
