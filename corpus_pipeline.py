"""The corpus pipeline: five stages over documents, each written as Parquet and read again before the next.

Documents whose language is not known go, and with them null and empty texts and texts without a letter; then those that
fail the quality rules, among them all of fewer than 50 words.  Of rows that repeat an id, and of texts that are near
copies, one stays, that of the least id; rows without an id stay.  Secrets are masked in what is left, and its tokens are
packed.  Texts may be of any length; other columns are carried to the last stage but one, whatever their names; an empty
table makes empty stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tillroll.llm import language, neardup, packing, quality, secrets
from tillroll.llm.common import documents, saved

#: Trained models and tokenizers are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and not ambiguous."""
    return language.keep_known(docs, language.train(docs, language.learned_rows()))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with five-word shingle sets alike by 0.8 or more."""
    return neardup.drop_near_duplicates(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    return secrets.redact(docs, secrets.train(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens, mixed as the sources are."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end=0)


STAGES = [
    ("language_id", known_languages),
    ("quality_rules", good_quality),
    ("near_duplicates", one_of_near_duplicates),
    ("secret_scan", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
