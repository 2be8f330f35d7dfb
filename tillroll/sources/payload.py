"""Landed product documents (JSON)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.schemas import PRODUCT_PAYLOAD

#: Column of the text that could not be read as a document.
UNREADABLE = "unreadable"
_TOLERANT = f"{PRODUCT_PAYLOAD}, {UNREADABLE} string"


class UnreadableDocuments(ValueError):
    """More landed documents cannot be read than a load allows."""


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents under ``path``, one per line, or one per file with ``multi_line``.

    Files of one document per line are split between tasks; a multi-line file is read by
    one task, which suits single responses only.
    """
    return spark.read.schema(PRODUCT_PAYLOAD).json(path, multiLine=multi_line, mode="FAILFAST")


def parse_documents(texts: DataFrame, column: str = "value") -> DataFrame:
    """Documents held as text in a column."""
    options = {"mode": "FAILFAST"}
    return texts.select(F.from_json(column, PRODUCT_PAYLOAD, options).alias("d")).select("d.products")


def tolerant_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Documents under ``path`` as (products, unreadable, file); where ``unreadable`` holds text, the products are not to be used."""
    return _parsed(spark.read.text(path, wholetext=multi_line))


def tolerant_stream(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream of the files that arrive under ``landing``."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _parsed(reader.text(landing))


def _parsed(texts: DataFrame) -> DataFrame:
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    parsed = F.from_json("value", _TOLERANT, options).alias("d")
    rows = texts.filter(F.trim("value") != "").select(parsed, "value", F.col("_metadata.file_path").alias("file"))
    # Text that is no JSON object at all gives no row of fields.
    unreadable = F.when(F.col("d").isNull(), F.col("value")).otherwise(F.col(f"d.{UNREADABLE}"))
    return rows.select("d.products", unreadable.alias(UNREADABLE), "file")


def readable(documents: DataFrame) -> DataFrame:
    """Documents that could be read."""
    return documents.filter(F.col(UNREADABLE).isNull()).select("products")


def quarantined(documents: DataFrame) -> DataFrame:
    """(file, reason, document) of those that could not: not JSON, or JSON with values of other types than declared."""
    well_formed = F.try_parse_json(UNREADABLE).isNotNull()
    reason = F.when(well_formed, "other types than declared").otherwise("not JSON")
    return documents.filter(F.col(UNREADABLE).isNotNull()).select(
        "file", reason.alias("reason"), F.col(UNREADABLE).alias("document")
    )
