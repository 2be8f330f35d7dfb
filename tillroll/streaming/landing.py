"""Incremental load of landed product documents.

The daily product job as a file stream: each run takes the documents that arrived since
the last, stops, and never loads one twice, also when a run dies half way.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tillroll.operators.ingest import flatten_products
from tillroll.schemas import PRODUCT_PAYLOAD
from tillroll.sources.payload import quarantined, readable, tolerant_stream
from tillroll.sources.tables import shared_dir, stamp


@dataclass(frozen=True)
class Landed:
    """Products and unreadable documents that a run has added."""

    rows: int
    unreadable: int


def load_new_documents(
    spark: SparkSession,
    landing: str,
    target: str,
    at: datetime,
    source: str,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> int:
    """Append the products of new documents under ``landing`` to the Parquet folder ``target``.

    Returns the rows added.  The checkpoint records which files are done; unless given, it is a
    folder of this landing and target in the shared folder the session names.  A document that cannot be read stops the
    load; ``load_readable_documents`` puts it aside.
    """
    reader = spark.readStream.schema(PRODUCT_PAYLOAD).option("mode", "FAILFAST")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    products = stamp(flatten_products(reader.json(landing)), at, source)
    return _run(products, target, checkpoint or _checkpoint(spark, landing, target), at)


def load_readable_documents(
    spark: SparkSession,
    landing: str,
    target: str,
    at: datetime,
    source: str,
    checkpoint: str | None = None,
    files_per_batch: int | None = None,
) -> Landed:
    """The same, with documents that cannot be read appended to ``<target>_quarantine``: file, reason and text.

    Two streams of the same files, each with a checkpoint of its own, so every document ends in one of the two, once.
    """
    checkpoint = checkpoint or _checkpoint(spark, landing, target)
    documents = tolerant_stream(spark, landing, files_per_batch)
    bad = stamp(quarantined(documents), at, source)
    unreadable = _run(bad, f"{target}_quarantine", f"{checkpoint}-quarantine", at)
    products = stamp(flatten_products(readable(documents)), at, source)
    return Landed(_run(products, target, checkpoint, at), unreadable)


def _checkpoint(spark: SparkSession, landing: str, target: str) -> str:
    of = hashlib.sha256(f"{landing}\n{target}".encode()).hexdigest()
    return f"{shared_dir(spark)}/landing/{of}"


def _run(rows: DataFrame, target: str, checkpoint: str, at: datetime) -> int:
    """Take all that is new; the rows that the sink has committed for it, however many batches that took."""
    before = _committed(rows.sparkSession, target, at)
    stream = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
    stream.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return _committed(rows.sparkSession, target, at) - before


def _committed(spark: SparkSession, target: str, at: datetime) -> int:
    """Rows of this time's runs in the target; the sink's log names the files that count, and their statistics skip others."""
    try:
        stored = spark.read.schema("batch_id string").parquet(target)
    except AnalysisException:
        return 0  # nothing is written yet
    return stored.filter(stored["batch_id"] == at.isoformat(timespec="seconds")).count()
