"""Shared folders, row batches and digests of the corpus operators."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import shared_dir

#: Rows and text bytes a Python task holds at a time, unless one text alone is longer.
BATCH_ROWS = 1024
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors reach, as ``spark.checkpoint.dir`` names it.

    A local session without the setting gets a folder in its warehouse; on a cluster that is an error.
    """
    return shared_dir(spark)


def run_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends at files every node reaches."""
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def settled(df: DataFrame, kept: list[str], columns: dict[str, Column]) -> DataFrame:
    """The columns ``kept`` and new ones, evaluated once per row whatever is asked of them later.

    The optimizer moves filters below plain projections and evaluates their expressions there once more, inside each
    other where they build on each other.  It does not move them below a generator, which this is.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def crc32_of(key: str) -> Column:
    """CRC-32 of an id written as decimal text."""
    return F.crc32(F.col(key).cast("string"))


def least_hash(key: str) -> Column:
    """Aggregate: the least of the hashes that ``drawn_at`` compares."""
    return F.min(F.xxhash64(key))


def hash_bound(rate: float) -> int:
    """The bound below which a share ``rate`` of all 64-bit hashes lie."""
    return min((1 << 63) - 1, int(rate * 2**64) - (1 << 63))


def drawn_at(rate: float, least: int, key: str) -> Column:
    """Whether the hash of ``key`` draws a row: a share ``rate`` of all 64-bit hashes, and always the least one."""
    return F.xxhash64(key) <= F.lit(max(hash_bound(rate), least))


def small_batches(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of bounded rows and text bytes, so that memory does not follow Spark's batch size."""
    for batch in batches:
        lengths = np.diff(_ends(batch.column(text)))
        start, held = 0, 0
        for i, n in enumerate(lengths.tolist()):
            if i > start and (i - start >= BATCH_ROWS or held + n > BATCH_BYTES):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if batch.num_rows > start:
            yield batch.slice(start)


def _ends(column: pa.Array) -> np.ndarray:
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)])


def texts_of(batch: pa.RecordBatch, text: str) -> list[str]:
    """The batch's texts; null counts as empty."""
    return [t or "" for t in batch.column(text).to_pylist()]


def ids_crc32(ids: np.ndarray) -> int:
    """Unsigned CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(np.ascontiguousarray(ids, dtype="<u4"))


def record_batch(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    arrays = [
        values if isinstance(values := columns[f.name], pa.Array) else pa.array(values, type=f.type) for f in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
