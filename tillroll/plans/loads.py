"""Batch loads of the source tables, with metrics of what was written."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators.batch import EmptyBatch
from tillroll.operators.ingest import flatten_products, packed_transactions, priced_lines, priced_parts, with_segment
from tillroll.operators.joins import Hot, hot_keys
from tillroll.sources.batches import publish, published
from tillroll.sources.payload import (
    UNREADABLE,
    UnreadableDocuments,
    quarantined,
    read_documents,
    readable,
    tolerant_documents,
)
from tillroll.sources.tables import shared_dir, snapshot, stamp


def load_batch(
    df: DataFrame,
    table: str,
    at: datetime,
    source: str,
    snapshot_base: str | None = None,
    revenue: str | None = None,
    allow_empty: bool = True,
    beside: Mapping[str, DataFrame] | None = None,
) -> dict:
    """Stamp a batch and publish it in ``table``; rows, revenue and run time of the batch.

    ``beside`` are frames of further tables, seen with this one or not at all.  A load that is run again after it
    failed gives the rows of one load; a batch that is published already, of this source and time, is left as it is,
    and its metrics are returned.

    With ``snapshot_base`` the batch is first written there as a timestamped folder, and
    the table is loaded from that copy, so the batch is computed once.
    """
    spark = df.sparkSession
    stamped = stamp(df, at, source)
    batch_id = at.isoformat(timespec="seconds")
    done = published(spark, table, batch_id, source)
    if done is None:
        if not allow_empty and stamped.isEmpty():
            raise EmptyBatch(f"no rows for {table}; nothing was written")
        if snapshot_base:
            name = table.rsplit(".", 1)[-1]
            stamped = spark.read.parquet(snapshot(stamped, snapshot_base, name, at, again=True))
        others = {name: stamp(other, at, source) for name, other in (beside or {}).items()}
        done = publish({**others, table: stamped}, batch_id, source, {table: revenue} if revenue else None)[table]
    metrics = {"run_at": at.isoformat(), "rows": done.rows}
    return metrics | {"revenue": done.revenue} if revenue else metrics


def load_products(
    spark: SparkSession,
    landing: str,
    table: str,
    at: datetime,
    source: str = "landing",
    snapshot_base: str | None = None,
    multi_line: bool = False,
    most_unreadable: float | None = None,
) -> dict:
    """Products of the landed documents; a landing without products is an error.

    A document that cannot be read is an error, too, unless ``most_unreadable`` is given: then at most that share of the
    documents may be unreadable, which are published beside the products in ``<table>_quarantine`` with their file and the
    reason, and counted in the metrics.  With more of them nothing is loaded.
    """
    if most_unreadable is None:
        products = flatten_products(read_documents(spark, landing, multi_line))
        return load_batch(products, table, at, source, snapshot_base, allow_empty=False)
    documents = tolerant_documents(spark, landing, multi_line)
    every, bad = documents.agg(F.count("*"), F.count(UNREADABLE)).first()
    if bad > most_unreadable * every:
        raise UnreadableDocuments(f"{bad} of {every} documents under {landing} cannot be read; nothing was written")
    beside = {f"{table}_quarantine": quarantined(documents)}
    products = flatten_products(readable(documents))
    return load_batch(products, table, at, source, snapshot_base, allow_empty=False, beside=beside) | {"unreadable": bad}


def load_customers(
    customers: DataFrame, table: str, at: datetime, source: str, snapshot_base: str | None = None
) -> dict:
    """Customers with the segment their registration gives them at load time."""
    return load_batch(with_segment(customers, at), table, at, source, snapshot_base)


def load_transactions(
    headers: DataFrame,
    lines: DataFrame,
    products: DataFrame,
    table: str,
    at: datetime,
    source: str,
    snapshot_base: str | None = None,
) -> dict:
    """Orders priced from their lines; hot products and orders are spread over tasks.

    The lines of orders too large for one text go to ``<table>_parts``, which is published with the orders.  Lines are
    priced and packed once, into a written copy that both tables are built from.
    """
    hot_products, hot_orders = hot_keys(lines, "product_id", "order_id")
    packed = packed_copy(priced_lines(lines, products, hot_products), hot_orders)
    orders = packed_transactions(headers, packed, *hot_keys(headers, "order_id"))
    large = packed.filter("parts > 1").select("order_id", "part", "parts", "items_detail")
    parts = {f"{table}_parts": large}
    return load_batch(orders, table, at, source, snapshot_base, revenue="total_amount", beside=parts)


def packed_copy(priced: DataFrame, hot_orders: Hot) -> DataFrame:
    """The packed lines, written to the folder that all executors share and read again."""
    path = f"{shared_dir(priced.sparkSession)}/packed/{uuid4().hex}"
    packed = priced_parts(priced, hot=hot_orders)
    packed.write.parquet(path)
    return priced.sparkSession.read.schema(packed.schema).parquet(path)
