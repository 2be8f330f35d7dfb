"""Per-order aggregates.  Both combine on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import NO_MONEY, money_sum, quotient
from tillroll.rules import PAYMENT, REFUND, STATUS_COUNTS

ITEM_COUNTS = ("item_count", "total_items_quantity")
ITEM_AMOUNTS = ("avg_item_price", "max_item_price", "min_item_price")


def item_totals(items: DataFrame) -> DataFrame:
    """One row per order: line count, units, value and unit-price statistics."""
    price = F.col("unit_price")
    return items.groupBy("source_order_id").agg(
        F.count("*").alias("item_count"),
        F.sum("quantity").alias("total_items_quantity"),
        money_sum(F.col("total_price")).alias("calculated_order_total"),
        quotient(money_sum(price), F.count(price)).alias("avg_item_price"),
        F.max(price).alias("max_item_price"),
        F.min(price).alias("min_item_price"),
    )


TRANSACTION_COUNTS = (
    "transaction_count",
    "payment_count",
    "refund_count",
    *(f"{status}_transaction_count" for status in STATUS_COUNTS),
)
TRANSACTION_AMOUNTS = ("total_payments", "total_refunds", "net_transaction_amount")


def transaction_totals(transactions: DataFrame) -> DataFrame:
    """One row per order: sums by type whatever the status, and counts by type and status."""
    amount, kind, status = F.col("transaction_amount"), F.col("transaction_type"), F.col("transaction_status")
    paid, refunded = kind == PAYMENT, kind == REFUND
    # A refund is negated as stored, so a refund stored below zero adds to the net.
    return transactions.groupBy("source_order_id").agg(
        F.count("*").alias("transaction_count"),
        money_sum(F.when(paid, amount).otherwise(NO_MONEY)).alias("total_payments"),
        money_sum(F.when(refunded, amount).otherwise(NO_MONEY)).alias("total_refunds"),
        money_sum(F.when(paid, amount).when(refunded, -amount).otherwise(NO_MONEY)).alias("net_transaction_amount"),
        F.count_if(paid).alias("payment_count"),
        F.count_if(refunded).alias("refund_count"),
        *[F.count_if(status == s).alias(f"{s}_transaction_count") for s in STATUS_COUNTS],
    )
