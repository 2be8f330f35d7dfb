"""Payment transactions enriched with their order, with direction and timing."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import first_match, flag, grouped, ladder
from tillroll.functions.dates import boundary_diff, day_of_week, month_start, week_start
from tillroll.operators.joins import Hot, join
from tillroll.rules import (
    AMOUNT_SIZE,
    APPROVED,
    FAILED_STATUSES,
    PAYMENT,
    REFUND,
    TIMING,
    TIMING_OTHERWISE,
    TRANSACTION_STATUS_CATEGORY,
)

KEY = "source_order_id"


def with_orders(transactions: DataFrame, orders: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Every transaction beside its order, NULL where the order is unknown."""
    facts = orders.select(
        KEY,
        "source_customer_id",
        "order_date",
        "order_status",
        F.col("total_amount").alias("order_total_amount"),
    )
    return join(transactions, [facts], KEY, hot, ["source_transaction_id"])


def transactions(staged: DataFrame, orders: DataFrame, hot: Hot | None = None) -> DataFrame:
    joined = with_orders(staged.drop("id"), orders, hot)
    status, kind, amount = F.col("transaction_status"), F.col("transaction_type"), F.col("transaction_amount")
    when = F.col("transaction_date")
    lag = {unit: f"{unit}s_from_order_to_transaction" for unit in ("minute", "hour", "day")}
    return (
        joined.withColumns({name: boundary_diff(u, F.col("order_date"), when) for u, name in lag.items()})
        .withColumns(
            {
                "transaction_status_category": grouped(status, TRANSACTION_STATUS_CATEGORY),
                "is_successful": flag(status == APPROVED),
                "is_failed": flag(status.isin(*FAILED_STATUSES)),
                "is_payment": flag(kind == PAYMENT),
                "is_refund": flag(kind == REFUND),
                "signed_amount": F.when(kind == REFUND, -F.abs(amount)).otherwise(amount),
                "transaction_timing": first_match(
                    [(F.col(lag[unit]) <= most, label) for unit, most, label in TIMING], TIMING_OTHERWISE
                ),
                "transaction_month": month_start(when),
                "transaction_week": week_start(when),
                "day_of_week": day_of_week(when),
                "hour_of_day": F.hour(when),
                "transaction_size": ladder(amount, AMOUNT_SIZE),
            }
        )
    )
