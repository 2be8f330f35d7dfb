"""Order facts: items and payments summed per order, then status, size and time columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import first_match, flag, grouped, ladder, or_no_money, or_zero
from tillroll.functions.dates import boundary_diff, day_of_week, midnight, month_start, week_start
from tillroll.operators.aggregates import (
    ITEM_AMOUNTS,
    ITEM_COUNTS,
    TRANSACTION_AMOUNTS,
    TRANSACTION_COUNTS,
    item_totals,
    transaction_totals,
)
from tillroll.operators.joins import Hot, join
from tillroll.rules import (
    AMOUNT_SIZE,
    DISCREPANCY_TOLERANCE,
    FULFILLED,
    NO_PAYMENT,
    ORDER_COMPLEXITY,
    ORDER_STATUS_CATEGORY,
    PAID,
    PAYMENT_FAILED,
    PAYMENT_PENDING,
    TERMINATED,
    WEEKDAY,
    WEEKEND,
    WEEKEND_DAYS,
)

KEY = "source_order_id"


def with_items(staged_orders: DataFrame, staged_items: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Every order beside the totals of its items, NULL where it has none."""
    return join(staged_orders, [item_totals(staged_items)], KEY, hot, ["source_customer_id", "order_date"])


def with_transactions(orders: DataFrame, staged_transactions: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Every order beside the totals of its payments, NULL where it has none."""
    return join(
        orders, [transaction_totals(staged_transactions)], KEY, hot, ["source_customer_id", "order_date"]
    )


def orders(
    staged_orders: DataFrame,
    staged_items: DataFrame,
    staged_transactions: DataFrame,
    as_of: date,
    hot: Hot | None = None,
) -> DataFrame:
    """One row per staged order.

    Both aggregates come out partitioned by the join key, so three shuffles serve the
    two groupings and the two joins.
    """
    joined = join(
        staged_orders.drop("id"),
        [item_totals(staged_items), transaction_totals(staged_transactions)],
        KEY,
        hot,
        ["source_customer_id", "order_date"],
    )
    status, total, when = F.col("order_status"), F.col("total_amount"), F.col("order_date")
    failed = (F.col("failed_transaction_count") > 0) | (F.col("declined_transaction_count") > 0)
    waiting = (F.col("pending_transaction_count") > 0) | (F.col("processing_transaction_count") > 0)
    return (
        # calculated_order_total alone keeps its NULL.
        joined.withColumns(
            {c: or_zero(F.col(c)) for c in (*ITEM_COUNTS, *TRANSACTION_COUNTS)}
            | {c: or_no_money(F.col(c)) for c in (*ITEM_AMOUNTS, *TRANSACTION_AMOUNTS)}
        )
        .withColumns(
            {
                "order_status_category": grouped(status, ORDER_STATUS_CATEGORY),
                "is_fulfilled": flag(status.isin(*FULFILLED)),
                "is_terminated": flag(status.isin(*TERMINATED)),
                "amount_variance": F.abs(total - or_no_money(F.col("calculated_order_total"))),
                "order_size": ladder(total, AMOUNT_SIZE),
                "order_complexity": ladder(F.col("item_count"), ORDER_COMPLEXITY),
                "has_multiple_transactions": F.col("transaction_count") > 1,
                "has_refunds": F.col("refund_count") > 0,
                "has_failed_transactions": failed,
                "payment_status": first_match(
                    [
                        (F.col("approved_transaction_count") > 0, PAID),
                        (waiting, PAYMENT_PENDING),
                        (failed, PAYMENT_FAILED),
                    ],
                    NO_PAYMENT,
                ),
                "days_since_order": boundary_diff("day", when, F.lit(as_of)),
                "hours_since_order": boundary_diff("hour", when, midnight(as_of)),
                "order_month": month_start(when),
                "order_week": week_start(when),
                "day_of_week": day_of_week(when),
                "hour_of_day": F.hour(when),
            }
        )
        .withColumns(
            {
                "has_amount_discrepancy": flag(F.col("amount_variance") > DISCREPANCY_TOLERANCE),
                "weekday_weekend": F.when(F.col("day_of_week").isin(*WEEKEND_DAYS), WEEKEND).otherwise(WEEKDAY),
            }
        )
    )
