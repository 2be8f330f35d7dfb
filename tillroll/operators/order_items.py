"""Order lines enriched with their product and order."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import NO_MONEY, flag, ladder, percent, quotient
from tillroll.functions.dates import month_start, week_start
from tillroll.operators.joins import Hot, join
from tillroll.rules import PRICE_TIER, QUANTITY_CATEGORY

PRODUCT_KEY = "source_product_id"
ORDER_KEY = "source_order_id"


def with_products(items: DataFrame, products: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Every line beside its product; a product listed twice repeats the line."""
    facts = products.select(
        PRODUCT_KEY,
        "product_name",
        "brand",
        "category",
        F.col("price").alias("current_product_price"),
        "minimum_order_quantity",
    )
    return join(items, [facts], PRODUCT_KEY, hot, ["source_order_item_id"])


def with_orders(items: DataFrame, orders: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Every line beside its order.  The columns taken need none of the order aggregates."""
    facts = orders.select(
        ORDER_KEY,
        "source_customer_id",
        "order_date",
        "order_status",
        "order_status_category",
        F.col("total_amount").alias("order_total_amount"),
    )
    return join(items, [facts], ORDER_KEY, hot, ["source_order_item_id"])


def order_items(
    staged_items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    hot_products: Hot | None = None,
    hot_orders: Hot | None = None,
) -> DataFrame:
    joined = with_orders(with_products(staged_items.drop("id"), products, hot_products), orders, hot_orders)
    unit, quantity, total = F.col("unit_price"), F.col("quantity"), F.col("total_price")
    listed, when = F.col("current_product_price"), F.col("order_date")
    return joined.withColumns(
        {
            "calculated_unit_price": quotient(total, quantity),
            "discount_vs_current_price": listed - unit,
            "discount_percentage_vs_current": F.when(listed > unit, percent(listed - unit, listed)).otherwise(NO_MONEY),
            "was_discounted": flag(unit < listed),
            "item_revenue": total,
            # Against the stated order total, so the shares of an order need not add up to 100.
            "percent_of_order_total": percent(total, F.col("order_total_amount")),
            "quantity_category": ladder(quantity, QUANTITY_CATEGORY),
            "price_tier": ladder(unit, PRICE_TIER),
            "exceeds_minimum_order": flag(quantity > F.col("minimum_order_quantity")),
            "order_month": month_start(when),
            "order_week": week_start(when),
        }
    ).drop("minimum_order_quantity")
