"""Staging: rename and type the raw tables.  Rows in equal rows out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import MONEY
from tillroll.rules import NO_RETURN_MARK, NON_DIGITS
from tillroll.schemas import RAW

RENAMES = {
    "raw_products": {
        "stock": "stock_quantity",
        "minimum_order_qty": "minimum_order_quantity",
        "thumbnail": "thumbnail_url",
    },
    "raw_transactions": {"amount": "transaction_amount", "processor_name": "payment_processor"},
}

DECIMALS = {
    "raw_products": {
        "price": MONEY,
        "discount_percentage": MONEY,
        "rating": "decimal(3,2)",
        "weight": MONEY,
        "width": MONEY,
        "height": MONEY,
        "depth": MONEY,
    },
    "raw_orders": {"total_amount": MONEY},
    "raw_order_items": {"unit_price": MONEY, "total_price": MONEY},
    "raw_transactions": {"amount": MONEY},
}


def _typed(raw: DataFrame, name: str) -> DataFrame:
    """The contract columns of ``name``, cast and renamed; anything else is dropped."""
    renames = {**RENAMES.get(name, {}), "source": "source_system"}
    decimals = DECIMALS.get(name, {})
    picked = []
    for column in RAW[name].names:
        value = f"cast({column} as {decimals[column]})" if column in decimals else column
        picked.append(f"{value} as {renames.get(column, column)}")
    return raw.selectExpr(*picked)


def customers(raw: DataFrame) -> DataFrame:
    # concat, not concat_ws: a missing part makes the whole name missing.
    return _typed(raw, "raw_customers").withColumn("full_name", F.concat("first_name", F.lit(" "), "last_name"))


def return_days(policy):
    """Days in a return policy text; 0 for no returns, NULL where the text has no digit."""
    digits = F.regexp_replace(policy, NON_DIGITS, "").try_cast("int")
    return F.when(F.upper(policy).contains(NO_RETURN_MARK), F.lit(0)).otherwise(digits)


def products(raw: DataFrame) -> DataFrame:
    return _typed(raw, "raw_products").withColumn("return_policy_days_clean", return_days(F.col("return_policy")))


def orders(raw: DataFrame) -> DataFrame:
    return _typed(raw, "raw_orders")


def order_items(raw: DataFrame) -> DataFrame:
    return _typed(raw, "raw_order_items")


def transactions(raw: DataFrame) -> DataFrame:
    return _typed(raw, "raw_transactions")


STAGES = {
    "stg_products": ("raw_products", products),
    "stg_customers": ("raw_customers", customers),
    "stg_orders": ("raw_orders", orders),
    "stg_order_items": ("raw_order_items", order_items),
    "stg_transactions": ("raw_transactions", transactions),
}
