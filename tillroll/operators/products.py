"""Product dimension: prices after discount, and rating, stock and price bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import flag, ladder, share_of
from tillroll.rules import DISCOUNT_CATEGORY, IN_STOCK, PRICE_TIER, RATING_CATEGORY, STOCK_LEVEL


def products(staged: DataFrame) -> DataFrame:
    price, discount, stock = F.col("price"), F.col("discount_percentage"), F.col("stock_quantity")
    return (
        staged.drop("id", "return_policy_days_clean")
        .withColumns(
            {
                "discounted_price": share_of(price, 100 - discount),
                "discount_amount": share_of(price, discount),
                "rating_category": ladder(F.col("rating"), RATING_CATEGORY),
                "stock_level": ladder(stock, STOCK_LEVEL),
                "is_on_sale": flag(discount > 0),
                "discount_category": ladder(discount, DISCOUNT_CATEGORY),
                "is_available": flag((stock > 0) & (F.col("availability_status") == IN_STOCK)),
            }
        )
        # The band is taken on the rounded price.
        .withColumn("price_category", ladder(F.col("discounted_price"), PRICE_TIER))
    )
