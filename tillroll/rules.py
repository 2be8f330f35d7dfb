"""Fixed values of the retail model.

Everything in this file is data: bounds, labels, status sets, rates, formats
and the declared column checks.  Changing an entry changes results, so the
logic modules hold no literal of their own.
"""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple


class Ladder(NamedTuple):
    """Ordered (comparison, bound, label) steps; the first that holds wins.

    A value that meets no step, NULL included, takes ``otherwise``.
    """

    steps: tuple[tuple[str, int | Decimal, str], ...]
    otherwise: str


class Groups(NamedTuple):
    """Ordered (members, label) sets; no membership, NULL included, is ``otherwise``."""

    groups: tuple[tuple[tuple[str, ...], str], ...]
    otherwise: str


# --- fixed values: customers -------------------------------------------------

AGE_GROUP = Ladder(
    (
        ("<", 18, "Under 18"),
        ("<", 25, "18-24"),
        ("<", 35, "25-34"),
        ("<", 45, "35-44"),
        ("<", 55, "45-54"),
        ("<", 65, "55-64"),
    ),
    "65+",
)

# Tenure looks at days first and only then at calendar years.
TENURE_BY_DAYS = (("<", 30, "New"), ("<", 90, "Recent"))
TENURE_BY_YEARS = Ladder((("<", 1, "Active"), ("<", 3, "Established")), "Veteran")

NEVER_LOGGED_IN = "Never Logged In"
ACTIVITY = Ladder(
    (
        ("<=", 7, "Highly Active"),
        ("<=", 30, "Active"),
        ("<=", 90, "Occasional"),
        ("<=", 180, "Dormant"),
    ),
    "Inactive",
)

VERIFIED_BOTH = "Fully Verified"
VERIFIED_ONE = "Partially Verified"
VERIFIED_NONE = "Unverified"

# Segment given at ingestion, on elapsed days since registration.
CUSTOMER_SEGMENT = Ladder((("<", 90, "New"), ("<", 365, "Growing")), "Established")

# --- fixed values: products --------------------------------------------------

RATING_CATEGORY = Ladder(
    (
        (">=", Decimal("4.5"), "Excellent"),
        (">=", Decimal("4.0"), "Very Good"),
        (">=", Decimal("3.0"), "Good"),
        (">=", Decimal("2.0"), "Fair"),
    ),
    "Poor",
)

STOCK_LEVEL = Ladder(
    (
        ("=", 0, "Out of Stock"),
        ("<=", 10, "Low Stock"),
        ("<=", 50, "Medium Stock"),
    ),
    "High Stock",
)

# Shared by the discounted list price and the price paid on an order line.
PRICE_TIER = Ladder(
    (
        ("<", 20, "Budget"),
        ("<", 50, "Economy"),
        ("<", 100, "Mid-Range"),
        ("<", 500, "Premium"),
    ),
    "Luxury",
)

DISCOUNT_CATEGORY = Ladder(
    (
        (">=", 50, "Massive"),
        (">=", 20, "Large"),
        (">=", 10, "Moderate"),
        (">", 0, "Small"),
    ),
    "No Discount",
)

IN_STOCK = "In Stock"
NO_RETURN_MARK = "NO RETURN"
NON_DIGITS = "[^0-9]"

# --- fixed values: orders and payments ---------------------------------------

FULFILLED = ("completed", "delivered")
IN_PROGRESS = ("processing", "shipped")
AWAITING = ("pending", "payment_pending")
TERMINATED = ("cancelled", "refunded")

ORDER_STATUS_CATEGORY = Groups(
    (
        (FULFILLED, "Fulfilled"),
        (IN_PROGRESS, "In Progress"),
        (AWAITING, "Awaiting Action"),
        (TERMINATED, "Terminated"),
    ),
    "Unknown",
)

# Shared by the order total and the amount of a single payment.
AMOUNT_SIZE = Ladder(
    (("<", 50, "Small"), ("<", 100, "Medium"), ("<", 500, "Large")),
    "Extra Large",
)

ORDER_COMPLEXITY = Ladder(
    (
        ("=", 1, "Single Item"),
        ("<=", 3, "Few Items"),
        ("<=", 10, "Multiple Items"),
    ),
    "Bulk Order",
)

QUANTITY_CATEGORY = Ladder(
    (("=", 1, "Single"), ("<=", 3, "Few"), ("<=", 10, "Multiple")),
    "Bulk",
)

DISCREPANCY_TOLERANCE = Decimal("0.01")
WEEKEND_DAYS = (0, 6)  # Sunday is 0
WEEKEND, WEEKDAY = "Weekend", "Weekday"

PAYMENT, REFUND = "payment", "refund"
APPROVED = "approved"
STATUS_COUNTS = ("approved", "failed", "declined", "pending", "processing")

TRANSACTION_STATUS_CATEGORY = Groups(
    (
        (("approved",), "Successful"),
        (("processing", "pending"), "In Progress"),
        (("failed", "declined"), "Failed"),
    ),
    "Unknown",
)
FAILED_STATUSES = ("failed", "declined")

PAID = "Paid"
PAYMENT_PENDING = "Payment Pending"
PAYMENT_FAILED = "Payment Failed"
NO_PAYMENT = "No Payment"

# Timing narrows by minutes, then hours, then days.
TIMING = (
    ("minute", 5, "Immediate"),
    ("minute", 60, "Fast"),
    ("hour", 24, "Same Day"),
    ("day", 7, "Within Week"),
)
TIMING_OTHERWISE = "Delayed"

# --- fixed values: ingestion -------------------------------------------------

TAX_RATE = Decimal("0.08")
FREE_SHIPPING_ABOVE = Decimal("50.00")
SHIPPING_FEE = Decimal("5.99")
ORDER_CODE_FORMAT = "ORD-%08d"
SNAPSHOT_STAMP = "%Y%m%d_%H%M%S"

# --- fixed values: declared column checks ------------------------------------

NOT_NULL: dict[str, tuple[str, ...]] = {
    "stg_products": ("source_product_id", "product_name", "price"),
    "stg_customers": ("source_customer_id", "email"),
    "stg_transactions": (
        "source_transaction_id",
        "source_order_id",
        "transaction_date",
        "transaction_amount",
    ),
    "stg_orders": ("source_order_id", "source_customer_id", "order_date", "total_amount"),
    "stg_order_items": (
        "source_order_item_id",
        "source_order_id",
        "source_product_id",
        "quantity",
        "unit_price",
        "total_price",
    ),
    "transform_customers": ("source_customer_id", "email"),
    "transform_products": ("source_product_id",),
    "transform_orders": ("source_order_id", "source_customer_id", "order_date", "total_amount"),
    "transform_order_items": ("source_order_item_id", "source_order_id", "source_product_id"),
    "transform_transactions": (
        "source_transaction_id",
        "source_order_id",
        "transaction_date",
        "transaction_amount",
    ),
}

UNIQUE: dict[str, str] = {
    "stg_products": "source_product_id",
    "stg_customers": "source_customer_id",
    "stg_transactions": "source_transaction_id",
    "stg_orders": "source_order_id",
    "stg_order_items": "source_order_item_id",
    "transform_customers": "source_customer_id",
    "transform_products": "source_product_id",
    "transform_orders": "source_order_id",
    "transform_order_items": "source_order_item_id",
    "transform_transactions": "source_transaction_id",
}
