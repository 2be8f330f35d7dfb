"""Each band at, just below and just above its bounds, with NULL and negative values.

Expected labels are written out here, apart from the rule tables.
"""

from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from frames import raw
from pyspark.sql import functions as F

from tillroll import rules
from tillroll.functions.columns import flag, grouped, ladder, percent, quotient, share_of
from tillroll.operators import customers, products, staging

CASES = [
    (rules.PRICE_TIER, "decimal(10,2)", [
        (D("-1.00"), "Budget"), (D("19.99"), "Budget"), (D("20.00"), "Economy"), (D("49.99"), "Economy"),
        (D("50.00"), "Mid-Range"), (D("99.99"), "Mid-Range"), (D("100.00"), "Premium"), (D("499.99"), "Premium"),
        (D("500.00"), "Luxury"), (None, "Luxury"),
    ]),
    (rules.AMOUNT_SIZE, "decimal(10,2)", [
        (D("49.99"), "Small"), (D("50.00"), "Medium"), (D("99.99"), "Medium"), (D("100.00"), "Large"),
        (D("499.99"), "Large"), (D("500.00"), "Extra Large"), (None, "Extra Large"), (D("-5.00"), "Small"),
    ]),
    (rules.RATING_CATEGORY, "decimal(3,2)", [
        (D("4.50"), "Excellent"), (D("4.49"), "Very Good"), (D("4.00"), "Very Good"), (D("3.99"), "Good"),
        (D("3.00"), "Good"), (D("2.99"), "Fair"), (D("2.00"), "Fair"), (D("1.99"), "Poor"), (None, "Poor"),
    ]),
    (rules.STOCK_LEVEL, "int", [
        (-1, "Low Stock"), (0, "Out of Stock"), (1, "Low Stock"), (10, "Low Stock"), (11, "Medium Stock"),
        (50, "Medium Stock"), (51, "High Stock"), (None, "High Stock"),
    ]),
    (rules.DISCOUNT_CATEGORY, "decimal(10,2)", [
        (D("50.00"), "Massive"), (D("49.99"), "Large"), (D("20.00"), "Large"), (D("19.99"), "Moderate"),
        (D("10.00"), "Moderate"), (D("9.99"), "Small"), (D("0.01"), "Small"), (D("0.00"), "No Discount"),
        (D("-3.00"), "No Discount"), (None, "No Discount"),
    ]),
    (rules.ORDER_COMPLEXITY, "bigint", [
        (0, "Few Items"), (1, "Single Item"), (2, "Few Items"), (3, "Few Items"), (4, "Multiple Items"),
        (10, "Multiple Items"), (11, "Bulk Order"),
    ]),
    (rules.QUANTITY_CATEGORY, "int", [
        (-2, "Few"), (0, "Few"), (1, "Single"), (2, "Few"), (3, "Few"), (4, "Multiple"), (10, "Multiple"),
        (11, "Bulk"), (None, "Bulk"),
    ]),
    (rules.AGE_GROUP, "int", [
        (17, "Under 18"), (18, "18-24"), (24, "18-24"), (25, "25-34"), (34, "25-34"), (35, "35-44"),
        (44, "35-44"), (45, "45-54"), (54, "45-54"), (55, "55-64"), (64, "55-64"), (65, "65+"), (None, "65+"),
    ]),
    (rules.CUSTOMER_SEGMENT, "int", [
        (89, "New"), (90, "Growing"), (364, "Growing"), (365, "Established"), (-1, "New"),
    ]),
]


@pytest.mark.parametrize("rule, kind, cases", CASES, ids=lambda v: getattr(v, "otherwise", None))
def test_ladder(spark, rule, kind, cases):
    df = spark.createDataFrame([(v,) for v, _ in cases], f"v {kind}")
    assert [r[0] for r in df.select(ladder(F.col("v"), rule)).collect()] == [label for _, label in cases]


def test_status_groups_are_case_sensitive(spark):
    cases = [
        ("completed", "Fulfilled"), ("delivered", "Fulfilled"), ("processing", "In Progress"),
        ("shipped", "In Progress"), ("pending", "Awaiting Action"), ("payment_pending", "Awaiting Action"),
        ("cancelled", "Terminated"), ("refunded", "Terminated"), ("Completed", "Unknown"), (None, "Unknown"),
    ]
    df = spark.createDataFrame([(v,) for v, _ in cases], "v string")
    got = df.select(grouped(F.col("v"), rules.ORDER_STATUS_CATEGORY)).collect()
    assert [r[0] for r in got] == [label for _, label in cases]
    payments = [
        ("approved", "Successful"), ("processing", "In Progress"), ("pending", "In Progress"),
        ("failed", "Failed"), ("declined", "Failed"), ("voided", "Unknown"), (None, "Unknown"),
    ]
    df = spark.createDataFrame([(v,) for v, _ in payments], "v string")
    got = df.select(grouped(F.col("v"), rules.TRANSACTION_STATUS_CATEGORY)).collect()
    assert [r[0] for r in got] == [label for _, label in payments]


def test_flags_are_never_null(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "v int")
    assert [r[0] for r in df.select(flag(F.col("v") > 0)).collect()] == [True, False, False]


def test_ratios(spark):
    df = spark.createDataFrame(
        [(D("2.00"), D("3.00")), (D("1.00"), D("0.00")), (D("1.00"), None), (D("1.00"), D("8.00"))],
        "a decimal(10,2), b decimal(10,2)",
    )
    assert [r[0] for r in df.select(quotient(F.col("a"), F.col("b"))).collect()] == [
        D("0.66666667"), None, None, D("0.12500000"),
    ]
    assert [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()] == [
        D("66.67"), None, None, D("12.50"),
    ]
    # 0.05 * 10% is half a cent: up.
    halves = spark.createDataFrame([(D("0.05"), D("10.00"))], "p decimal(10,2), d decimal(10,2)")
    assert halves.select(share_of(F.col("p"), F.col("d")), share_of(F.col("p"), 100 - F.col("d"))).first() == (
        D("0.01"), D("0.05"),
    )


def test_return_policy_days(spark):
    cases = [
        (None, None), ("No return policy", 0), ("no returns", 0), ("30 days return policy", 30),
        ("7 days or 30", 730), ("Lifetime", None), ("", None),
    ]
    rows = raw(spark, "raw_products", *[{"return_policy": p} for p, _ in cases])
    got = staging.products(rows).select("return_policy_days_clean").collect()
    assert [r[0] for r in got] == [days for _, days in cases]


def test_staging_keeps_rows_types_and_names(spark):
    products = staging.products(raw(spark, "raw_products", {"price": 1.005, "rating": 4.5, "stock": None}))
    kinds = dict(products.dtypes)
    assert len(kinds) == 27
    assert kinds["price"] == kinds["depth"] == "decimal(10,2)" and kinds["rating"] == "decimal(3,2)"
    assert {"stock_quantity", "minimum_order_quantity", "thumbnail_url", "source_system"} <= set(kinds)
    assert products.first()["price"] == D("1.01")
    people = staging.customers(raw(spark, "raw_customers", {"first_name": "A", "last_name": "B"}, {"last_name": None}))
    assert len(people.columns) == 26
    assert [r["full_name"] for r in people.collect()] == ["A B", None]
    payments = staging.transactions(raw(spark, "raw_transactions", {"amount": 12.345, "processor_name": "p"}))
    assert payments.select("transaction_amount", "payment_processor").first() == (D("12.35"), "p")


AS_OF = date(2024, 7, 1)


def stage_customers(spark, *rows):
    return customers.customers(staging.customers(raw(spark, "raw_customers", *rows)), AS_OF)


def test_customer_tenure(spark):
    def ago(days):
        return datetime(2024, 7, 1, 23, 0) - timedelta(days=days)

    cases = [
        (ago(29), "New"), (ago(30), "Recent"), (ago(89), "Recent"), (ago(90), "Active"),
        (datetime(2024, 1, 1), "Active"), (datetime(2023, 12, 31, 23, 59), "Established"),
        (datetime(2022, 1, 1), "Established"), (datetime(2021, 12, 31), "Veteran"), (None, "Veteran"),
    ]
    got = stage_customers(spark, *[{"registration_date": r} for r, _ in cases]).select("customer_tenure").collect()
    assert [r[0] for r in got] == [label for _, label in cases]


def test_customer_activity(spark):
    cases = [
        (0, "Highly Active"), (7, "Highly Active"), (8, "Active"), (30, "Active"), (31, "Occasional"),
        (90, "Occasional"), (91, "Dormant"), (180, "Dormant"), (181, "Inactive"), (None, "Never Logged In"),
    ]
    rows = [
        {"last_login": None if d is None else datetime(2024, 7, 1, 0, 5) - timedelta(days=d)} for d, _ in cases
    ]
    got = stage_customers(spark, *rows).select("activity_status").collect()
    assert [r[0] for r in got] == [label for _, label in cases]


def test_customer_verification(spark):
    full, part, none = "Fully Verified", "Partially Verified", "Unverified"
    cases = {
        (True, True): full, (True, False): part, (False, True): part, (False, False): none,
        (True, None): part, (None, True): part, (False, None): none, (None, False): none, (None, None): none,
    }
    rows = [{"email_verified": e, "phone_verified": p} for e, p in cases]
    got = stage_customers(spark, *rows).select("verification_status", "is_fully_verified").collect()
    assert [r[0] for r in got] == list(cases.values())
    assert [r[1] for r in got] == [label == full for label in cases.values()]


def test_customer_age_is_by_calendar_year(spark):
    born = [date(2006, 12, 31), date(2007, 1, 1), date(1959, 12, 31), None]
    got = stage_customers(spark, *[{"date_of_birth": d} for d in born]).select("age", "age_group").collect()
    assert [tuple(r) for r in got] == [(18, "18-24"), (17, "Under 18"), (65, "65+"), (None, "65+")]


def test_products(spark):
    rows = [
        {"price": 100.0, "discount_percentage": 80.01, "stock": 5, "availability_status": "In Stock"},
        {"price": 20.0, "discount_percentage": 0.0, "stock": 0, "availability_status": "In Stock"},
        {"price": 20.0, "discount_percentage": None, "stock": 5, "availability_status": "Low Stock"},
        {"price": 20.0, "discount_percentage": 0.02, "stock": None, "availability_status": None},
    ]
    df = products.products(staging.products(raw(spark, "raw_products", *rows)))
    assert "id" not in df.columns and "return_policy_days_clean" not in df.columns
    got = df.select(
        "discounted_price", "discount_amount", "price_category", "is_on_sale", "discount_category", "is_available"
    ).collect()
    assert [tuple(r) for r in got] == [
        (D("19.99"), D("80.01"), "Budget", True, "Massive", True),
        (D("20.00"), D("0.00"), "Economy", False, "No Discount", False),
        (None, None, "Luxury", False, "No Discount", False),
        (D("20.00"), D("0.00"), "Economy", True, "Small", False),
    ]
