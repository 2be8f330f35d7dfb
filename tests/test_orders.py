from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from frames import raw

from tillroll.operators import order_items, orders, products, staging, transactions

AS_OF = date(2024, 7, 1)


def build(spark, orders_, items=(), payments=(), hot=None):
    return orders.orders(
        staging.orders(raw(spark, "raw_orders", *orders_)),
        staging.order_items(raw(spark, "raw_order_items", *items)),
        staging.transactions(raw(spark, "raw_transactions", *payments)),
        AS_OF,
        hot,
    )


def by_id(df, key="source_order_id"):
    return {r[key]: r for r in df.collect()}


def item(order, quantity=1, unit=10.0, total=10.0, **more):
    return {"source_order_id": order, "quantity": quantity, "unit_price": unit, "total_price": total, **more}


def payment(order, kind="payment", status="approved", amount=10.0, **more):
    return {"source_order_id": order, "transaction_type": kind, "transaction_status": status, "amount": amount, **more}


@pytest.mark.parametrize("hot", [{}, {1: 0.5, 3: 0.01, None: 0.2}])
def test_orders_with_and_without_lines_and_payments(spark, hot):
    got = by_id(
        build(
            spark,
            [
                {"source_order_id": 1, "total_amount": 30.0},
                {"source_order_id": 2, "total_amount": 30.0},
                {"source_order_id": 3, "total_amount": 0.01},
                {"source_order_id": None, "total_amount": None},
            ],
            [item(1, 2, 5.0, 10.0), item(1, 1, 20.0, 20.0), item(2, None, None, None), item(None), item(9)],
            [payment(1), payment(1, "refund", "declined", 4.0), payment(1, "refund", "pending", -1.0),
             payment(1, "adjustment", "voided", 7.0), payment(None), payment(9)],
            hot,
        )
    )
    one, two, three, none = got[1], got[2], got[3], got[None]
    assert (one.item_count, one.total_items_quantity, one.calculated_order_total) == (2, 3, D("30.00"))
    assert (one.avg_item_price, one.max_item_price, one.min_item_price) == (D("12.50000000"), D("20.00"), D("5.00"))
    assert (one.amount_variance, one.has_amount_discrepancy) == (D("0.00"), False)
    assert (one.total_payments, one.total_refunds, one.net_transaction_amount) == (D("10.00"), D("3.00"), D("7.00"))
    assert (one.transaction_count, one.payment_count, one.refund_count) == (4, 1, 2)
    assert (one.approved_transaction_count, one.declined_transaction_count, one.pending_transaction_count) == (1, 1, 1)
    assert (one.payment_status, one.has_failed_transactions, one.has_multiple_transactions) == ("Paid", True, True)
    # A line without figures counts, and its sums stay unknown.
    assert (two.item_count, two.total_items_quantity, two.calculated_order_total) == (1, 0, None)
    assert (two.amount_variance, two.has_amount_discrepancy, two.avg_item_price) == (D("30.00"), True, D("0E-8"))
    # No lines at all: the whole total is the variance, and 0.01 is within the tolerance.
    assert (three.item_count, three.calculated_order_total) == (0, None)
    assert (three.amount_variance, three.has_amount_discrepancy) == (D("0.01"), False)
    assert (three.order_complexity, three.payment_status, three.transaction_count) == ("Few Items", "No Payment", 0)
    # A missing key matches nothing, not even lines with a missing key.
    assert (none.item_count, none.transaction_count, none.order_size) == (0, 0, "Extra Large")
    assert (none.amount_variance, none.has_amount_discrepancy) == (None, False)


@pytest.mark.parametrize(
    "statuses, wanted",
    [
        (["approved", "failed"], "Paid"),
        (["failed", "pending"], "Payment Pending"),
        (["processing"], "Payment Pending"),
        (["failed"], "Payment Failed"),
        (["declined"], "Payment Failed"),
        (["voided"], "No Payment"),
        ([], "No Payment"),
    ],
)
def test_payment_status(spark, statuses, wanted):
    df = build(spark, [{"source_order_id": 1}], (), [payment(1, status=s) for s in statuses])
    assert df.first().payment_status == wanted


def test_an_approved_refund_also_reads_as_paid(spark):
    row = build(spark, [{"source_order_id": 1}], (), [payment(1, "refund")]).first()
    assert (row.payment_status, row.has_refunds, row.total_payments) == ("Paid", True, D("0.00"))


@pytest.mark.parametrize("hot", [{}, {1: 0.5}])
def test_a_repeated_order_keeps_every_row(spark, hot):
    df = build(spark, [{"source_order_id": 1}] * 5 + [{"source_order_id": 2}], [item(1), item(1)], [payment(1)], hot)
    assert sorted((r.source_order_id, r.item_count) for r in df.collect()) == [(1, 2)] * 5 + [(2, 0)]


def test_order_times(spark):
    moments = [
        (datetime(2024, 6, 29, 23, 59), 2, 25, 6, "Weekend"),
        (datetime(2024, 6, 30, 0, 0), 1, 24, 0, "Weekend"),
        (datetime(2024, 7, 1, 10, 30), 0, -10, 1, "Weekday"),
        (datetime(2024, 6, 28, 12, 0), 3, 60, 5, "Weekday"),
    ]
    rows = [{"source_order_id": i, "order_date": m[0]} for i, m in enumerate(moments)]
    got = by_id(build(spark, rows))
    for i, (_, days, hours, dow, kind) in enumerate(moments):
        r = got[i]
        assert (r.days_since_order, r.hours_since_order, r.day_of_week, r.weekday_weekend) == (days, hours, dow, kind)
    unknown = build(spark, [{"order_date": None}]).first()
    assert (unknown.day_of_week, unknown.weekday_weekend) == (None, "Weekday")


def lines(spark, items, products_, orders_, hot_products=None, hot_orders=None):
    return order_items.order_items(
        staging.order_items(raw(spark, "raw_order_items", *items)),
        products.products(staging.products(raw(spark, "raw_products", *products_))),
        build(spark, orders_),
        hot_products,
        hot_orders,
    )


@pytest.mark.parametrize("hot", [({}, {}), ({7: 0.5, None: 0.1}, {1: 0.2, 2: 0.2})])
def test_order_lines(spark, hot):
    got = by_id(
        lines(
            spark,
            [
                {"source_order_item_id": "a", **item(1, 4, 15.0, 60.0), "source_product_id": 7},
                {"source_order_item_id": "b", **item(2, 0, 25.0, 0.0), "source_product_id": 7},
                {"source_order_item_id": "c", **item(8, 4, 20.0, 80.0), "source_product_id": 99},
                {"source_order_item_id": "d", **item(None, 5, None, 10.0), "source_product_id": None},
            ],
            [{"source_product_id": 7, "price": 20.0, "minimum_order_qty": 4, "product_name": "cup"}],
            [{"source_order_id": 1, "total_amount": 90.0}, {"source_order_id": 2, "total_amount": 0.0}],
            *hot,
        ),
        "source_order_item_id",
    )
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.product_name, a.current_product_price, a.order_total_amount) == ("cup", D("20.00"), D("90.00"))
    assert (a.calculated_unit_price, a.discount_vs_current_price) == (D("15.00000000"), D("5.00"))
    assert (a.discount_percentage_vs_current, a.was_discounted) == (D("25.00"), True)
    # Two thirds of the stated total; exactly the minimum does not exceed it.
    assert (a.percent_of_order_total, a.exceeds_minimum_order) == (D("66.67"), False)
    assert (b.calculated_unit_price, b.percent_of_order_total) == (None, None)
    assert (b.discount_percentage_vs_current, b.was_discounted, b.discount_vs_current_price) == (
        D("0.00"), False, D("-5.00"),
    )
    assert (c.product_name, c.order_date, c.order_month, c.was_discounted) == (None, None, None, False)
    assert (c.discount_percentage_vs_current, c.discount_vs_current_price) == (D("0.00"), None)
    assert (d.price_tier, d.exceeds_minimum_order, d.item_revenue) == ("Luxury", False, D("10.00"))


@pytest.mark.parametrize("hot", [{}, {7: 0.5}])
def test_a_repeated_product_repeats_its_lines(spark, hot):
    rows = [{"source_product_id": 7, "price": p} for p in (1.0, 2.0)]
    df = lines(spark, [{"source_product_id": 7, "source_order_id": 1}], rows, [{"source_order_id": 1}], hot)
    assert sorted(r.current_product_price for r in df.collect()) == [D("1.00"), D("2.00")]


@pytest.mark.parametrize("hot", [{}, {1: 0.5, None: 0.1}])
def test_transactions(spark, hot):
    start = datetime(2024, 6, 15, 12, 0, 30)
    lags = [
        (timedelta(minutes=-90), "Immediate"), (timedelta(minutes=5), "Immediate"), (timedelta(minutes=6), "Fast"),
        (timedelta(minutes=60), "Fast"), (timedelta(minutes=61), "Same Day"), (timedelta(hours=24), "Same Day"),
        (timedelta(hours=25), "Within Week"), (timedelta(days=7, hours=11), "Within Week"),
        (timedelta(days=7, hours=12), "Delayed"),
    ]
    rows = [payment(1, source_transaction_id=i, transaction_date=start + lag) for i, (lag, _) in enumerate(lags)]
    rows += [
        payment(5, source_transaction_id=100, kind="refund", amount=-3.0),
        payment(None, source_transaction_id=101, kind="refund", status="declined", amount=3.0),
        payment(1, source_transaction_id=102, kind=None, status=None, amount=None),
    ]
    staged_orders = build(spark, [{"source_order_id": 1, "order_date": start, "total_amount": 12.0}])
    df = transactions.transactions(staging.transactions(raw(spark, "raw_transactions", *rows)), staged_orders, hot)
    got = by_id(df, "source_transaction_id")
    assert len(got) == len(rows)
    assert [got[i].transaction_timing for i in range(len(lags))] == [label for _, label in lags]
    orphan, refund, blank = got[100], got[101], got[102]
    assert (orphan.order_date, orphan.transaction_timing, orphan.signed_amount) == (None, "Delayed", D("-3.00"))
    assert (refund.signed_amount, refund.is_failed, refund.is_refund, refund.is_payment) == (D("-3.00"), True, True, False)
    assert (blank.is_refund, blank.is_successful, blank.signed_amount) == (False, False, None)
    assert (blank.transaction_status_category, blank.transaction_size) == ("Unknown", "Extra Large")
