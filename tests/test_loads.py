import json
from datetime import date, datetime
from decimal import Decimal as D
from functools import partial

import pytest
from frames import raw
from pyspark.sql import functions as F

from tillroll.operators import profiles
from tillroll.operators.batch import EmptyBatch
from tillroll.operators.joins import hot_keys
from tillroll.plans import loads
from tillroll.plans.retail import Retail

AT = datetime(2024, 7, 1, 2, 0, 0)
LATER = datetime(2024, 7, 2, 2, 0, 0)


def test_products_append_batch_by_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "page.json").write_text(json.dumps({"products": [{"id": 1, "title": "a"}, {"id": 2}]}))
    base = str(tmp_path / "copies")
    for at in (AT, LATER):
        metrics = loads.load_products(spark, str(tmp_path / "in"), "load_test.products", at, "api", base)
        assert metrics == {"run_at": at.isoformat(), "rows": 2}
    table = spark.table("load_test.products")
    assert table.groupBy("batch_id").count().orderBy("batch_id").collect() == [
        ("2024-07-01T02:00:00", 2), ("2024-07-02T02:00:00", 2),
    ]
    assert sorted(p.name for p in (tmp_path / "copies").iterdir()) == [
        "products_20240701_020000.parquet", "products_20240702_020000.parquet",
    ]
    assert len(table.columns) == 24


def test_a_landing_without_products_is_an_error(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"products": []}')
    with pytest.raises(EmptyBatch):
        loads.load_products(spark, str(tmp_path), "load_test.none", AT, snapshot_base=str(tmp_path / "copies"))
    assert not (tmp_path / "copies").exists()
    assert not spark.catalog.tableExists("load_test.none")


def test_transactions_report_rows_and_revenue(spark):
    headers = spark.createDataFrame(
        [(i, i, datetime(2024, 6, 30, 10), "Completed", "PayPal", "Express") for i in (1, 2, 3)],
        "order_id long, customer_id long, ordered_at timestamp_ntz, order_status string, payment_method string, "
        "shipping_method string",
    )
    lines = spark.createDataFrame([(1, 1, 1), (1, 2, 2), (2, 1, 3)], "order_id long, product_id long, quantity int")
    products = spark.createDataFrame([(1, "a", 10.0), (2, "b", 30.0)], "product_id long, product_name string, price double")
    metrics = loads.load_transactions(headers, lines, products, "load_test.transactions", AT, "t")
    assert metrics == {"run_at": AT.isoformat(), "rows": 2, "revenue": D("113.99")}
    report = profiles.transaction_profile(spark.table("load_test.transactions"))
    assert report["summary"].first() == (2, D("113.99"), D("56.99500000"), 56.995)
    assert report["items_per_order"].collect() == [(1, 1), (2, 1)]
    assert report["revenue_by_month"].collect() == [(date(2024, 6, 1), D("113.99"))]


def test_customers_take_their_segment(spark):
    people = spark.createDataFrame(
        [(1, "2024-06-30T00:00:00", True, "x", "NY"), (2, "2020-01-01T00:00:00", None, "y", "NY")],
        "customer_id long, registration_date string, is_active boolean, gender string, state string",
    ).select("*", *[F.lit("v").alias(c) for c in ("first_name", "last_name", "email", "city")],
             *[F.lit(True).alias(c) for c in ("email_verified", "marketing_opt_in")])
    assert loads.load_customers(people, "load_test.customers", AT, "t")["rows"] == 2
    report = profiles.customer_profile(spark.table("load_test.customers"))
    assert report["segments"].collect() == [("Established", 1), ("New", 1)]
    assert report["top_states"].collect() == [("NY", 2)]
    assert report["active"].first() == (1, 100.0)
    assert [r.customer_id for r in report["sample"].collect()] == [1, 2]


def test_a_third_of_all_rows_under_one_key(spark):
    """The models over skewed raw tables, spread by what the search finds, against the plain plan."""
    n = 900
    hot, missing = [1] * (n // 3), [None] * (n // 6)
    keys = hot + missing + list(range(2, n // 2 + 2))

    def build(name):
        if name == "raw_orders":
            return raw(spark, name, *[{"source_order_id": k, "source_customer_id": i} for i, k in enumerate(keys)])
        if name == "raw_order_items":
            return raw(spark, name, *[
                {"source_order_item_id": str(i), "source_order_id": 3 if k == 1 else k, "source_product_id": k}
                for i, k in enumerate(keys)
            ])
        if name == "raw_transactions":
            return raw(spark, name, *[
                {"source_transaction_id": i, "source_order_id": 2 if k == 1 else k} for i, k in enumerate(keys)
            ])
        return raw(spark, name, *[{"source_product_id": i, "price": float(i)} for i in range(50)])

    plain = Retail(build, date(2024, 7, 1))
    spread = Retail(build, date(2024, 7, 1), partial(hot_keys, share=0.1, min_rows=10))
    assert set(spread.hot_orders) == {1, None}
    assert [set(k) for k in spread.hot_in_items] == [{1, None}, {3, None}]
    assert set(spread.hot_in_transactions) == {2, None}
    for name in ("transform_orders", "transform_order_items", "transform_transactions"):
        wanted, got = plain[name], spread[name].select(*plain[name].columns)
        assert wanted.count() >= n
        assert wanted.exceptAll(got).count() == 0 and got.exceptAll(wanted).count() == 0, name
