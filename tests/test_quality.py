from datetime import date

import pytest
from frames import raw
from pyspark.sql import functions as F

from tillroll.operators import quality
from tillroll.plans.retail import Retail, refresh
from tillroll.rules import NOT_NULL, UNIQUE
from tillroll.sources import tables

KEYS = {
    "raw_products": "source_product_id",
    "raw_customers": "source_customer_id",
    "raw_orders": "source_order_id",
    "raw_order_items": "source_order_item_id",
    "raw_transactions": "source_transaction_id",
}


def clean(spark, name):
    key = KEYS[name]
    text = name == "raw_order_items"
    return raw(spark, name, *[{key: str(i) if text else i} for i in range(1, 6)])


def results(suite):
    return {(r.model, r.column, r.test): r.failures for r in suite.collect()}


def test_declared_checks():
    assert sum(map(len, NOT_NULL.values())) == 33 and len(UNIQUE) == 10 and set(NOT_NULL) == set(UNIQUE)


def test_clean_data_has_no_failures(spark):
    got = results(quality.suite(Retail(lambda name: clean(spark, name), date(2024, 7, 1)).all()))
    assert len(got) == 43 and set(got.values()) == {0}


def test_planted_failures_are_counted(spark):
    def planted(name):
        df = clean(spark, name)
        if name == "raw_orders":
            extra = [{"source_order_id": 1}, {"source_order_id": 1}, {"source_order_id": 2, "order_date": None},
                     {"source_order_id": None}, {"source_order_id": None, "total_amount": None}]
            return df.unionByName(raw(spark, name, *extra))
        if name == "raw_customers":
            return df.withColumn("email", F.when(F.col("source_customer_id") > 2, F.col("email")))
        return df

    got = results(quality.suite(Retail(planted, date(2024, 7, 1)).all()))
    failed = {k: v for k, v in got.items() if v}
    assert failed == {
        # Orders 1 and 2 are there three times and twice: two repeated values.
        ("stg_orders", "source_order_id", "unique"): 2,
        ("transform_orders", "source_order_id", "unique"): 2,
        ("stg_orders", "source_order_id", "not_null"): 2,
        ("transform_orders", "source_order_id", "not_null"): 2,
        ("stg_orders", "order_date", "not_null"): 1,
        ("transform_orders", "order_date", "not_null"): 1,
        ("stg_orders", "total_amount", "not_null"): 1,
        ("transform_orders", "total_amount", "not_null"): 1,
        ("stg_customers", "email", "not_null"): 2,
        ("transform_customers", "email", "not_null"): 2,
        # Every line and payment is of order 1, which now matches three rows.
        ("transform_order_items", "source_order_item_id", "unique"): 5,
        ("transform_transactions", "source_transaction_id", "unique"): 5,
    }


def test_single_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert quality.not_null(df, "k").count() == 2
    assert quality.unique(df, "k").collect() == [(1, 2)]


def test_an_empty_model_passes(spark):
    df = clean(spark, "raw_orders").limit(0)
    got = quality.check_model(df, "stg_orders").collect()
    assert [r.failures for r in got] == [0] * 5


def test_refresh_writes_every_model_and_checks_it(spark):
    got = results(refresh(spark, lambda name: clean(spark, name), date(2024, 7, 1)))
    assert len(got) == 43 and set(got.values()) == {0}
    for name in UNIQUE:
        layer = "staging" if name.startswith("stg_") else "transform"
        assert spark.table(f"{layer}.{name}").count() == 5
    again = refresh(spark, lambda name: clean(spark, name), date(2024, 7, 1))
    assert set(results(again).values()) == {0}


def test_bucketed_refresh_builds_orders_without_a_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        got = results(refresh(spark, lambda name: clean(spark, name), date(2024, 7, 1), buckets=4))
        assert len(got) == 43 and set(got.values()) == {0}
        staged = Retail(lambda name: None, date(2024, 7, 1))
        staged._models = {name: spark.table(f"staging.{name}") for name in UNIQUE if name.startswith("stg_")}
        plan = staged["transform_orders"]._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_order_keeps_its_table_unbucketed(spark):
    def find_hot(df, *keys):
        hot = {1: 0.5} if "source_order_item_id" in df.columns else {}
        return tuple(hot if key == "source_order_id" else {} for key in keys)

    refresh(spark, lambda name: clean(spark, name), date(2024, 7, 1), 4, find_hot).collect()

    def is_bucketed(table):
        return any(c.isBucket for c in spark.catalog.listColumns(tables.current_version(spark, table)))

    assert is_bucketed("staging.stg_orders") and not is_bucketed("staging.stg_order_items")


def test_a_failed_check_leaves_all_tables_as_they_were(spark):
    day = date(2024, 7, 1)
    refresh(spark, lambda name: clean(spark, name), day)
    versions = {n: tables.current_version(spark, f"transform.{n}") for n in UNIQUE if n.startswith("transform_")}
    tables_before = {t.name for t in spark.catalog.listTables("transform")}

    def worse(name):
        df = clean(spark, name)
        return df.unionByName(df.limit(1)) if name == "raw_customers" else df.limit(3)

    with pytest.raises(quality.ChecksFailed, match="stg_customers.source_customer_id unique: 1 failures"):
        refresh(spark, worse, day)
    assert {n: tables.current_version(spark, f"transform.{n}") for n in versions} == versions
    assert {t.name for t in spark.catalog.listTables("transform")} == tables_before
    assert {spark.table(f"transform.{n}").count() for n in versions} == {5}
    # Without the gate the failures are reported and the rows are there.
    got = results(refresh(spark, worse, day, gate=False))
    assert got["stg_customers", "source_customer_id", "unique"] == 1
    assert spark.table("transform.transform_customers").count() == 6


def test_a_failed_model_leaves_all_tables_as_they_were(spark):
    day = date(2024, 7, 1)
    refresh(spark, lambda name: clean(spark, name), day)
    before = tables.current_version(spark, "staging.stg_products")

    def broken(name):
        if name != "raw_transactions":
            return clean(spark, name).limit(2)
        return clean(spark, name).withColumn("amount", F.raise_error(F.lit("lost")).cast("double"))

    with pytest.raises(Exception, match="lost"):
        refresh(spark, broken, day).collect()
    assert tables.current_version(spark, "staging.stg_products") == before
    assert spark.table("transform.transform_orders").count() == 5
