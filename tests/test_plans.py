"""Physical plans over written raw tables, with broadcasting off as for large inputs."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tillroll.operators import ingest, profiles, quality
from tillroll.plans.registry import all_queries
from tillroll.plans.retail import Retail
from tillroll.session import settings
from tillroll.sources import derived, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def models(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("raw")
    for name, build in derived.RAW_TABLES.items():
        build(spark, SF).write.parquet(str(base / name))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield Retail(lambda name: tables.raw_scan(spark, str(base / name), name), date(2024, 7, 1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange ", plan(df)))


def columns_read(df):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>", plan(df))]


def test_orders_shuffle_each_input_once(models):
    assert exchanges(models["transform_orders"]) == 3


def test_order_lines_skip_the_order_aggregates(models):
    df = models["transform_order_items"]
    assert exchanges(df) == 4 and "Aggregate" not in plan(df)


def test_transactions_skip_the_order_aggregates(models):
    df = models["transform_transactions"]
    assert exchanges(df) == 2 and "Aggregate" not in plan(df)


def test_row_models_do_not_shuffle(models):
    for name in ("transform_customers", "transform_products", "stg_orders"):
        assert exchanges(models[name]) == 0


def test_a_column_reads_what_it_needs(models):
    df = models["transform_orders"].select("source_order_id", "order_size")
    assert exchanges(df) == 0
    assert columns_read(df) == [{"source_order_id", "total_amount"}]
    counted = models["transform_orders"].select("source_order_id", "item_count")
    assert {frozenset(c) for c in columns_read(counted)} == {frozenset({"source_order_id"})}


def test_filters_reach_the_scan(models):
    text = plan(models["transform_orders"].filter("order_status = 'completed' and source_order_id = 5"))
    assert "EqualTo(order_status,completed)" in text
    assert text.count("EqualTo(source_order_id,5)") == 3  # also to both aggregates


def test_packing_shuffles_the_lines_once(spark, models):
    lines = derived.order_lines(spark, SF).withColumns({"unit_price": F.lit(1), "item_total": F.lit(1), "product_name": F.lit("a")})
    packed = ingest.priced_parts(lines)
    assert exchanges(packed) - exchanges(lines) == 1
    # The totals of the orders follow from the packed lines without another.
    headers = derived.order_headers(spark, SF)
    orders = ingest.packed_transactions(headers, packed)
    assert exchanges(orders) - exchanges(lines) - exchanges(headers) == 2


def test_the_summary_prices_once(spark, monkeypatch):
    """One written count, which all passes of the median and the sums read."""
    written = []
    count = profiles.counted_cents
    monkeypatch.setattr(profiles, "counted_cents", lambda *args: written.append(count(*args)) or written[-1])
    df = all_queries()["p13_summary"](spark, SF)
    assert len(written) == 1
    assert re.findall(r"ReadSchema: struct<(.*?)>", plan(df)) == ["cents:bigint,rows:bigint"]


def test_no_query_plans_a_cross_join(spark):
    for name in ("transform_orders", "transform_order_items", "source_transactions", "p13_summary", "q3_suite"):
        text = plan(all_queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_no_model_leaves_the_jvm(models):
    for name, df in models.all().items():
        assert "Python" not in plan(df), name


def test_check_of_orders_scans_once(models):
    df = quality.check_model(models["transform_orders"], "transform_orders")
    assert len(columns_read(df)) == 1 and exchanges(df) == 2


def test_settings_follow_the_input():
    small, large = settings(10**9, 8), settings(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert int(large["spark.sql.shuffle.partitions"]) == -(-100 * 10**12 // (256 * 1024**2))
