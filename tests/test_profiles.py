import random
import re
import statistics
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.operators import profiles


def amounts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "total_amount decimal(10,2)")


@pytest.mark.parametrize("count", [1, 2, 3, 10, 999, 1000])
def test_exact_median(spark, count):
    rng = random.Random(count)
    values = [D(rng.randrange(-200_000, 900_000)) / 100 for _ in range(count)]
    got = profiles.exact_median(amounts(spark, values), "total_amount")
    assert got == pytest.approx(float(statistics.median(values)), abs=1e-9)


@pytest.mark.parametrize(
    "values, wanted",
    [
        ([D("999.99"), D("1000.00")], 999.995),  # middles in two bands
        ([D("5.00")] * 700 + [D("9000.00")] * 300, 5.0),  # one value holds most rows
        ([D("1.00"), D("1.00"), D("9999999.99"), D("9999999.99")], 5000000.495),
        ([D("-0.01"), D("0.00"), None], -0.005),
    ],
)
def test_exact_median_edges(spark, values, wanted):
    got = profiles.exact_median(amounts(spark, values), "total_amount")
    assert got == pytest.approx(wanted, abs=1e-9)


def test_summary(spark):
    row = profiles.revenue_summary(amounts(spark, [D("1.00"), D("2.00"), D("4.01")])).first()
    assert tuple(row) == (3, D("7.01"), D("2.33666667"), 2.0)


def test_summary_of_nothing(spark):
    assert tuple(profiles.revenue_summary(amounts(spark, [D("1.00")]).limit(0)).first()) == (0, None, None, None)


def test_value_counts_order_and_ties(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "b", "a", "a", "c", None, None, None]], "v string")
    assert profiles.value_counts(df, "v").collect() == [("a", 2), ("b", 2), ("c", 1)]
    assert profiles.value_counts(df, "v", 2).collect() == [("a", 2), ("b", 2)]
    assert profiles.counts_by_value(df, "v").collect() == [("a", 2), ("b", 2), ("c", 1)]


def test_shares_and_distinct(spark):
    df = spark.createDataFrame([(True,), (False,), (None,), (True,)], "f boolean")
    assert profiles.share_true(df, "f").first() == (2, 200 / 3)
    assert profiles.distinct_count(df, "f").first()[0] == 2
    assert profiles.share_true(df.limit(0), "f").first() == (0, None)


def test_revenue_periods(spark):
    rows = [(f"2024-{m:02d}-15T10:00:0{s}", D(m)) for m in range(1, 9) for s in (0, 1)]
    df = spark.createDataFrame(rows, "order_date string, total_amount decimal(10,2)")
    by_month = profiles.revenue_by_month(df).collect()
    assert [(r.period.month, r.revenue) for r in by_month] == [(m, D(2 * m)) for m in range(3, 9)]
    by_time = profiles.revenue_by_time(df).collect()
    assert [r.period for r in by_time] == [f"2024-{m:02d}-15T10:00:0{s}" for m in (6, 7, 8) for s in (0, 1)]


def test_samples_take_the_first_rows_by_key(spark):
    df = spark.range(100).selectExpr("id as product_id", "'x' as name")
    got = profiles.first_rows(df, ("product_id", "name"), "product_id").collect()
    assert [r.product_id for r in got] == list(range(10))


def test_a_survey_is_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "people")
    rows = [(i, ["NY", "CA", None][i % 3], i % 2 == 0 if i % 5 else None) for i in range(30)]
    spark.createDataFrame(rows, "customer_id long, state string, is_active boolean").write.parquet(path)
    found = profiles.survey(spark.read.parquet(path), ["state", "is_active"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and len(re.findall(r"\bExchange ", plan)) == 1
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [("rows", None, 30), ("state", "NY", 10), ("state", "CA", 10), ("state", None, 10), ("is_active", None, 6),
         ("is_active", "true", 12), ("is_active", "false", 12)], key=str)


def test_reports_agree_with_their_single_queries(spark):
    rows = [(i, "abc"[i % 3], None if i % 4 else "x", float(i), 1.0, 5) for i in range(40)]
    columns = "product_id long, category string, brand string, price double, rating double, stock int"
    products = spark.createDataFrame(rows, columns).withColumn("product_name", F.lit("n"))
    report = profiles.product_profile(products)
    assert report["rows"].collect() == profiles.row_count(products).collect()
    assert report["categories"].collect() == profiles.distinct_count(products, "category").collect() == [(3,)]
    assert report["brands"].collect() == [(1,)] and report["sample"].count() == 10
    assert profiles.product_profile(products.limit(0))["rows"].collect() == [(0,)]
