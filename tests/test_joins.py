from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillroll.operators.joins import hot_keys, join


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a sixth without a key, exact copies throughout."""
    return spark.range(0, 12000, 1, 8).select(
        F.expr("case when id % 3 = 0 then 7 when id % 6 = 1 then null else 1000 + id end").alias("key"),
        F.expr("id % 4").alias("payload"),
    )


@pytest.fixture(scope="module")
def facts(spark):
    """One row per key for some keys, two for one of them, and one without a key."""
    return spark.range(0, 13000, 1, 4).selectExpr("id as key", "id * 2 as fact").unionByName(
        spark.createDataFrame([(7, -1), (None, -2)], "key long, fact long")
    )


def test_hot_keys_finds_them_and_missing_keys(skewed):
    (found,) = hot_keys(skewed, "key", share=0.1, min_rows=100)
    assert found == {7: pytest.approx(1 / 3, abs=0.01), None: pytest.approx(1 / 6, abs=0.01)}


def test_hot_keys_of_several_columns_in_one_pass(skewed):
    keys, payloads = hot_keys(skewed, "key", "payload", share=0.2, min_rows=100)
    assert set(keys) == {7} and sorted(payloads) == [0, 1, 2, 3]


def test_small_keys_are_not_worth_spreading(skewed):
    assert hot_keys(skewed, "key") == ({},)


def test_a_key_is_hot_by_its_own_rows(spark):
    half = spark.range(60_000).selectExpr("case when id % 2 = 0 then 7 else id end as key")
    assert set(hot_keys(half, "key")[0]) == {7}
    few = spark.range(12_000_000).selectExpr("case when id % 1111 = 0 then 7 else id end as key")
    assert set(hot_keys(few, "key", share=0.0005)[0]) == {7}
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert set(hot_keys(few, "key")[0]) == {7}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_hot_keys_of_an_empty_table(skewed):
    assert hot_keys(skewed.limit(0), "key", "payload", min_rows=1) == ({}, {})


@pytest.mark.parametrize("hot", [{7: 0.3}, {None: 0.2}, {7: 0.3, None: 0.2}, {7: 0.9, 1001: 0.001, 424242: 0.1, None: 0.1}])
def test_spreading_changes_no_row(skewed, facts, hot):
    names = facts.selectExpr("key", "concat('n', fact) as name").filter("fact <> -1")
    plain = join(skewed, [facts, names], "key").select("key", "payload", "fact", "name")
    spread = join(skewed, [facts, names], "key", hot, ["payload"])
    assert "_salt" not in spread.columns
    rows = Counter(map(tuple, plain.collect()))
    assert Counter(map(tuple, spread.select("key", "payload", "fact", "name").collect())) == rows
    assert sum(rows.values()) == 16000  # 4000 lines of key 7 match twice


def test_an_inner_join_spreads_too(skewed, facts):
    plain = join(skewed, [facts], "key", how="inner").select("key", "payload", "fact")
    spread = join(skewed, [facts], "key", {7: 0.3, None: 0.2}, ["payload"], "inner").select("key", "payload", "fact")
    assert Counter(map(tuple, spread.collect())) == Counter(map(tuple, plain.collect()))


def test_other_joins_are_refused(skewed, facts):
    with pytest.raises(ValueError):
        join(skewed, [facts], "key", how="full")


def most_in_one_task(df, condition):
    sizes = df.filter(condition).groupBy(F.spark_partition_id().alias("task")).count()
    return sizes.agg(F.max("count")).first()[0]


@pytest.mark.parametrize("condition", ["key = 7", "key is null"])
def test_a_hot_key_reaches_many_tasks(spark, skewed, facts, condition):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        plain = most_in_one_task(join(skewed, [facts], "key"), condition)
        spread = most_in_one_task(join(skewed, [facts], "key", {7: 0.33, None: 0.17}, ["payload"]), condition)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spread < plain / 2


def test_hot_keys_where_tasks_have_nothing_to_merge(spark, skewed):
    """As on a cluster with more shuffle partitions than tasks have groups."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "50"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        assert set(hot_keys(skewed, "key", share=0.1, min_rows=100)[0]) == {7, None}
        nulls = skewed.withColumn("key", F.lit(None).cast("string"))
        assert hot_keys(nulls, "key", min_rows=100) == ({None: 1.0},)
        assert hot_keys(skewed.limit(0), "key", "payload") == ({}, {})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
