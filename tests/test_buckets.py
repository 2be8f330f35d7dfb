"""Merging batches into buckets against the whole history, and totals that follow."""

import random
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillroll.operators.aggregates import item_totals
from tillroll.sources import adapters, buckets

ROWS = "line string, source_order_id long, quantity int, unit_price double, total_price double, batch_id string"


def lines(spark, at, rows):
    return spark.createDataFrame([(str(i), o, q, p, q * p if q is not None else None, at) for i, o, q, p in rows], ROWS)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def files(spark, table):
    return {r[0].split("?")[0] for r in spark.table(f"{table}__buckets").select("_metadata.file_path").distinct().collect()}


def merged(spark, table, changes, **more):
    totals = {f"{table}_totals": item_totals}
    return buckets.merge(changes, table, "line", "source_order_id", 8, derived=totals, **more)


def test_merges_equal_the_history_and_totals_a_full_refresh(spark):
    table, rng, history = "bucket_test.lines", random.Random(1), []
    for n in range(4):
        size = 400 if n == 0 else 30
        rows = [(i, i % 90, rng.choice([None, 1, 2, 3]), rng.choice([1.0, 2.5, 9.99])) for i in rng.sample(range(500), size)]
        history.append(lines(spark, f"b{n}", rows + rows[:3]))
        merged(spark, table, history[-1])
        every = history[0]
        for more in history[1:]:
            every = every.unionByName(more)
        wanted = adapters.latest_per_key(every, "line")
        assert rows_of(spark.table(table).select(*wanted.columns)) == rows_of(wanted)
        totals = item_totals(wanted)
        assert rows_of(spark.table(f"{table}_totals").select(*totals.columns)) == rows_of(totals)


def test_a_small_batch_touches_its_buckets_only(spark):
    table = "bucket_test.small"
    first = merged(spark, table, lines(spark, "b0", [(i, i % 50, 1, 2.0) for i in range(500)]))
    assert first.touched == tuple(range(8))
    before = {name: files(spark, name) for name in (table, f"{table}_totals")}
    second = merged(spark, table, lines(spark, "b1", [(3, 3, 7, 2.0)]))
    assert len(second.touched) == 1
    for name, old in before.items():
        new = files(spark, name) - old
        assert new and all(f"bucket={second.touched[0]}/" in f for f in new)
    # The merge reads what the manifest has of the touched bucket, and nothing else.
    entries = [e for e in buckets._entries(spark, table) if e[1] in second.touched]
    read = buckets.current(spark, table, entries)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.inputFiles() and "PartitionFilters: [" in plan
    assert all(f"bucket={second.touched[0]}/" in f for f in buckets.current(spark, table, entries).select("_metadata.file_path").distinct().toPandas()["file_path"])
    assert spark.table(f"{table}_totals").filter("source_order_id = 3").first()["total_items_quantity"] == 9 + 7
    assert buckets.sweep(spark, table, (f"{table}_totals",)) == 2
    assert spark.table(table).count() == 500 and spark.table(f"{table}_totals").count() == 50


def test_retractions_and_moves(spark):
    table = "bucket_test.moved"
    merged(spark, table, lines(spark, "b0", [(1, 10, 1, 5.0), (2, 10, 1, 9.0), (3, 11, 1, 1.0)]))
    out = lines(spark, "b1", [(2, 10, 1, 9.0), (3, 11, 1, 1.0)]).withColumn("retracted", F.lit(True))
    into = lines(spark, "b1", [(3, 12, 4, 1.0)]).withColumn("retracted", F.lit(False))
    merged(spark, table, out.unionByName(into))
    assert {(r.line, r.source_order_id) for r in spark.table(table).collect()} == {("1", 10), ("3", 12)}
    totals = {r.source_order_id: (r.item_count, float(r.max_item_price)) for r in spark.table(f"{table}_totals").collect()}
    # The most price of order 10 falls back, which no sum of changes could tell.
    assert totals == {10: (1, 5.0), 12: (1, 1.0)}


def test_a_failed_merge_shows_nothing(spark):
    table = "bucket_test.failed"
    merged(spark, table, lines(spark, "b0", [(1, 1, 1, 5.0), (2, 2, 1, 5.0)]))

    def broken(rows):
        return item_totals(rows).withColumn("item_count", F.raise_error(F.lit("lost")).cast("long"))

    change = lines(spark, "b1", [(1, 1, 3, 5.0)])
    with pytest.raises(Exception, match="lost"):
        buckets.merge(change, table, "line", "source_order_id", derived={f"{table}_totals": broken})
    assert {r.quantity for r in spark.table(table).collect()} == {1}
    merged(spark, table, change)
    assert {r.quantity for r in spark.table(table).collect()} == {1, 3}
    with pytest.raises(ValueError, match="differ"):
        merged(spark, table, change.drop("quantity"))


def test_null_keys_and_empty_batches(spark):
    table = "bucket_test.nulls"
    first = lines(spark, "b0", [(1, None, 1, 5.0), (2, 7, 1, 5.0)]).withColumn("line", F.nullif("line", F.lit("1")))
    merged(spark, table, first)
    assert merged(spark, table, first.limit(0)).touched == ()
    assert rows_of(spark.table(table).select(*first.columns)) == rows_of(first)


def shuffled(spark):
    """Bytes of shuffle files on this session's disks."""
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return sum(f.stat().st_size for d in dirs for f in Path(d).glob("*/shuffle_*"))


def settled(spark, most):
    """Whether no more than ``most`` is left; files go shortly after the step."""
    for _ in range(50):
        if shuffled(spark) <= most:
            return True
        time.sleep(0.1)
    return False


def test_a_merge_of_many_rows_goes_by_rounds_and_keeps_no_shuffle(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROUND_ROWS", 40, raising=False)
    table, real, steps, left = "bucket_test.rounds", buckets._write, [], []
    spark._jvm.System.gc()
    time.sleep(1)
    before = shuffled(spark)

    def write(df, name, *more):
        real(df, name, *more)
        steps.append(name)
        left.append(settled(spark, before))

    monkeypatch.setattr(buckets, "_write", write)
    rows = [(i, i % 90, 1, float(i % 7)) for i in range(600)]
    assert merged(spark, table, lines(spark, "b0", rows)).touched == tuple(range(8))
    # Every bucket has more rows than a round, so its rows and its totals are written before the next one's.
    assert steps == [table, f"{table}_totals"] * 8
    merged(spark, table, lines(spark, "b1", rows[:300]))
    assert steps == [table, f"{table}_totals"] * 16 and all(left)
    assert not [t.name for t in spark.catalog.listTables("bucket_test") if t.name.startswith("rounds__changes")]


def test_rounds_give_what_one_merge_gives(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROUND_ROWS", 120)
    table, rng, history = "bucket_test.by_rounds", random.Random(2), []
    keyless = F.when(F.col("source_order_id") % 7 > 0, F.col("line"))
    for n in range(2):
        rows = [(i, rng.choice([None, i % 90]), rng.choice([None, 1, 2]), rng.choice([1.0, 9.99])) for i in rng.sample(range(500), 300)]
        # Lines by id and order: the same id under another order is another row.
        history.append(lines(spark, f"b{n}", rows + rows[:50]).withColumn("line", keyless))
        merged(spark, table, history[-1])
    every = history[0].unionByName(history[1]).withColumn("retracted", F.lit(False))
    wanted = buckets.newest(every, ["line", "source_order_id"], "batch_id")
    assert rows_of(spark.table(table).select(*wanted.columns)) == rows_of(wanted)
    totals = item_totals(wanted)
    assert rows_of(spark.table(f"{table}_totals").select(*totals.columns)) == rows_of(totals)
    gone = wanted.filter("source_order_id < 60").withColumns({"batch_id": F.lit("b2"), "retracted": F.lit(True)})
    # An untyped column of a later batch takes the table's type.
    merged(spark, table, gone.withColumn("quantity", F.lit(None)))
    stay = wanted.filter("line is null or source_order_id is null or source_order_id >= 60")
    assert rows_of(spark.table(table).select(*stay.columns)) == rows_of(stay)


def test_a_failed_merge_of_rounds_shows_and_leaves_nothing(spark, monkeypatch):
    monkeypatch.setattr(buckets, "ROUND_ROWS", 200)
    table = "bucket_test.failed_rounds"
    rows = [(i, i % 90, 1, 5.0) for i in range(600)]
    merged(spark, table, lines(spark, "b0", rows))

    def broken(of):
        lost = F.raise_error(F.lit("lost")).cast("long")
        return item_totals(of).withColumn("item_count", F.when(F.col("source_order_id") == 89, lost).otherwise(F.col("item_count")))

    more = {k: spark.conf.get(k, None) for k in buckets._SETTINGS}
    with pytest.raises(Exception, match="lost"):
        buckets.merge(lines(spark, "b1", [(i, o, 3, p) for i, o, _, p in rows]), table, "line", "source_order_id", derived={f"{table}_totals": broken})
    assert {r.quantity for r in spark.table(table).collect()} == {1}
    assert {r.total_items_quantity for r in spark.table(f"{table}_totals").filter("source_order_id < 60").collect()} == {7}
    assert not [t.name for t in spark.catalog.listTables("bucket_test") if t.name.startswith("failed_rounds__changes")]
    assert more == {k: spark.conf.get(k, None) for k in buckets._SETTINGS}
    spark.sql(f"CREATE TABLE {table}__changeskilled (x int) USING parquet")
    assert buckets.sweep(spark, table, (f"{table}_totals",)) > 0 and not spark.catalog.tableExists(f"{table}__changeskilled")
    assert spark.table(table).count() == 600
