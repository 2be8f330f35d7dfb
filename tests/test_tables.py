"""Tables that are replaced as one act, and batches that are seen whole or not at all."""

from datetime import datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.operators import ingest
from tillroll.plans import loads
from tillroll.sources import batches, tables

AT = datetime(2024, 7, 1, 2, 0, 0)
LATER = datetime(2024, 7, 2, 2, 0, 0)


def raising(spark, rows=10):
    """A frame whose last row cannot be computed."""
    return spark.range(rows).withColumn("v", F.when(F.col("id") < rows - 1, "b").otherwise(F.raise_error(F.lit("lost"))))


def names(spark, database):
    return {t.name for t in spark.catalog.listTables(database)}


def test_a_failed_write_leaves_the_table(spark):
    name = "swap_test.kept"
    tables.overwrite(spark.range(10).selectExpr("id", "'a' as v"), name)
    before = names(spark, "swap_test")
    with pytest.raises(Exception, match="lost"):
        tables.overwrite(raising(spark), name)
    assert spark.table(name).groupBy("v").count().collect() == [("a", 10)]
    assert names(spark, "swap_test") == before


def test_a_failed_check_leaves_the_table(spark):
    name = "swap_test.checked"
    tables.overwrite(spark.range(10), name)

    def no_rows_above_5(df):
        if n := df.filter("id > 5").count():
            raise ValueError(f"{n} rows")

    with pytest.raises(ValueError, match="4 rows"):
        tables.overwrite(spark.range(10).selectExpr("id"), name, check=no_rows_above_5)
    assert spark.table(name).count() == 10
    assert tables.overwrite(spark.range(6), name, check=no_rows_above_5) == 6
    assert spark.table(name).count() == 6


def test_readers_that_have_begun_keep_their_rows(spark):
    name = "swap_test.read"
    tables.overwrite(spark.range(3), name)
    begun = spark.table(name)
    tables.overwrite(spark.range(7).selectExpr("id", "id as more"), name)
    assert begun.count() == 3 and begun.columns == ["id"]
    assert spark.table(name).columns == ["id", "more"]
    # A table may be rebuilt from itself; versions before the last are dropped.
    for _ in range(3):
        tables.overwrite(spark.table(name).filter("id > 0"), name)
    assert [r.id for r in spark.table(name).orderBy("id").collect()] == [1, 2, 3, 4, 5, 6]
    assert len([n for n in names(spark, "swap_test") if n.startswith("read__v")]) == 2


def test_a_plain_table_becomes_the_version_before(spark):
    name = "swap_test.plain"
    assert tables.append(spark.range(2), name) == 2 and tables.current_version(spark, name) is None
    begun = spark.range(5)
    assert tables.overwrite(begun, name) == 5
    assert tables.append(spark.range(5, 8), name) == 3
    assert spark.table(name).count() == 8


def test_sweep_drops_what_nothing_points_at(spark):
    name = "swap_test.swept"
    tables.overwrite(spark.range(1), name)
    killed = tables.write_version(spark.range(9), name)
    assert tables.sweep(spark, name) == [killed.name.lower()]
    assert spark.table(name).count() == 1 and tables.sweep(spark, name) == []


def batch(spark, at, *ids):
    return tables.stamp(spark.createDataFrame([(i, D(i)) for i in ids], "id long, paid decimal(10,2)"), at, "t")


def test_a_batch_of_two_tables_is_seen_at_once(spark, monkeypatch):
    orders, parts = "ledger_test.orders", "ledger_test.orders_parts"
    at = AT.isoformat()

    def load(at, broken=False):
        second = batch(spark, at, 1, 2, 3)
        if broken:
            second = second.withColumn("paid", F.when(F.col("id") < 3, F.col("paid")).otherwise(F.raise_error(F.lit("killed"))))
        return batches.publish(
            {parts: batch(spark, at, 7, 8), orders: second}, at.isoformat(), "t", {orders: "paid"}
        )

    with pytest.raises(Exception, match="killed"):
        load(AT, broken=True)
    assert not spark.catalog.tableExists(orders) and batches.published(spark, orders, at, "t") is None
    wanted = {parts: batches.Published(2, None), orders: batches.Published(3, D("6.00"))}
    assert load(AT) == wanted
    # Again: nothing is written, and the same is reported.
    assert load(AT) == wanted and load(AT, broken=True) == wanted
    with pytest.raises(Exception, match="killed"):
        load(LATER, broken=True)
    assert (spark.table(parts).count(), spark.table(orders).count()) == (2, 3)
    load(LATER)
    assert (spark.table(parts).count(), spark.table(orders).count()) == (4, 6)
    assert spark.table(orders).columns == ["id", "paid", "batch_id", "generated_at", "source"]
    # The first killed load left rows of the parts, the second, too; nobody sees them.
    assert spark.table(f"{parts}__attempts").count() == 8
    assert batches.sweep(spark, parts) == 2 and spark.table(f"{parts}__attempts").count() == 4
    assert spark.table(parts).count() == 4


def test_a_load_killed_before_it_is_published_shows_nothing(spark, monkeypatch):
    name = "ledger_test.late"
    show = batches._show
    monkeypatch.setattr(batches, "_show", lambda *args: (show(*args), 1 / 0))
    with pytest.raises(ZeroDivisionError):
        batches.publish({name: batch(spark, AT, 1)}, AT.isoformat(), "t")
    assert spark.table(name).count() == 0
    monkeypatch.undo()
    batches.publish({name: batch(spark, AT, 1)}, AT.isoformat(), "t")
    assert spark.table(name).count() == 1


def test_of_two_loads_of_a_batch_the_first_published_counts(spark, monkeypatch):
    name = "ledger_test.raced"
    batches.publish({name: batch(spark, AT, 1, 2)}, AT.isoformat(), "t")
    # The second has looked before the first was published.
    monkeypatch.setattr(batches, "published", lambda *args: None)
    batches.publish({name: batch(spark, AT, 1, 2)}, AT.isoformat(), "t")
    assert spark.table(name).count() == 2
    monkeypatch.undo()
    assert batches.published(spark, name, AT.isoformat(), "t").rows == 2


def test_other_columns_and_other_databases_are_errors(spark):
    name = "ledger_test.shape"
    batches.publish({name: batch(spark, AT, 1)}, AT.isoformat(), "t")
    with pytest.raises(ValueError, match="differ"):
        batches.publish({name: batch(spark, LATER, 1).drop("paid")}, LATER.isoformat(), "t")
    with pytest.raises(ValueError, match="one database"):
        batches.publish({name: batch(spark, LATER, 1), "ledger_other.x": batch(spark, LATER, 1)}, LATER.isoformat(), "t")
    tables.append(spark.range(1), "ledger_test.plain")
    with pytest.raises(ValueError, match="not made of published batches"):
        batches.publish({"ledger_test.plain": batch(spark, AT, 1)}, AT.isoformat(), "t")
    # Another source of the same time is another batch.
    batches.publish({name: tables.stamp(batch(spark, AT, 4).select("id", "paid"), AT, "u")}, AT.isoformat(), "u")
    assert spark.table(name).count() == 2


def test_a_killed_load_of_transactions_runs_again(spark, tmp_path, monkeypatch):
    headers = spark.createDataFrame(
        [(i, i, datetime(2024, 6, 30, 10), "Completed", "PayPal", "Express") for i in (1, 2)],
        "order_id long, customer_id long, ordered_at timestamp_ntz, order_status string, payment_method string, "
        "shipping_method string",
    )
    lines = spark.range(1500).selectExpr("if(id < 1200, 1L, 2L) as order_id", "1L as product_id", "1 as quantity")
    products = spark.createDataFrame([(1, "a", 1.0)], "product_id long, product_name string, price double")

    def load():
        return loads.load_transactions(headers, lines, products, "ledger_test.sold", AT, "t", str(tmp_path))

    written = []

    def killed(df, table, attempt, revenue):
        if written:
            raise KeyboardInterrupt
        written.append(table)
        return write(df, table, attempt, revenue)

    write = batches._write
    monkeypatch.setattr(batches, "_write", killed)
    with pytest.raises(KeyboardInterrupt):
        load()
    monkeypatch.undo()
    assert written == ["ledger_test.sold_parts"] and not spark.catalog.tableExists("ledger_test.sold")
    wanted = {"run_at": AT.isoformat(), "rows": 2, "revenue": D("1620.00")}
    assert load() == wanted and load() == wanted
    assert spark.table("ledger_test.sold").count() == 2
    parts = spark.table("ledger_test.sold_parts")
    assert parts.select(F.sum(F.size(F.from_json("items_detail", "array<string>")))).first()[0] == 1200
    assert ingest.MAX_PACKED_LINES == 1000 and parts.count() == 2
