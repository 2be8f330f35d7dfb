import json
import re
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.operators import ingest
from tillroll.operators.batch import EmptyBatch, batch_metrics, day_slice, observed, run_metrics
from tillroll.plans import loads
from tillroll.rules import NOT_NULL
from tillroll.sources import adapters, tables
from tillroll.sources.payload import UnreadableDocuments, parse_documents, read_documents
from tillroll.streaming.landing import Landed, load_new_documents, load_readable_documents

AT = datetime(2024, 7, 1, 2, 0, 0)
FULL = {
    "id": 1, "title": "Cup", "brand": "B", "category": "C", "price": 9.99, "discountPercentage": 1.5,
    "rating": 4.5, "stock": 3, "description": "d", "thumbnail": "t", "weight": 2,
    "dimensions": {"width": 1.5, "height": 2.5, "depth": 3.5}, "warrantyInformation": "w",
    "shippingInformation": "s", "availabilityStatus": "In Stock", "returnPolicy": "30 days",
    "minimumOrderQuantity": 2, "meta": {"barcode": "b", "qrCode": "q", "createdAt": "ignored"}, "tags": ["x"],
}


def test_flatten_documents(spark):
    bare = {"id": 2, "title": "Plate", "price": None}
    documents = spark.createDataFrame(
        [(json.dumps({"products": [FULL, bare], "total": 2}),), ('{"products": []}',), ("{}",)], "value string"
    )
    cup, plate = sorted(ingest.flatten_products(parse_documents(documents)).collect(), key=lambda r: r.product_id)
    assert (cup.product_name, cup.price, cup.width, cup.qr_code, cup.minimum_order_qty) == ("Cup", 9.99, 1.5, "q", 2)
    assert len(cup) == 21
    assert (plate.price, plate.discount_percentage, plate.rating, plate.stock) == (0.0, 0.0, 0.0, 0)
    assert (plate.width, plate.barcode, plate.brand) == (None, None, None)


def test_read_documents_by_line_and_by_file(spark, tmp_path):
    (tmp_path / "lines.json").write_text("\n".join(json.dumps({"products": [{**FULL, "id": i}]}) for i in range(3)))
    by_line = ingest.flatten_products(read_documents(spark, str(tmp_path / "lines.json")))
    assert sorted(r.product_id for r in by_line.collect()) == [0, 1, 2]
    (tmp_path / "one.json").write_text(json.dumps({"products": [FULL, FULL]}, indent=2))
    whole = ingest.flatten_products(read_documents(spark, str(tmp_path / "one.json"), multi_line=True))
    assert whole.count() == 2


def test_a_broken_document_fails(spark):
    broken = spark.createDataFrame([('{"products": [',)], "value string")
    with pytest.raises(Exception):
        ingest.flatten_products(parse_documents(broken)).collect()


def price(spark, lines, products):
    lines = spark.createDataFrame(lines, "order_id long, product_id long, quantity int")
    products = spark.createDataFrame(products, "product_id long, product_name string, price double")
    return ingest.priced_lines(lines, products)


def test_pricing_and_free_shipping(spark):
    priced = price(
        spark,
        [(1, 1, 1), (2, 2, 1), (3, 3, 1), (4, 4, 3), (4, 1, 2), (6, 4, 1)],
        [(1, "a", 49.99), (2, "b", 50.0), (3, "c", 50.01), (4, "d", 0.1)],
    )
    got = {r.order_id: r for r in ingest.price_orders(priced).collect()}
    def facts(i):
        return (got[i].subtotal, got[i].tax, got[i].shipping_cost, got[i].total_amount, got[i].num_items)

    assert facts(1) == (D("49.99"), D("4.00"), D("5.99"), D("59.98"), 1)
    assert facts(2) == (D("50.00"), D("4.00"), D("5.99"), D("59.99"), 1)
    assert facts(3) == (D("50.01"), D("4.00"), D("0.00"), D("54.01"), 1)
    assert facts(4) == (D("100.28"), D("8.02"), D("0.00"), D("108.30"), 2)
    assert facts(6) == (D("0.10"), D("0.01"), D("5.99"), D("6.10"), 1)


@pytest.mark.parametrize("product", [99, None])
def test_a_line_of_an_unknown_product_is_an_error(spark, product):
    priced = price(spark, [(6, 4, 1), (6, product, 1)], [(4, "d", 0.1)])
    with pytest.raises(Exception, match="no such product"):
        ingest.price_orders(priced).collect()


def test_parts_follow_from_the_lines_alone(spark):
    lines = [(1, i % 5, i % 3 + 1) for i in range(2500)] + [(2, 4, 1)] * 5000
    frame = spark.createDataFrame(lines, "order_id long, product_id long, quantity int")
    products = spark.createDataFrame([(i, f"p{i}", 1.5) for i in range(5)], "product_id long, product_name string, price double")
    found = []
    for splits in (1, 4, 7):
        packed = ingest.pack_lines(ingest.priced_lines(frame.repartition(splits), products))
        found.append(sorted(map(tuple, packed.collect())))
    assert found[0] == found[1] == found[2]
    sizes = {}
    for order, part, parts, text in found[0]:
        sizes.setdefault(order, []).append(len(json.loads(text)))
    assert {order: sum(n) for order, n in sizes.items()} == {1: 2500, 2: 5000}
    assert max(max(n) for n in sizes.values()) <= 3000


def test_large_orders_load_and_read_back_whole(spark):
    from tillroll.plans import loads

    lines = [(1, i % 5, i % 3 + 1) for i in range(2500)] + [(2, 4, 1)] * 5000 + [(3, 1, 2)]
    headers = spark.createDataFrame(
        [(i, 5, datetime(2024, 6, 1), "Completed", "PayPal", "Express") for i in (1, 2, 3)],
        "order_id long, customer_id long, ordered_at timestamp_ntz, order_status string, payment_method string, "
        "shipping_method string",
    )
    frame = spark.createDataFrame(lines, "order_id long, product_id long, quantity int")
    products = spark.createDataFrame([(i, f"p{i}", 1.5) for i in range(5)], "product_id long, product_name string, price double")
    assert loads.load_transactions(headers, frame, products, "large_test.orders", AT, "t")["rows"] == 3
    loaded = spark.table("large_test.orders")
    assert sorted((r.num_items, r.items_detail is None, r.items_parts) for r in loaded.collect()) == [
        (1, False, 1), (2500, True, 3), (5000, True, 5),
    ]
    items = adapters.raw_order_items(adapters.loaded_lines(loaded, spark.table("large_test.orders_parts")))
    got = [(r.source_order_id, r.source_product_id, r.quantity) for r in items.collect()]
    assert sorted(got) == sorted(lines)
    assert items.select("id").distinct().count() == items.select("source_order_item_id").distinct().count() == len(lines)


@pytest.mark.parametrize("hot", [{}, {1: 0.9}])
def test_packed_lines_hold_every_line_once(spark, hot):
    lines = [(1, i % 5, i % 3 + 1) for i in range(2500)] + [(2, 0, 1), (2, 1, 1), (3, 4, 2)]
    priced = price(spark, lines, [(i, f"Men's \"{i}\"", 1.5 * i) for i in range(5)])
    packed = ingest.pack_lines(priced, max_lines=100, hot=hot)
    rows = packed.collect()
    small = [r for r in rows if r.order_id != 1]
    assert [(r.order_id, r.part, r.parts) for r in sorted(small)] == [(2, 0, 1), (3, 0, 1)]
    assert {r.parts for r in rows if r.order_id == 1} == {25}
    read = [(r.order_id, x["product_id"], x["quantity"]) for r in rows for x in json.loads(r.items_detail)]
    assert sorted(read) == sorted(lines)
    back = adapters.raw_order_items(tables.stamp(packed, AT, "t"))
    got = back.select("source_order_id", "source_product_id", "quantity").collect()
    assert sorted(map(tuple, got)) == sorted(lines)
    assert back.select("source_order_item_id").distinct().count() == len(lines)


def test_packed_text_is_sorted_json(spark):
    priced = price(spark, [(1, 2, 1), (1, 1, 3)], [(1, "a", 1.25), (2, "b", 2.0)])
    assert ingest.pack_lines(priced).first().items_detail == (
        '[{"product_id":1,"product_name":"a","quantity":3,"unit_price":1.25,"item_total":3.75},'
        '{"product_id":2,"product_name":"b","quantity":1,"unit_price":2.00,"item_total":2.00}]'
    )


def test_lines_in_python_text_are_read(spark):
    lines = [
        {"product_id": 1, "product_name": "Men's cup", "quantity": 2, "unit_price": 1.5, "item_total": 3.0},
        {"product_id": 2, "product_name": 'the "big" men\'s: None, really', "quantity": 1, "unit_price": 9.99,
         "item_total": 9.99},
    ]
    missing = [{**lines[0], "product_name": None}]
    texts = [str(lines), json.dumps(lines), str(missing), "not a list", None]
    packed = spark.createDataFrame(
        [(i, 0, t, "2024-07-01T02:00:00", "2024-07-01T02:00:00", "t") for i, t in enumerate(texts)],
        "order_id long, part int, items_detail string, batch_id string, generated_at string, source string",
    )
    got = packed.select("order_id", adapters.parse_lines(F.col("items_detail")).alias("l")).collect()
    names = {r.order_id: [x.product_name for x in r.l] if r.l else None for r in got}
    wanted = [x["product_name"] for x in lines]
    assert names[0] == wanted and names[1] == wanted and names[2] == [None]
    assert [r.order_id for r in adapters.unreadable_lines(packed).collect()] == [3]
    assert adapters.raw_order_items(packed, skip_unreadable=True).count() == 5
    with pytest.raises(Exception, match="unreadable lines of order 3"):
        adapters.raw_order_items(packed).collect()


def test_segment_uses_elapsed_days(spark):
    as_of = datetime(2024, 7, 1, 12, 0, 0)
    cases = [
        ("2024-04-02T12:00:01", "New"), ("2024-04-02T12:00:00", "Growing"), ("2023-07-02T12:00:01", "Growing"),
        ("2023-07-02T12:00:00", "Established"), ("2024-07-02T00:00:00", "New"),
    ]
    df = spark.createDataFrame([(r,) for r, _ in cases], "registration_date string")
    assert [r.customer_segment for r in ingest.with_segment(df, as_of).collect()] == [s for _, s in cases]


def test_active_customers_excludes_unknown(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "customer_id long, is_active boolean")
    assert [r.customer_id for r in ingest.active_customers(df).collect()] == [1]


def test_adapters_reach_the_raw_contract(spark):
    priced = price(spark, [(12, 1, 1)], [(1, "a", 20.0)])
    headers = spark.createDataFrame(
        [(12, 5, datetime(2024, 6, 1, 10, 30, 0), "Completed", "PayPal", "Express")],
        "order_id long, customer_id long, ordered_at timestamp_ntz, order_status string, payment_method string, "
        "shipping_method string",
    )
    loaded = tables.stamp(ingest.assemble_transactions(headers, priced), AT, "t")
    row = loaded.first()
    assert (row.order_id, row.order_date, row.num_items) == ("ORD-00000012", "2024-06-01T10:30:00", 1)
    order = adapters.raw_orders(loaded).first()
    assert (order.source_order_id, order.order_status, order.order_date) == (
        12, "completed", datetime(2024, 6, 1, 10, 30),
    )
    assert (order.total_amount, order.loaded_at) == (27.59, AT)


def test_latest_per_key(spark):
    df = spark.createDataFrame(
        [(1, "a", "b1"), (1, "b", "b2"), (1, "c", "b2"), (2, None, "b1"), (None, "x", "b1"), (None, "x", "b1")],
        "k long, v string, batch_id string",
    )
    got = Counter_(adapters.latest_per_key(df, "k").collect())
    assert got == Counter_([(1, "c", "b2"), (2, None, "b1"), (None, "x", "b1"), (None, "x", "b1")])


def Counter_(rows):
    from collections import Counter

    return Counter(map(tuple, rows))


def test_snapshot_refuses_to_overwrite(spark, tmp_path):
    df = spark.range(5)
    path = tables.snapshot(df, str(tmp_path), "products", AT)
    assert path.endswith("/products_20240701_020000.parquet")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(Exception):
        tables.snapshot(df, str(tmp_path), "products", AT)


def test_append_and_overwrite_report_rows(spark):
    name = "sink_test.things"
    assert tables.append(spark.range(3).selectExpr("id", "'a' as v"), name) == 3
    assert tables.append(spark.range(4).selectExpr("'b' as v", "id"), name) == 4  # by name
    for other in (spark.range(1), spark.range(1).selectExpr("id", "'c' as v", "1 as extra")):
        with pytest.raises(ValueError, match="differ"):
            tables.append(other, name)
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [("a", 3), ("b", 4)]
    assert tables.overwrite(spark.range(2).selectExpr("id", "'c' as v"), name) == 2
    assert tables.query(spark, f"SELECT COUNT(*) FROM {name}").first()[0] == 2


def test_bucketed_table_groups_and_joins_without_a_shuffle(spark):
    tables.overwrite(spark.range(1000).selectExpr("id % 50 as k", "id as v"), "sink_test.b1", ["k"], 4)
    tables.overwrite(spark.range(50).selectExpr("id as k", "id as w"), "sink_test.b2", ["k"], 4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        totals = spark.table("sink_test.b1").groupBy("k").agg(F.sum("v").alias("v"))
        joined = totals.join(spark.table("sink_test.b2"), "k", "left")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_stamp_is_one_value_per_batch(spark):
    rows = tables.stamp(spark.range(3), AT, "api").collect()
    assert {(r.batch_id, r.generated_at, r.source) for r in rows} == {
        ("2024-07-01T02:00:00", "2024-07-01T02:00:00", "api")
    }
    assert "source" not in tables.stamp(spark.range(1), AT).columns


def test_raw_scan_applies_the_contract(spark, tmp_path):
    path = str(tmp_path / "orders")
    spark.range(3).selectExpr("id as source_order_id", "cast(id as double) as total_amount").write.parquet(path)
    df = tables.raw_scan(spark, path, "raw_orders")
    assert set(NOT_NULL["stg_orders"]) <= set(df.columns)
    assert df.filter("order_date is null").count() == 3


def test_shared_dir_comes_from_the_session(spark):
    assert tables.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_incremental_load_takes_each_file_once(spark, tmp_path):
    landing, target, done = (str(tmp_path / n) for n in ("landing", "target", "done"))
    (tmp_path / "landing").mkdir()

    def land(name, *ids):
        text = "\n".join(json.dumps({"products": [{**FULL, "id": i}, {**FULL, "id": i + 100}]}) for i in ids)
        (tmp_path / "landing" / name).write_text(text)

    land("one.json", 1, 2)
    assert load_new_documents(spark, landing, target, AT, "t", done) == 4
    assert load_new_documents(spark, landing, target, AT, "t", done) == 0
    land("two.json", 3)
    assert load_new_documents(spark, landing, target, AT, "t", done) == 2
    assert sorted(r.product_id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 101, 102, 103]


def test_rows_of_many_batches_are_counted(spark, tmp_path):
    """More batches than the progress that Spark remembers."""
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    (tmp_path / "landing").mkdir()
    for i in range(12):
        (tmp_path / "landing" / f"{i}.json").write_text(json.dumps({"products": [{**FULL, "id": i}]}))
    remembered = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        assert load_new_documents(spark, landing, target, AT, "t", files_per_batch=1) == 12
        assert load_new_documents(spark, landing, target, AT, "t", files_per_batch=1) == 0
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", remembered)


def test_unreadable_documents_go_aside_in_a_stream(spark, tmp_path):
    landing, target = str(tmp_path / "landing"), str(tmp_path / "target")
    (tmp_path / "landing").mkdir()
    good = json.dumps({"products": [{**FULL, "id": 1}, {**FULL, "id": 2}]})
    (tmp_path / "landing" / "a.json").write_text(good + '\n{"products": [{"id": "x1"')
    assert load_readable_documents(spark, landing, target, AT, "t") == Landed(2, 1)
    (tmp_path / "landing" / "b.json").write_text('{"products": "none"}\n' + good)
    assert load_readable_documents(spark, landing, target, AT, "t") == Landed(2, 1)
    assert load_readable_documents(spark, landing, target, AT, "t") == Landed(0, 0)
    aside = spark.read.parquet(f"{target}_quarantine").orderBy("document").collect()
    assert [(r.file[-6:], r.reason) for r in aside] == [
        ("b.json", "other types than declared"), ("a.json", "not JSON"),
    ]
    # One bad document still stops the strict load.
    with pytest.raises(Exception):
        load_new_documents(spark, landing, f"{target}-strict", AT, "t")


def test_unreadable_documents_go_aside_in_a_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    (tmp_path / "landing").mkdir()
    good = [json.dumps({"products": [{**FULL, "id": i}]}) for i in range(8)]
    (tmp_path / "landing" / "a.json").write_text("\n".join([*good, "{", '{"products": 5}']))
    with pytest.raises(Exception):
        loads.load_products(spark, landing, "quarantine_test.products", AT, "t")
    with pytest.raises(UnreadableDocuments, match="2 of 10"):
        loads.load_products(spark, landing, "quarantine_test.products", AT, "t", most_unreadable=0.1)
    assert not spark.catalog.tableExists("quarantine_test.products")
    got = loads.load_products(spark, landing, "quarantine_test.products", AT, "t", most_unreadable=0.2)
    assert (got["rows"], got["unreadable"]) == (8, 2)
    aside = spark.table("quarantine_test.products_quarantine")
    assert sorted((r.document, r.reason) for r in aside.collect()) == [
        ("{", "not JSON"), ('{"products": 5}', "other types than declared"),
    ]


def test_a_day_reads_the_files_of_its_day(spark, tmp_path):
    path = str(tmp_path / "by-day")
    df = spark.range(4000).selectExpr(
        "id", "timestamp_ntz'2024-06-01 00:00:00' + make_dt_interval(0, 0, cast(id % 40 as int) * 1440) as order_date"
    )
    every = df.unionByName(df.selectExpr("id", "cast(null as timestamp_ntz) as order_date").limit(5))
    tables.write_by_period(every, path, "order_date")
    stored = spark.read.parquet(path)
    assert stored.count() == 4005 and stored.filter("day is null").count() == 5
    sliced = day_slice(stored, date(2024, 6, 11), period="day")
    assert sorted(r.id for r in sliced.collect()) == sorted(r.id for r in day_slice(df, date(2024, 6, 11)).collect())
    assert "PartitionFilters: [isnotnull(day" in sliced._jdf.queryExecution().executedPlan().toString()
    files = {f for f in sliced.select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert 1 <= len(files) <= 2 and all("day=2024-06-10" in f for f in files)


def test_each_landing_has_a_checkpoint_of_its_own(spark, tmp_path):
    for name in ("first", "second"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.json").write_text(json.dumps({"products": [FULL]}))
        at = (str(tmp_path / name), str(tmp_path / f"{name}-target"), AT, "t")
        assert load_new_documents(spark, *at) == 1
        assert load_new_documents(spark, *at) == 0


def test_metrics_come_from_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, D("2.50")), (2, D("4.00"))], "id long, total_amount decimal(10,2)")
    watched, seen = observed(df, "total_amount")
    watched.write.parquet(str(tmp_path / "out"))
    assert run_metrics(seen, AT) == {"run_at": "2024-07-01T02:00:00", "rows": 2, "revenue": D("6.50")}


def test_an_empty_batch_is_an_error_where_rows_are_required(spark, tmp_path):
    watched, seen = observed(spark.range(0))
    watched.write.parquet(str(tmp_path / "out"))
    assert run_metrics(seen, AT)["rows"] == 0
    with pytest.raises(EmptyBatch):
        run_metrics(seen, AT, allow_empty=False)


def test_batches_and_day_slice(spark, tmp_path):
    moments = [datetime(2024, 6, 29, 23, 59, 59), datetime(2024, 6, 30), datetime(2024, 6, 30, 23, 59, 59),
               datetime(2024, 7, 1)]
    df = spark.createDataFrame([(m, m.strftime("%m")) for m in moments], "order_date timestamp_ntz, batch_id string")
    assert sorted(map(tuple, batch_metrics(df).collect())) == [("06", 3), ("07", 1)]
    path = str(tmp_path / "orders")
    df.write.parquet(path)
    sliced = day_slice(spark.read.parquet(path), AT.date())
    assert sorted(r.order_date for r in sliced.collect()) == moments[1:3]
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_date" in plan and "LessThan(order_date" in plan
