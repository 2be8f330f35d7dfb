"""Every query by name: (spark, sf_dir) -> DataFrame over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.operators import batch, ingest, order_items, orders, profiles, quality, transactions
from tillroll.operators.aggregates import item_totals, transaction_totals
from tillroll.operators.joins import Hot, hot_keys, join
from tillroll.plans import loads
from tillroll.plans.retail import STAGED, TRANSFORMED, Retail
from tillroll.rules import NOT_NULL, UNIQUE
from tillroll.sources import adapters, buckets, derived, tables
from tillroll.sources.payload import parse_documents, read_documents
from tillroll.streaming.landing import load_new_documents

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = date(2024, 7, 1)
INGESTED_AT = datetime(2024, 7, 1, 2, 0, 0)
NEXT_INGESTED_AT = datetime(2024, 7, 2, 2, 0, 0)
DAY_SLICE_AS_OF = date(1998, 10, 9)

MODEL_KEYS = UNIQUE

# Query name -> (model, columns): one query per derived column of the models.
COLUMN_QUERIES: dict[str, tuple[str, tuple[str, ...]]] = {
    "st1_full_name": ("stg_customers", ("full_name",)),
    "st3_return_policy_days": ("stg_products", ("return_policy", "return_policy_days_clean")),
    "c1_age": ("transform_customers", ("age",)),
    "c2_age_group": ("transform_customers", ("age_group",)),
    "c3_days_since_registration": ("transform_customers", ("days_since_registration",)),
    "c4_months_since_registration": ("transform_customers", ("months_since_registration",)),
    "c5_years_since_registration": ("transform_customers", ("years_since_registration",)),
    "c6_customer_tenure": ("transform_customers", ("customer_tenure",)),
    "c7_days_since_last_login": ("transform_customers", ("days_since_last_login",)),
    "c8_activity_status": ("transform_customers", ("activity_status",)),
    "c9_verification_status": ("transform_customers", ("verification_status",)),
    "c10_is_fully_verified": ("transform_customers", ("is_fully_verified",)),
    "d1_discounted_price": ("transform_products", ("discounted_price",)),
    "d2_discount_amount": ("transform_products", ("discount_amount",)),
    "d3_rating_category": ("transform_products", ("rating_category",)),
    "d4_stock_level": ("transform_products", ("stock_level",)),
    "d5_price_category": ("transform_products", ("price_category",)),
    "d6_is_on_sale": ("transform_products", ("is_on_sale",)),
    "d7_discount_category": ("transform_products", ("discount_category",)),
    "d8_is_available": ("transform_products", ("is_available",)),
    "r1_order_status_category": ("transform_orders", ("order_status_category",)),
    "r2_is_fulfilled": ("transform_orders", ("is_fulfilled",)),
    "r3_is_terminated": ("transform_orders", ("is_terminated",)),
    "r4_calculated_order_total": ("transform_orders", ("calculated_order_total",)),
    "r5_amount_variance": ("transform_orders", ("amount_variance",)),
    "r6_has_amount_discrepancy": ("transform_orders", ("has_amount_discrepancy",)),
    "r7_item_columns": (
        "transform_orders",
        ("item_count", "total_items_quantity", "avg_item_price", "max_item_price", "min_item_price"),
    ),
    "r8_order_size": ("transform_orders", ("order_size",)),
    "r9_order_complexity": ("transform_orders", ("order_complexity",)),
    "r10_transaction_columns": (
        "transform_orders",
        (
            "transaction_count", "total_payments", "total_refunds", "net_transaction_amount",
            "payment_count", "refund_count", "approved_transaction_count", "failed_transaction_count",
            "declined_transaction_count", "pending_transaction_count", "processing_transaction_count",
        ),
    ),
    "r11_has_multiple_transactions": ("transform_orders", ("has_multiple_transactions",)),
    "r12_has_refunds": ("transform_orders", ("has_refunds",)),
    "r13_has_failed_transactions": ("transform_orders", ("has_failed_transactions",)),
    "r14_payment_status": ("transform_orders", ("payment_status",)),
    "r15_days_since_order": ("transform_orders", ("days_since_order",)),
    "r16_hours_since_order": ("transform_orders", ("hours_since_order",)),
    "r17_order_month_week": ("transform_orders", ("order_month", "order_week")),
    "r18_day_of_week": ("transform_orders", ("day_of_week",)),
    "r19_hour_of_day": ("transform_orders", ("hour_of_day",)),
    "r20_weekday_weekend": ("transform_orders", ("weekday_weekend",)),
    "e1_order_product_facts": (
        "transform_order_items",
        (
            "source_customer_id", "order_date", "order_status", "order_status_category",
            "order_total_amount", "product_name", "brand", "category", "current_product_price",
        ),
    ),
    "e2_calculated_unit_price": ("transform_order_items", ("calculated_unit_price",)),
    "e3_discount_vs_current_price": ("transform_order_items", ("discount_vs_current_price",)),
    "e4_discount_percentage": ("transform_order_items", ("discount_percentage_vs_current",)),
    "e5_was_discounted": ("transform_order_items", ("was_discounted",)),
    "e6_item_revenue": ("transform_order_items", ("item_revenue",)),
    "e7_percent_of_order_total": ("transform_order_items", ("percent_of_order_total",)),
    "e8_quantity_category": ("transform_order_items", ("quantity_category",)),
    "e9_price_tier": ("transform_order_items", ("price_tier",)),
    "e10_exceeds_minimum_order": ("transform_order_items", ("exceeds_minimum_order",)),
    "e11_order_month_week": ("transform_order_items", ("order_month", "order_week")),
    "x1_order_facts": (
        "transform_transactions",
        ("source_customer_id", "order_date", "order_status", "order_total_amount"),
    ),
    "x2_status_category": ("transform_transactions", ("transaction_status_category",)),
    "x3_is_successful": ("transform_transactions", ("is_successful",)),
    "x4_is_failed": ("transform_transactions", ("is_failed",)),
    "x5_is_payment_refund": ("transform_transactions", ("is_payment", "is_refund")),
    "x6_signed_amount": ("transform_transactions", ("signed_amount",)),
    "x7_minutes_from_order": ("transform_transactions", ("minutes_from_order_to_transaction",)),
    "x8_hours_from_order": ("transform_transactions", ("hours_from_order_to_transaction",)),
    "x9_days_from_order": ("transform_transactions", ("days_from_order_to_transaction",)),
    "x10_transaction_timing": ("transform_transactions", ("transaction_timing",)),
    "x11_transaction_month_week": ("transform_transactions", ("transaction_month", "transaction_week")),
    "x12_day_hour": ("transform_transactions", ("day_of_week", "hour_of_day")),
    "x13_transaction_size": ("transform_transactions", ("transaction_size",)),
}


def retail(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail(lambda name: derived.RAW_TABLES[name](spark, sf_dir), AS_OF)


def _model(name: str) -> Query:
    return lambda spark, sf_dir: retail(spark, sf_dir)[name]


def _columns(model: str, columns: tuple[str, ...]) -> Query:
    return lambda spark, sf_dir: retail(spark, sf_dir)[model].select(MODEL_KEYS[model], *columns)


def _raw(name: str) -> Query:
    """A raw table, written and scanned under its declared schema."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{_fresh(spark)}/{name}"
        derived.RAW_TABLES[name](spark, sf_dir).write.parquet(path)
        return tables.raw_scan(spark, path, name)

    return run


# --- ingestion ---------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Hot]:
    """Priced lines and the hot orders among them."""
    lines = derived.order_lines(spark, sf_dir)
    hot_products, hot_orders = hot_keys(lines, "product_id", "order_id")
    return ingest.priced_lines(lines, derived.source_products(spark, sf_dir), hot_products), hot_orders


def _priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir)[0]


def _source_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced, hot_orders = _lines(spark, sf_dir)
    headers = derived.order_headers(spark, sf_dir)
    return ingest.assemble_transactions(headers, priced, hot_orders, *hot_keys(headers, "order_id"))


def _transaction_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals without the packed lines, for the profiles."""
    headers = derived.order_headers(spark, sf_dir)
    totals = ingest.price_orders(_priced(spark, sf_dir))
    priced = join(headers, [totals], "order_id", *hot_keys(headers, "order_id"), ["customer_id"], "inner")
    return priced.withColumnRenamed("ordered_at", "order_date")


def _flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.flatten_products(parse_documents(derived.product_documents(spark, sf_dir)))


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = derived.source_customers(spark, sf_dir)
    return ingest.with_segment(customers, datetime(2024, 7, 1, 4, 30, 0)).select("customer_id", "customer_segment")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    priced, hot_orders = _lines(spark, sf_dir)
    return ingest.pack_lines(priced, hot=hot_orders)


def _items_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the orders that a load has written."""
    name = _new_table("transactions")
    lines, products = derived.order_lines(spark, sf_dir), derived.source_products(spark, sf_dir)
    loads.load_transactions(derived.order_headers(spark, sf_dir), lines, products, name, INGESTED_AT, "packed")
    loaded = adapters.loaded_lines(spark.table(name), spark.table(f"{name}_parts"))
    return adapters.raw_order_items(loaded).drop("id")


def _large_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of a customer as one order, packed ten to a part: lines and parts counted from the packed text."""
    customers = derived.order_headers(spark, sf_dir).select("order_id", "customer_id")
    lines = derived.order_lines(spark, sf_dir).join(customers, "order_id").drop("order_id")
    lines = lines.withColumnRenamed("customer_id", "order_id")
    packed = ingest.pack_lines(ingest.priced_lines(lines, derived.source_products(spark, sf_dir)), max_lines=10)
    read = packed.withColumn("line", F.explode(adapters.parse_lines(F.col("items_detail"))))
    return read.groupBy("order_id").agg(
        F.count("*").alias("lines"), F.max("parts").alias("parts"), F.sum("line.item_total").alias("total")
    )


def _ordered_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.ordered_transactions(derived.order_headers(spark, sf_dir), _priced(spark, sf_dir))


def _stamped_products(spark: SparkSession, sf_dir: str, at: datetime = INGESTED_AT) -> DataFrame:
    return tables.stamp(_flattened(spark, sf_dir), at, "landing")


def _raw_orders_from_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.raw_orders(tables.stamp(_source_transactions(spark, sf_dir), INGESTED_AT, "source"))


def _catalogue_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of the catalogue, the second with changed stock."""
    first = _stamped_products(spark, sf_dir)
    second = _stamped_products(spark, sf_dir, NEXT_INGESTED_AT).filter("stock > 0").withColumn(
        "stock", F.col("stock") + 1
    )
    return first, second


def _latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last of each product in two loads of the catalogue."""
    first, second = _catalogue_loads(spark, sf_dir)
    both = first.unionByName(second)
    return adapters.latest_per_key(both, "product_id").select("product_id", "stock", "batch_id")


# --- sources and sinks -------------------------------------------------------


def _fresh(spark: SparkSession) -> str:
    return f"{tables.shared_dir(spark)}/tillroll/{uuid4().hex}"


def _landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_fresh(spark)}/products"
    derived.product_documents(spark, sf_dir).write.text(path)
    return ingest.flatten_products(read_documents(spark, path))


def _incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals of documents loaded by two runs, the second run finding only the new files."""
    base = _fresh(spark)
    documents = derived.product_documents(spark, sf_dir)
    for at in (INGESTED_AT, NEXT_INGESTED_AT):
        documents.write.mode("append").text(f"{base}/landing")
        load_new_documents(spark, f"{base}/landing", f"{base}/products", at, "landing", f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/products")


def _snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tables.snapshot(_segmented(spark, sf_dir), _fresh(spark), "customers", INGESTED_AT)
    return spark.read.parquet(path)


def _new_table(model: str) -> str:
    return f"tillroll_{uuid4().hex}.{model}"


def _appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table("products")
    for at in (INGESTED_AT, NEXT_INGESTED_AT):
        tables.append(_stamped_products(spark, sf_dir, at), name)
    return spark.table(name)


def _overwritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _new_table("products")
    for at in (INGESTED_AT, NEXT_INGESTED_AT):
        tables.overwrite(_stamped_products(spark, sf_dir, at), name)
    return spark.table(name)


def _loaded_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load every order as one batch and read the table back: what the load reports is what it wrote."""
    name = _new_table("transactions")
    lines, products = derived.order_lines(spark, sf_dir), derived.source_products(spark, sf_dir)
    metrics = loads.load_transactions(
        derived.order_headers(spark, sf_dir), lines, products, name, INGESTED_AT, "source", _fresh(spark)
    )
    reported = F.lit(metrics["rows"]).cast("bigint"), F.lit(metrics["revenue"]).cast("decimal(28,2)")
    written = batch.batch_metrics(spark.table(name), revenue="total_amount")
    return written.withColumns({"reported_rows": reported[0], "reported_revenue": reported[1]})


def _materialized(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = f"tillroll_{uuid4().hex}"
    return tables.materialize(retail(spark, sf_dir)["stg_orders"], layer, "stg_orders")


def _adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = f"orders_{uuid4().hex}"
    retail(spark, sf_dir)["stg_orders"].createOrReplaceTempView(view)
    return tables.query(
        spark,
        f"SELECT order_status, COUNT(*) AS orders, SUM(total_amount) AS revenue FROM {view} GROUP BY order_status",
    )


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of the catalogue, the second with changed stock, merged into a table of current rows."""
    name = _new_table("products")
    for load in _catalogue_loads(spark, sf_dir):
        buckets.merge(load, name, "product_id", "product_id", buckets=16)
    return spark.table(name).select("product_id", "stock", "batch_id")


def _merged_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by order, kept through a first load of lines and a batch that corrects, adds, moves and retracts some."""
    name = _new_table("stg_order_items")
    # The ids of lines repeat here and there; with the amount they do not.
    named = F.concat_ws("-", "source_order_item_id", "total_price").alias("line")
    right = retail(spark, sf_dir)["stg_order_items"].drop("batch_id").select("*", named)
    part = F.pmod(F.xxhash64("source_order_item_id"), F.lit(100))
    astray = F.col("source_order_id") + 1
    first = right.filter(part > 0).withColumns(
        {
            "quantity": F.when(part == 1, F.col("quantity") + 3).otherwise(F.col("quantity")),
            "source_order_id": F.when(part == 2, astray).otherwise(F.col("source_order_id")),
        }
    )
    wrong = right.filter(part == 3).withColumn("line", F.concat(F.lit("x"), "line"))
    kept, out = F.lit(False).alias("retracted"), F.lit(True).alias("retracted")
    second = (
        right.filter(part <= 2)
        .select("*", kept)
        .unionByName(right.filter(part == 2).withColumn("source_order_id", astray).select("*", out))
        .unionByName(wrong.select("*", out))
    )
    totals = {f"{name}_totals": item_totals}
    for batch_id, lines in (("1", first.unionByName(wrong)), ("2", second)):
        stamped = lines.withColumn("batch_id", F.lit(batch_id))
        buckets.merge(stamped, name, "line", "source_order_id", 16, derived=totals)
    return spark.table(f"{name}_totals")


def _rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model whose second refresh fails its declared checks: readers still see the first."""
    name = _new_table("stg_orders")
    orders_ = retail(spark, sf_dir)["stg_orders"]

    def check(df: DataFrame) -> None:
        quality.require(quality.check_model(df, "stg_orders").collect())

    tables.overwrite(orders_, name, check=check)
    try:
        tables.overwrite(orders_.unionByName(orders_.filter("total_amount > 1000")), name, check=check)
    except quality.ChecksFailed:
        pass
    return spark.table(name)


def _loaded_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and revenue by batch of two loads, each run a second time, as a retry does."""
    name = _new_table("transactions")
    totals = _ordered_transactions(spark, sf_dir)
    for at in (INGESTED_AT, NEXT_INGESTED_AT, INGESTED_AT, NEXT_INGESTED_AT):
        loads.load_batch(totals, name, at, "source", revenue="total_amount")
    return batch.batch_metrics(spark.table(name), revenue="total_amount")


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents landed with a broken copy of each: the products loaded and what went aside, by reason."""
    path, name = f"{_fresh(spark)}/products", _new_table("products")
    documents = derived.product_documents(spark, sf_dir)
    broken = documents.select(F.expr("substring(value, 1, length(value) - 5)").alias("value"))
    documents.unionByName(broken).write.text(path)
    loads.load_products(spark, path, name, INGESTED_AT, most_unreadable=0.5)
    aside = spark.table(f"{name}_quarantine").select("reason")
    return (
        spark.table(name).select(F.lit("loaded").alias("reason")).unionByName(aside).groupBy("reason").agg(F.count("*").alias("rows"))
    )


def _month_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_fresh(spark)}/raw_orders"
    tables.write_by_period(derived.RAW_TABLES["raw_orders"](spark, sf_dir), path, "order_date", "month")
    sliced = batch.day_slice(spark.read.parquet(path), DAY_SLICE_AS_OF, period="month")
    return sliced.select("source_order_id", "order_date", "total_amount")


def _survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = derived.source_customers(spark, sf_dir)
    return profiles.survey(customers, (*profiles.CUSTOMER_SECTIONS, *profiles.CUSTOMER_FLAGS))


# --- joins, checks, metrics --------------------------------------------------


def _j1(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = retail(spark, sf_dir)
    return orders.with_items(m["stg_orders"].select(orders.KEY, "source_customer_id", "order_date"),
                             m["stg_order_items"], m.hot_orders)


def _j2(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = retail(spark, sf_dir)
    return orders.with_transactions(m["stg_orders"].select(orders.KEY, "source_customer_id", "order_date"),
                                    m["stg_transactions"], m.hot_orders)


def _j3(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = retail(spark, sf_dir)
    lines = m["stg_order_items"].select("source_order_item_id", order_items.PRODUCT_KEY, "quantity")
    return order_items.with_products(lines, m["transform_products"], m.hot_in_items[0])


def _j3_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The join of lines and products with every product of a few lines spread."""
    m = retail(spark, sf_dir)
    lines = m["stg_order_items"].select("source_order_item_id", order_items.PRODUCT_KEY, "quantity")
    (hot,) = hot_keys(lines, order_items.PRODUCT_KEY, share=0.0001, min_rows=20)
    return order_items.with_products(lines, m["transform_products"], hot)


def _j4(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = retail(spark, sf_dir)
    lines = m["stg_order_items"].select("source_order_item_id", order_items.ORDER_KEY, "total_price")
    return order_items.with_orders(lines, m["transform_orders"], m.hot_in_items[1])


def _j5(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = retail(spark, sf_dir)
    paid = m["stg_transactions"].select("source_transaction_id", transactions.KEY, "transaction_amount")
    return transactions.with_orders(paid, m["transform_orders"], m.hot_in_transactions)


def _not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(retail(spark, sf_dir)["stg_customers"], "email").select("source_customer_id", "email")


def _unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with more than one transaction: the check on a column that does repeat."""
    return quality.unique(retail(spark, sf_dir)["stg_transactions"], "source_order_id")


def _suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.suite(retail(spark, sf_dir).all())


def _daily_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _transaction_totals(spark, sf_dir).withColumn("batch_id", F.to_date("order_date").cast("string"))


def _products_profile(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(derived.source_products(spark, sf_dir))


def _customers_profile(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(derived.source_customers(spark, sf_dir))


def _transactions_profile(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_transaction_totals(spark, sf_dir))


def _aggregate(build: Callable[[DataFrame], DataFrame], staged: str, *columns: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        totals = build(retail(spark, sf_dir)[staged])
        return totals.select("source_order_id", *columns) if columns else totals

    return run


def all_queries() -> dict[str, Query]:
    named: dict[str, Query] = {name: _model(name) for name in (*STAGED, *TRANSFORMED)}
    named |= {
        "a1_item_agg": _aggregate(item_totals, "stg_order_items"),
        "a2_txn_agg": _aggregate(transaction_totals, "stg_transactions"),
        "a3_conditional_sums": _aggregate(
            transaction_totals, "stg_transactions", "total_payments", "total_refunds"
        ),
        "a4_signed_sum": _aggregate(transaction_totals, "stg_transactions", "net_transaction_amount"),
        "a5_counts_by_type": _aggregate(transaction_totals, "stg_transactions", "payment_count", "refund_count"),
        "a6_counts_by_status": _aggregate(
            transaction_totals,
            "stg_transactions",
            "approved_transaction_count",
            "failed_transaction_count",
            "declined_transaction_count",
            "pending_transaction_count",
            "processing_transaction_count",
        ),
        "j1_orders_items": _j1,
        "j2_orders_txns": _j2,
        "j3_items_products": _j3,
        "j3_spread_products": _j3_spread,
        "j4_items_orders": _j4,
        "j5_txns_orders": _j5,
    }
    named |= {name: _columns(model, columns) for name, (model, columns) in COLUMN_QUERIES.items()}
    named |= {
        "i1_flatten_products": _flattened,
        "i2_default_fill": lambda s, d: _flattened(s, d).select(
            "product_id", "price", "discount_percentage", "rating", "stock"
        ),
        "i3_segment": _segmented,
        "i4_order_pricing": lambda s, d: ingest.price_orders(_priced(s, d)),
        "i5_pack_items": _packed,
        "i6_item_count": lambda s, d: ingest.price_orders(_priced(s, d)).select("order_id", "num_items"),
        "i5_pack_large_orders": _large_orders,
        "i7_order_code": lambda s, d: _ordered_transactions(s, d).select("transaction_id", "order_id"),
        "i8_iso_time": lambda s, d: _ordered_transactions(s, d).select("transaction_id", "order_date"),
        "i9_active": lambda s, d: ingest.active_customers(derived.source_customers(s, d)),
        "i10_lookup": _priced,
        "source_transactions": _source_transactions,
        "g1_items_from_text": _items_from_text,
        "g2_raw_products": lambda s, d: adapters.raw_products(_stamped_products(s, d)),
        "g2_raw_customers": lambda s, d: adapters.raw_customers(
            tables.stamp(derived.source_customers(s, d), INGESTED_AT)
        ),
        "g2_raw_orders": _raw_orders_from_source,
        "g4_latest_per_key": _latest,
        "g4_merged_buckets": _upserted,
        "a1_merged_totals": _merged_totals,
        "io1_json_documents": _landed_documents,
        "io2_product_scan": _products_profile(lambda df: tables.reference_scan(df, "products")),
        "io3_customer_scan": _customers_profile(lambda df: tables.reference_scan(df, "customers")),
        "io6_snapshot": _snapshot,
        "io7_append": _appended,
        "io7_incremental_append": _incremental,
        "io7_retried_load": _loaded_twice,
        "io1_quarantine": _quarantined,
        "io8_overwrite": _overwritten,
        "io9_gated_refresh": _rebuilt,
        "io9_materialize": _materialized,
        "io10_adhoc_sql": _adhoc,
        "io11_batch_stamp": lambda s, d: _stamped_products(s, d).select(
            "product_id", "generated_at", "batch_id", "source"
        ),
    }
    named |= {f"io4_{name}": _raw(name) for name in derived.RAW_TABLES}
    named |= {
        "p1_product_count": _products_profile(profiles.row_count),
        "p2_product_sample": _products_profile(
            lambda df: profiles.first_rows(df, profiles.PRODUCT_SAMPLE, "product_id")
        ),
        "p3_distinct_category": _products_profile(lambda df: profiles.distinct_count(df, "category")),
        "p4_distinct_brand": _products_profile(lambda df: profiles.distinct_count(df, "brand")),
        "p5_customer_count": _customers_profile(profiles.row_count),
        "p6_active_share": _customers_profile(lambda df: profiles.share_true(df, "is_active")),
        "p7_verified_share": _customers_profile(lambda df: profiles.share_true(df, "email_verified")),
        "p8_opt_in_share": _customers_profile(lambda df: profiles.share_true(df, "marketing_opt_in")),
        "p9_segments": _customers_profile(lambda df: profiles.value_counts(df, "customer_segment")),
        "p10_genders": _customers_profile(lambda df: profiles.value_counts(df, "gender")),
        "p11_top_states": _customers_profile(
            lambda df: profiles.value_counts(df, "state", profiles.TOP_STATES)
        ),
        "p12_customer_sample": _customers_profile(
            lambda df: profiles.first_rows(df, profiles.CUSTOMER_SAMPLE, "customer_id")
        ),
        "p_customer_survey": _survey,
        "p13_summary": _transactions_profile(profiles.revenue_summary),
        "p14_status": _transactions_profile(lambda df: profiles.value_counts(df, "order_status")),
        "p14_payment_method": _transactions_profile(lambda df: profiles.value_counts(df, "payment_method")),
        "p15_items": _transactions_profile(lambda df: profiles.counts_by_value(df, "num_items")),
        "p16_revenue_raw": _transactions_profile(profiles.revenue_by_time),
        "p17_revenue_month": _transactions_profile(profiles.revenue_by_month),
        "m1_batch_rows": lambda s, d: batch.batch_metrics(_daily_batches(s, d)),
        "m2_batch_revenue": lambda s, d: batch.batch_metrics(_daily_batches(s, d), revenue="total_amount"),
        "m2_load_metrics": _loaded_metrics,
        "m3_day_slice": lambda s, d: batch.day_slice(
            _raw("raw_orders")(s, d), DAY_SLICE_AS_OF
        ).select("source_order_id", "order_date", "total_amount"),
        "m3_month_folders": _month_folders,
        "q1_not_null": _not_null,
        "q2_unique": _unique,
        "q3_suite": _suite,
    }
    return named


DECLARED_CHECKS = sum(len(columns) for columns in NOT_NULL.values()) + len(UNIQUE)
