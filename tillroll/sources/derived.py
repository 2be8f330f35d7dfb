"""Raw-shaped retail tables derived from the test tables (part, customer, orders, lineitem, events).

Real columns are used where they exist and integer arithmetic for the rest.  Money is
kept in whole cents until the last step, so no engine's rounding enters the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.functions.dates import iso_text
from tillroll.schemas import RAW, TEST_TABLES

ORPHAN_OFFSET = 10_000_000
BATCH = {
    "generated_at": "timestamp_ntz'2024-06-30 00:00:00'",
    "loaded_at": "timestamp_ntz'2024-06-30 01:00:00'",
    "batch_id": "'2024-06-30T01:00:00'",
    "source": "'test_tables'",
}

METHODS = ("Credit Card", "Debit Card", "PayPal", "Apple Pay", "Google Pay")
LOADED_STATUSES = ("Completed", "Cancelled", "Pending", "Shipped")
RAW_STATUSES = (
    "completed", "delivered", "processing", "shipped", "pending",
    "payment_pending", "cancelled", "refunded", "on_hold",
)

PRICE_CENTS = "({}) * 7919 % 80000 + 100"
ORDER_TIME = "o_orderdate + make_dt_interval(cast(o_orderkey % 7 as int), 0, cast(o_orderkey * 37 % 1440 as int))"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TEST_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _cycle(number: str, *values: str | None) -> str:
    """The entry of ``values`` at ``number`` modulo their count."""
    listed = ", ".join("null" if v is None else f"'{v}'" for v in values)
    return f"elt(cast({number} % {len(values)} as int) + 1, {listed})"


def _dollars(cents: str) -> str:
    return f"cast({cents} as double) / 100d"


def _shape(df: DataFrame, name: str, rules: dict[str, str]) -> DataFrame:
    """Raw table ``name``: each contract column by its rule or the batch constant."""
    rules = {**rules, **BATCH}
    return df.selectExpr(
        *[f"cast({rules[f.name]} as {f.dataType.simpleString()}) as {f.name}" for f in RAW[name].fields]
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "p_partkey"
    rules = {
        "id": k,
        "source_product_id": k,
        "product_name": "p_name",
        "brand": "p_brand",
        "category": "p_type",
        "description": "concat_ws(' ', p_brand, p_type, p_name)",
        "price": _dollars(f"({PRICE_CENTS.format(k)})"),
        "discount_percentage": f"if({k} % 5 = 0, 0, p_size + {k} % 20)",
        "stock": f"if({k} % 13 = 0, 0, {k} % 90)",
        "availability_status": f"if({k} % 7 = 0, 'Low Stock', 'In Stock')",
        "minimum_order_qty": f"{k} % 8 + 1",
        "rating": f"cast({k} % 46 + 5 as double) / 10d",
        "weight": _dollars(f"{k} % 700 * 5"),
        "width": _dollars(f"{k} % 31 * 100"),
        "height": _dollars(f"{k} % 37 * 100"),
        "depth": _dollars(f"{k} % 41 * 100"),
        "warranty_info": _cycle(k, "1 year warranty", "No warranty", None),
        "shipping_info": _cycle(k, "Ships in 1 week", "Ships overnight"),
        "return_policy": _cycle(k, "30 days return policy", "No return policy", "7 days return policy", None),
        "barcode": f"format_string('%012d', {k})",
        "qr_code": f"concat('qr-', {k})",
        "thumbnail": f"concat('thumb-', {k})",
    }
    return _shape(table(spark, sf_dir, "part"), "raw_products", rules)


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = "c_custkey"

    def time_before(day: str, days: str) -> str:
        minutes = f"make_dt_interval(0, 0, cast({k} * 31 % 1440 as int))"
        return f"cast(date_sub(date'{day}', cast({days} as int)) as timestamp_ntz) + {minutes}"

    rules = {
        "id": k,
        "source_customer_id": k,
        "first_name": "c_name",
        "last_name": f"if({k} % 50 = 0, null, c_mktsegment)",
        "email": f"if({k} % 97 = 0, null, concat('c', {k}, '@example.com'))",
        "phone": f"format_string('555-%07d', {k})",
        "date_of_birth": f"date_sub(date'2010-01-01', cast({k} * 53 % 26000 as int))",
        "gender": _cycle(k, "Male", "Female", "Other", None),
        "street_address": f"concat({k}, ' Main Street')",
        "city": f"concat('City ', {k} % 40)",
        "state": "concat('S', c_nationkey)",
        "zip_code": f"format_string('%05d', {k} % 100000)",
        "country": "concat('Country ', c_nationkey)",
        "registration_date": time_before("2024-06-30", f"{k} * {k} % 1600"),
        "last_login": f"if({k} % 17 = 0, null, {time_before('2024-06-30', f'{k} * 7 % 400')})",
        "is_active": f"if({k} % 29 = 0, null, {k} % 10 < 7)",
        "email_verified": f"if({k} % 19 = 0, null, {k} % 2 = 0)",
        "phone_verified": f"if({k} % 23 = 0, null, {k} % 3 = 0)",
        "marketing_opt_in": f"{k} % 5 < 3",
        "preferred_contact_method": _cycle(k, "Email", "Phone", "SMS", "None"),
        "customer_segment": "c_mktsegment",
    }
    return _shape(table(spark, sf_dir, "customer"), "raw_customers", rules)


def _line_cents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with unit price in cents, between 15% above and 20% below the list price."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "*",
        f"({PRICE_CENTS.format('l_partkey')}) * (115 - 5 * l_linenumber) div 100 as unit_cents",
        "if(l_quantity = 50, 0, cast(l_quantity as int) % 14 + 1) as units",
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = {
        "id": "l_orderkey * 10 + l_linenumber",
        "source_order_item_id": "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber)",
        "source_order_id": "l_orderkey",
        "source_product_id": f"l_partkey + if(l_orderkey % 101 = 0, {ORPHAN_OFFSET}, 0)",
        "quantity": "units",
        "unit_price": _dollars("unit_cents"),
        "total_price": _dollars("(unit_cents * units)"),
    }
    return _shape(_line_cents(spark, sf_dir), "raw_order_items", rules)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the orders state the sum of their lines, the others an amount of their own."""
    lines = _line_cents(spark, sf_dir).selectExpr("l_orderkey as o_orderkey", "unit_cents * units as line_cents")
    totals = lines.groupBy("o_orderkey").sum("line_cents").toDF("o_orderkey", "line_cents")
    stated = "cast(round(o_totalprice * 100) as bigint) div 500"
    rules = {
        "id": "o_orderkey",
        "source_order_id": "o_orderkey",
        "source_customer_id": "o_custkey",
        "order_date": ORDER_TIME,
        "order_status": _cycle("o_orderkey", *RAW_STATUSES),
        "total_amount": _dollars(f"if(o_orderkey % 3 = 0 and line_cents is not null, line_cents, {stated})"),
        "payment_method": _cycle("o_orderkey", *METHODS),
        "shipping_address": "concat('Dock ', o_custkey % 1000)",
    }
    return _shape(table(spark, sf_dir, "orders").join(totals, "o_orderkey", "left"), "raw_orders", rules)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = "event_id"
    order_key = f"if({e} % 97 = 0, {e} + {ORPHAN_OFFSET}, if({e} % 3 = 0, {e}, {e} div 4)) as o_orderkey"
    delay = f"array({e} % 6, {e} % 55 + 6, {e} % 1300 + 61, {e} % 8000 + 1600, {e} % 5000 + 12000)"
    minutes = f"cast(element_at({delay}, cast({e} % 5 as int) + 1) as int)"
    rules = {
        "id": e,
        "source_transaction_id": e,
        "source_order_id": "o_orderkey",
        "transaction_type": f"if(event_type = 'error', 'refund', if({e} % 11 = 0, 'adjustment', 'payment'))",
        "transaction_status": _cycle(
            e, "failed", "declined", "pending", "processing", "voided", "approved", "approved"
        ),
        "transaction_date": f"coalesce({ORDER_TIME} + make_dt_interval(0, 0, {minutes}), ts)",
        "amount": _dollars("round(value * 200)"),
        "payment_method": _cycle(e, *METHODS),
        "processor_name": _cycle(e, "north", "south", "east"),
        "processor_transaction_id": f"concat('tx-', {e})",
        "card_last_four": f"format_string('%04d', {e} % 10000)",
    }
    payments = table(spark, sf_dir, "events").selectExpr("*", order_key)
    dates = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return _shape(payments.join(dates, "o_orderkey", "left"), "raw_transactions", rules)


RAW_TABLES = {
    "raw_products": raw_products,
    "raw_customers": raw_customers,
    "raw_orders": raw_orders,
    "raw_order_items": raw_order_items,
    "raw_transactions": raw_transactions,
}


def source_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as the ingestion step loads them."""
    return raw_products(spark, sf_dir).selectExpr(
        "source_product_id as product_id", "product_name", "brand", "category", "price",
        "discount_percentage", "rating", "stock", "description", "thumbnail", "weight", "width",
        "height", "depth", "warranty_info", "shipping_info", "availability_status", "return_policy",
        "minimum_order_qty", "barcode", "qr_code", "generated_at", "source", "batch_id",
    ).withColumn("generated_at", iso_text(F.col("generated_at")))


def source_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the ingestion step loads them: times are ISO text."""
    loaded = raw_customers(spark, sf_dir).drop("id", "loaded_at")
    times = {c: iso_text(F.col(c)) for c in ("registration_date", "last_login", "generated_at")}
    return loaded.withColumnRenamed("source_customer_id", "customer_id").withColumns(times)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Basket lines before pricing: order, product and quantity (1 to 3)."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey as order_id", "l_partkey as product_id", "cast(l_quantity as int) % 3 + 1 as quantity"
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level facts that pricing does not produce."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as order_id",
        "o_custkey as customer_id",
        f"{ORDER_TIME} as ordered_at",
        f"{_cycle('o_orderkey', *LOADED_STATUSES)} as order_status",
        f"{_cycle('o_orderkey', *METHODS)} as payment_method",
        f"{_cycle('o_orderkey', 'Standard', 'Express', 'Next Day')} as shipping_method",
    )


def product_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed product documents, one JSON text per row.

    Some products lack the price, the dimensions or the meta block.
    """
    k = "source_product_id"
    fields = {
        "id": k,
        "title": "product_name",
        "brand": "brand",
        "category": "category",
        "price": f"if({k} % 43 = 0, null, price)",
        "discountPercentage": "discount_percentage",
        "rating": "rating",
        "stock": "stock",
        "description": "description",
        "thumbnail": "thumbnail",
        "weight": "weight",
        "dimensions": f"if({k} % 47 = 0, null, struct(width, height, depth))",
        "warrantyInformation": "warranty_info",
        "shippingInformation": "shipping_info",
        "availabilityStatus": "availability_status",
        "returnPolicy": "return_policy",
        "minimumOrderQuantity": "minimum_order_qty",
        "meta": f"if({k} % 53 = 0, null, struct(barcode, qr_code as qrCode))",
    }
    record = ", ".join(f"{rule} as {name}" for name, rule in fields.items())
    return raw_products(spark, sf_dir).selectExpr(f"to_json(struct(array(struct({record})) as products)) as value")
