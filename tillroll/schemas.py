"""Explicit schemas.  Nothing is inferred: a file that does not fit fails or reads as NULL.

Times are TIMESTAMP_NTZ, so no result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}

BATCH_COLUMNS = "generated_at timestamp_ntz, loaded_at timestamp_ntz, batch_id string, source string"


def _schema(columns: str) -> StructType:
    """Schema of ``name type`` pairs.  Needs no session, so modules import freely."""
    pairs = [pair.split() for pair in columns.split(",")]
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


def _table(columns: str) -> StructType:
    return _schema(f"{columns}, {BATCH_COLUMNS}")


RAW_PRODUCTS = _table(
    """id bigint, source_product_id bigint, product_name string, brand string, category string,
    description string, price double, discount_percentage double, stock int,
    availability_status string, minimum_order_qty int, rating double, weight double, width double,
    height double, depth double, warranty_info string, shipping_info string, return_policy string,
    barcode string, qr_code string, thumbnail string"""
)

RAW_CUSTOMERS = _table(
    """id bigint, source_customer_id bigint, first_name string, last_name string, email string,
    phone string, date_of_birth date, gender string, street_address string, city string,
    state string, zip_code string, country string, registration_date timestamp_ntz,
    last_login timestamp_ntz, is_active boolean, email_verified boolean, phone_verified boolean,
    marketing_opt_in boolean, preferred_contact_method string, customer_segment string"""
)

RAW_ORDERS = _table(
    """id bigint, source_order_id bigint, source_customer_id bigint, order_date timestamp_ntz,
    order_status string, total_amount double, payment_method string, shipping_address string"""
)

RAW_ORDER_ITEMS = _table(
    """id bigint, source_order_item_id string, source_order_id bigint, source_product_id bigint,
    quantity int, unit_price double, total_price double"""
)

RAW_TRANSACTIONS = _table(
    """id bigint, source_transaction_id bigint, source_order_id bigint, transaction_type string,
    transaction_status string, transaction_date timestamp_ntz, amount double,
    payment_method string, processor_name string, processor_transaction_id string,
    card_last_four string"""
)

RAW = {
    "raw_products": RAW_PRODUCTS,
    "raw_customers": RAW_CUSTOMERS,
    "raw_orders": RAW_ORDERS,
    "raw_order_items": RAW_ORDER_ITEMS,
    "raw_transactions": RAW_TRANSACTIONS,
}

# One landed product document: {"products": [ ... ]}.
PRODUCT_PAYLOAD = """products array<struct<
    id: bigint, title: string, brand: string, category: string, price: double,
    discountPercentage: double, rating: double, stock: bigint, description: string,
    thumbnail: string, weight: double,
    dimensions: struct<width: double, height: double, depth: double>,
    warrantyInformation: string, shippingInformation: string, availabilityStatus: string,
    returnPolicy: string, minimumOrderQuantity: int,
    meta: struct<barcode: string, qrCode: string>>>"""

# The lines packed into the text column of an order.
PACKED_LINES = """array<struct<product_id: bigint, product_name: string, quantity: int,
    unit_price: decimal(10,2), item_total: decimal(10,2)>>"""

# The test tables the raw tables are derived from.
TEST_TABLES = {
    "part": _schema(
        """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
        p_retailprice double"""
    ),
    "customer": _schema(
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "orders": _schema(
        """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
        o_orderdate timestamp_ntz, o_orderpriority string"""
    ),
    "lineitem": _schema(
        """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
        l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
        l_linestatus string, l_shipdate timestamp_ntz"""
    ),
    "events": _schema(
        """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,
        props string"""
    ),
}
