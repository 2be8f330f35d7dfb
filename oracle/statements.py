"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.base import (
    CTES,
    METHODS,
    ORDER_TIME,
    amount,
    bands,
    cents,
    cycle,
    divided,
    with_tables,
)
from tillroll import rules
from tillroll.plans.registry import COLUMN_QUERIES, MODEL_KEYS

MODELS = tuple(name for name in CTES if name.startswith(("stg_", "transform_")))

INGEST = {
    # Catalogue as the product documents state it: three groups of products lack some facts.
    "landed": """
SELECT source_product_id AS product_id, product_name, brand, category,
  CASE source_product_id % 43 WHEN 0 THEN 0.0::DOUBLE ELSE price END AS price, discount_percentage, rating, stock,
  description, thumbnail, weight, CASE WHEN source_product_id % 47 <> 0 THEN width END AS width,
  CASE WHEN source_product_id % 47 <> 0 THEN height END AS height,
  CASE WHEN source_product_id % 47 <> 0 THEN depth END AS depth,
  warranty_info, shipping_info, availability_status, return_policy, minimum_order_qty,
  CASE WHEN source_product_id % 53 <> 0 THEN barcode END AS barcode,
  CASE WHEN source_product_id % 53 <> 0 THEN qr_code END AS qr_code
FROM raw_products""",
    "priced": """
SELECT l_partkey AS product_id, l_orderkey AS order_id, CAST(l_quantity AS INTEGER) % 3 + 1 AS quantity,
  product_name, price::DECIMAL(10,2) AS unit_price,
  (price::DECIMAL(10,2) * (CAST(l_quantity AS INTEGER) % 3 + 1))::DECIMAL(10,2) AS item_total
FROM lineitem JOIN raw_products ON source_product_id = l_partkey""",
    "baskets": f"""
SELECT order_id, num_items, {amount("c")} AS subtotal, {amount("t")} AS tax, {amount("s", width=10)} AS shipping_cost,
  {amount("c + t + s")} AS total_amount
FROM (
  SELECT *, (c * {int(rules.TAX_RATE * 100)} + 50) // 100 AS t,
    IF(c > {int(rules.FREE_SHIPPING_ABOVE * 100)}, 0, {int(rules.SHIPPING_FEE * 100)}) AS s
  FROM (SELECT order_id, COUNT(*) AS num_items, SUM({cents("item_total")}) AS c FROM priced GROUP BY order_id))""",
    "packed": """
SELECT order_id, 0 AS part, 1 AS parts, '[' || string_agg(
  '{"product_id":' || product_id || ',"product_name":"' || product_name || '","quantity":' || quantity
  || ',"unit_price":' || unit_price || ',"item_total":' || item_total || '}', ','
  ORDER BY product_id, product_name, quantity) || ']' AS items_detail
FROM priced GROUP BY order_id""",
    "ordered": f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, {ORDER_TIME} AS ordered_at,
  {cycle("o_orderkey", "Completed", "Cancelled", "Pending", "Shipped")} AS order_status,
  {cycle("o_orderkey", *METHODS)} AS payment_method,
  {cycle("o_orderkey", "Standard", "Express", "Next Day")} AS shipping_method,
  b.* EXCLUDE (order_id)
FROM orders JOIN baskets b ON b.order_id = o_orderkey""",
    "loaded": """
SELECT o.order_id AS transaction_id, 'ORD-' || lpad(o.order_id::VARCHAR, 8, '0') AS order_id, customer_id,
  strftime(ordered_at, '%Y-%m-%dT%H:%M:%S') AS order_date, order_status, subtotal, tax, shipping_cost,
  total_amount, num_items, items_detail, parts AS items_parts, payment_method, shipping_method
FROM ordered o JOIN packed p ON p.order_id = o.order_id""",
    "loaded_customers": """
SELECT * EXCLUDE (id, loaded_at, registration_date, last_login, generated_at, source_customer_id),
  source_customer_id AS customer_id, strftime(registration_date, '%Y-%m-%dT%H:%M:%S') AS registration_date,
  strftime(last_login, '%Y-%m-%dT%H:%M:%S') AS last_login,
  strftime(generated_at, '%Y-%m-%dT%H:%M:%S') AS generated_at
FROM raw_customers""",
}

FIRST, SECOND = "2024-07-01T02:00:00", "2024-07-02T02:00:00"


def _ingest(select: str) -> str:
    return with_tables(select, CTES | INGEST)


def _stamped(at: str) -> str:
    return f"SELECT *, '{at}' AS batch_id, '{at}' AS generated_at, 'landing' AS source FROM landed"


def _share(column: str) -> str:
    return (
        f"SELECT COUNT(*) FILTER ({column}) AS true_rows, "
        f"CAST(COUNT(*) FILTER ({column}) * 100 AS DOUBLE) / COUNT({column}) AS true_percent FROM raw_customers"
    )


def _frequencies(table: str, column: str, tail: str = "") -> str:
    return f"SELECT {column}, COUNT(*) AS rows FROM {table} WHERE {column} IS NOT NULL GROUP BY {column} {tail}"


def _periods(period: str) -> str:
    return (
        f"SELECT * FROM (SELECT {period} AS period, SUM(total_amount)::DECIMAL(28,2) AS revenue FROM ordered "
        "GROUP BY 1 ORDER BY 1 DESC LIMIT 6) ORDER BY period"
    )


def _check(model: str) -> str:
    """The checks of one model, each as its own subquery."""
    parts = [
        f"SELECT '{model}' AS model, '{c}' AS \"column\", 'not_null' AS test, "
        f"COUNT(*) FILTER ({c} IS NULL) AS failures FROM {model}"
        for c in rules.NOT_NULL[model]
    ]
    key = rules.UNIQUE[model]
    parts.append(
        f"SELECT '{model}', '{key}', 'unique', COUNT(*) FROM "
        f"(SELECT {key} FROM {model} WHERE {key} IS NOT NULL GROUP BY {key} HAVING COUNT(*) > 1)"
    )
    return " UNION ALL ".join(parts)


def statements() -> dict[str, str]:
    sql = {name: with_tables(f"SELECT * FROM {name}") for name in MODELS}
    for name, (model, columns) in COLUMN_QUERIES.items():
        sql[name] = with_tables(f"SELECT {MODEL_KEYS[model]}, {', '.join(columns)} FROM {model}")

    payment_totals = "SELECT source_order_id, {} FROM transaction_totals"
    orders_with = "SELECT o.source_order_id, source_customer_id, order_date, t.* EXCLUDE (source_order_id) FROM stg_orders o"
    tables = {
        "a1_item_agg": "SELECT * FROM item_totals",
        "a2_txn_agg": "SELECT * FROM transaction_totals",
        "a3_conditional_sums": payment_totals.format("total_payments, total_refunds"),
        "a4_signed_sum": payment_totals.format("net_transaction_amount"),
        "a5_counts_by_type": payment_totals.format("payment_count, refund_count"),
        "a6_counts_by_status": payment_totals.format(
            ", ".join(f"{s}_transaction_count" for s in rules.STATUS_COUNTS)
        ),
        "j1_orders_items": f"{orders_with} LEFT JOIN item_totals t ON t.source_order_id = o.source_order_id",
        "j2_orders_txns": f"{orders_with} LEFT JOIN transaction_totals t ON t.source_order_id = o.source_order_id",
        "j3_items_products": """
SELECT source_order_item_id, l.source_product_id, quantity, product_name, brand, category,
  price AS current_product_price, minimum_order_quantity
FROM stg_order_items l LEFT JOIN stg_products p ON p.source_product_id = l.source_product_id""",
        "j4_items_orders": """
SELECT source_order_item_id, l.source_order_id, total_price, source_customer_id, order_date, order_status,
  order_status_category, total_amount AS order_total_amount
FROM stg_order_items l LEFT JOIN transform_orders o ON o.source_order_id = l.source_order_id""",
        "j5_txns_orders": """
SELECT source_transaction_id, t.source_order_id, transaction_amount, source_customer_id, order_date,
  order_status, total_amount AS order_total_amount
FROM stg_transactions t LEFT JOIN stg_orders o ON o.source_order_id = t.source_order_id""",
        "i3_segment": f"""
SELECT source_customer_id AS customer_id,
  {bands("date_sub('day', registration_date, TIMESTAMP '2024-07-01 04:30:00')", rules.CUSTOMER_SEGMENT)}
    AS customer_segment
FROM raw_customers""",
        "i9_active": "SELECT source_customer_id AS customer_id FROM raw_customers WHERE is_active",
        "io2_product_scan": "SELECT source_product_id AS product_id, product_name, category, price, stock FROM raw_products",
        "io3_customer_scan": "SELECT source_customer_id AS customer_id, customer_segment, is_active FROM raw_customers",
        "io9_materialize": "SELECT * FROM stg_orders",
        "io10_adhoc_sql": """
SELECT order_status, COUNT(*) AS orders, SUM(total_amount)::DECIMAL(20,2) AS revenue
FROM stg_orders GROUP BY order_status""",
        "p1_product_count": "SELECT COUNT(*) AS rows FROM part",
        "p2_product_sample": """
SELECT source_product_id AS product_id, product_name, brand, category, price, rating, stock
FROM raw_products ORDER BY product_id LIMIT 10""",
        "p3_distinct_category": "SELECT COUNT(DISTINCT category) AS distinct_category FROM raw_products",
        "p4_distinct_brand": "SELECT COUNT(DISTINCT brand) AS distinct_brand FROM raw_products",
        "p5_customer_count": "SELECT COUNT(*) AS rows FROM customer",
        "p6_active_share": _share("is_active"),
        "p7_verified_share": _share("email_verified"),
        "p8_opt_in_share": _share("marketing_opt_in"),
        "p9_segments": _frequencies("raw_customers", "customer_segment"),
        "p10_genders": _frequencies("raw_customers", "gender"),
        "p11_top_states": _frequencies("raw_customers", "state", "ORDER BY rows DESC, state LIMIT 10"),
        "p12_customer_sample": """
SELECT source_customer_id AS customer_id, first_name, last_name, email, city, state, customer_segment
FROM raw_customers ORDER BY customer_id LIMIT 10""",
        "m3_day_slice": f"""
SELECT source_order_id, order_date, total_amount FROM raw_orders
WHERE order_date::DATE = DATE '1998-10-08'""",
        "q1_not_null": "SELECT source_customer_id, email FROM stg_customers WHERE email IS NULL",
        "q2_unique": """
SELECT source_order_id, COUNT(*) AS rows FROM stg_transactions
WHERE source_order_id IS NOT NULL GROUP BY source_order_id HAVING COUNT(*) > 1""",
        "q3_suite": " UNION ALL ".join(_check(model) for model in rules.UNIQUE),
    }
    tables["j3_spread_products"] = tables["j3_items_products"]
    tables["a1_merged_totals"] = tables["a1_item_agg"]
    tables["m3_month_folders"] = tables["m3_day_slice"]
    tables["io9_gated_refresh"] = tables["io9_materialize"]
    tables["p_customer_survey"] = "SELECT 'rows' AS section, NULL::VARCHAR AS value, COUNT(*) AS rows FROM raw_customers" + "".join(
        f" UNION ALL SELECT '{c}', {c}::VARCHAR, COUNT(*) FROM raw_customers GROUP BY {c}"
        for c in ("customer_segment", "gender", "state", "is_active", "email_verified", "marketing_opt_in")
    )
    tables |= {f"io4_{name}": f"SELECT * FROM {name}" for name in CTES if name.startswith("raw_")}
    tables["io6_snapshot"] = tables["i3_segment"]
    sql |= {name: with_tables(select) for name, select in tables.items()}

    ingest = {
        "i1_flatten_products": "SELECT * FROM landed",
        "i2_default_fill": "SELECT product_id, price, discount_percentage, rating, stock FROM landed",
        "i4_order_pricing": "SELECT * FROM baskets",
        "i5_pack_items": "SELECT * FROM packed",
        "i5_pack_large_orders": f"""
SELECT o_custkey AS order_id, COUNT(*) AS lines, ceil(COUNT(*) / 10.0)::INTEGER AS parts,
  SUM(item_total)::DECIMAL(20,2) AS total
FROM priced JOIN orders ON o_orderkey = order_id GROUP BY o_custkey""",
        "i6_item_count": "SELECT order_id, num_items FROM baskets",
        "i7_order_code": "SELECT transaction_id, order_id FROM loaded",
        "i8_iso_time": "SELECT transaction_id, order_date FROM loaded",
        "i10_lookup": "SELECT * FROM priced",
        "source_transactions": "SELECT * FROM loaded",
        "g1_items_from_text": f"""
SELECT order_id || '-0-' || (row_number() OVER (PARTITION BY order_id ORDER BY product_id, product_name, quantity) - 1)
    AS source_order_item_id,
  order_id AS source_order_id, product_id AS source_product_id, quantity, unit_price::DOUBLE AS unit_price,
  item_total::DOUBLE AS total_price, TIMESTAMP '2024-07-01 02:00:00' AS generated_at,
  TIMESTAMP '2024-07-01 02:00:00' AS loaded_at, '{FIRST}' AS batch_id, 'packed' AS source
FROM priced""",
        "g2_raw_products": f"""
SELECT product_id AS id, product_id AS source_product_id, * EXCLUDE (product_id),
  TIMESTAMP '2024-07-01 02:00:00' AS generated_at, TIMESTAMP '2024-07-01 02:00:00' AS loaded_at,
  '{FIRST}' AS batch_id, 'landing' AS source
FROM landed""",
        "g2_raw_customers": f"""
SELECT * EXCLUDE (loaded_at, batch_id), TIMESTAMP '2024-07-01 02:00:00' AS loaded_at, '{FIRST}' AS batch_id
FROM raw_customers""",
        "g2_raw_orders": f"""
SELECT transaction_id AS id, transaction_id AS source_order_id, customer_id AS source_customer_id,
  CAST(order_date AS TIMESTAMP) AS order_date, lower(order_status) AS order_status,
  total_amount::DOUBLE AS total_amount, payment_method, NULL::VARCHAR AS shipping_address,
  TIMESTAMP '2024-07-01 02:00:00' AS generated_at, TIMESTAMP '2024-07-01 02:00:00' AS loaded_at,
  '{FIRST}' AS batch_id, 'source' AS source
FROM loaded""",
        "g4_latest_per_key": f"""
SELECT product_id, IF(stock > 0, stock + 1, stock)::INTEGER AS stock, IF(stock > 0, '{SECOND}', '{FIRST}') AS batch_id
FROM landed""",
        "g4_merged_buckets": f"""
SELECT product_id, IF(stock > 0, stock + 1, stock)::INTEGER AS stock, IF(stock > 0, '{SECOND}', '{FIRST}') AS batch_id
FROM landed""",
        "io7_retried_load": f"""
SELECT batch_id, COUNT(*) AS rows, SUM(total_amount)::DECIMAL(28,2) AS revenue
FROM ordered, (VALUES ('{FIRST}'), ('{SECOND}')) AS b(batch_id) GROUP BY batch_id""",
        "io1_quarantine": """
SELECT unnest(['loaded', 'not JSON']) AS reason, unnest([count(*), count(*)]) AS rows FROM landed""",
        "io1_json_documents": "SELECT * FROM landed",
        "io7_append": f"{_stamped(FIRST)} UNION ALL {_stamped(SECOND)}",
        "io7_incremental_append": f"{_stamped(FIRST)} UNION ALL {_stamped(SECOND)}",
        "io8_overwrite": _stamped(SECOND),
        "io11_batch_stamp": f"SELECT product_id, generated_at, batch_id, source FROM ({_stamped(FIRST)})",
        "p13_summary": f"""
SELECT COUNT(*) AS transactions, SUM(total_amount)::DECIMAL(28,2) AS revenue,
  {amount(divided(f"SUM({cents('total_amount')})", "COUNT(*)", 1_000_000), 8)} AS mean,
  median(total_amount::DOUBLE) AS median
FROM ordered""",
        "p14_status": _frequencies("ordered", "order_status"),
        "p14_payment_method": _frequencies("ordered", "payment_method"),
        "p15_items": _frequencies("ordered", "num_items"),
        "p16_revenue_raw": _periods("ordered_at"),
        "p17_revenue_month": _periods("date_trunc('month', ordered_at)::DATE"),
        "m2_load_metrics": f"""
SELECT '{FIRST}' AS batch_id, COUNT(*) AS rows, SUM(total_amount)::DECIMAL(28,2) AS revenue,
  COUNT(*) AS reported_rows, SUM(total_amount)::DECIMAL(28,2) AS reported_revenue
FROM ordered""",
        "m1_batch_rows": "SELECT ordered_at::DATE::VARCHAR AS batch_id, COUNT(*) AS rows FROM ordered GROUP BY 1",
        "m2_batch_revenue": """
SELECT ordered_at::DATE::VARCHAR AS batch_id, COUNT(*) AS rows, SUM(total_amount)::DECIMAL(28,2) AS revenue
FROM ordered GROUP BY 1""",
    }
    return sql | {name: _ingest(select) for name, select in ingest.items()}
