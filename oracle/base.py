"""Raw, staged and transformed tables as DuckDB common table expressions.

Money runs in whole cents and ratios in integer arithmetic, rounded half up by hand, so
no floating-point division decides a digit.
"""

from __future__ import annotations

from tillroll import rules

AS_OF = "DATE '2024-07-01'"


def case(branches, otherwise: str) -> str:
    """CASE over (condition, text) pairs."""
    body = " ".join(f"WHEN {condition} THEN '{label}'" for condition, label in branches)
    return f"CASE {body} ELSE '{otherwise}' END"


def bands(value: str, rule: rules.Ladder) -> str:
    return case([(f"{value} {sign} {bound}", label) for sign, bound, label in rule.steps], rule.otherwise)


def listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def members(value: str, rule: rules.Groups) -> str:
    return case([(f"{value} IN {listed(group)}", label) for group, label in rule.groups], rule.otherwise)


def cycle(number: str, *values: str | None) -> str:
    """The value at ``number`` modulo the count of values."""
    body = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values)
    )
    return f"CASE ({number}) % {len(values)} {body} END"


def cents(column: str) -> str:
    return f"CAST({column} * 100 AS HUGEINT)"


def amount(whole: str, places: int = 2, width: int = 18) -> str:
    """An integer count of 10^-places as a decimal."""
    unit = "0." + "0" * (places - 1) + "1"
    return f"CAST(CAST({whole} AS DECIMAL(20,0)) * CAST('{unit}' AS DECIMAL({places + 1},{places})) AS DECIMAL({width},{places}))"


def divided(numerator: str, denominator: str, scale: int) -> str:
    """numerator * scale / denominator in integers, half up; both at or above zero."""
    return (
        f"(CASE WHEN ({denominator}) <> 0 THEN "
        f"(2 * CAST(({numerator}) AS HUGEINT) * {scale} + ({denominator})) // (2 * ({denominator})) END)"
    )


def ratio8(numerator_cents: str, denominator: str) -> str:
    """Cents over a whole number, as a decimal with 8 places."""
    return amount(divided(numerator_cents, denominator, 1_000_000), 8)


def percentage(part_cents: str, whole_cents: str) -> str:
    """Ratio at 8 places first, then the percentage at 2 places."""
    return amount(f"({divided(part_cents, whole_cents, 100_000_000)} + 5000) // 10000")


META = (
    "TIMESTAMP '2024-06-30 00:00:00' AS generated_at, TIMESTAMP '2024-06-30 01:00:00' AS loaded_at, "
    "'2024-06-30T01:00:00' AS batch_id, 'test_tables' AS source"
)
STAGED_META = "generated_at, loaded_at, batch_id, source AS source_system"
METHODS = ("Credit Card", "Debit Card", "PayPal", "Apple Pay", "Google Pay")
ORDER_TIME = "o_orderdate + to_days(CAST(o_orderkey % 7 AS INTEGER)) + to_minutes(o_orderkey * 37 % 1440)"
LINE_CENTS = "((l_partkey * 7919) % 80000 + 100) * (115 - 5 * l_linenumber) // 100"
LINE_QUANTITY = "CASE WHEN l_quantity = 50 THEN 0 ELSE CAST(l_quantity AS INTEGER) % 14 + 1 END"

CTES: dict[str, str] = {}

CTES["raw_products"] = f"""
SELECT p_partkey AS id, p_partkey AS source_product_id, p_name AS product_name, p_brand AS brand,
  p_type AS category, p_brand || ' ' || p_type || ' ' || p_name AS description,
  ((p_partkey * 7919) % 80000 + 100) / 100.0::DOUBLE AS price,
  CAST(CASE p_partkey % 5 WHEN 0 THEN 0 ELSE p_size + p_partkey % 20 END AS DOUBLE) AS discount_percentage,
  CAST(CASE p_partkey % 13 WHEN 0 THEN 0 ELSE p_partkey % 90 END AS INTEGER) AS stock,
  CASE p_partkey % 7 WHEN 0 THEN 'Low Stock' ELSE 'In Stock' END AS availability_status,
  CAST(1 + p_partkey % 8 AS INTEGER) AS minimum_order_qty,
  (p_partkey % 46 + 5) / 10.0::DOUBLE AS rating,
  (p_partkey % 700 * 5) / 100.0::DOUBLE AS weight, CAST(p_partkey % 31 AS DOUBLE) AS width,
  CAST(p_partkey % 37 AS DOUBLE) AS height, CAST(p_partkey % 41 AS DOUBLE) AS depth,
  {cycle("p_partkey", "1 year warranty", "No warranty", None)} AS warranty_info,
  {cycle("p_partkey", "Ships in 1 week", "Ships overnight")} AS shipping_info,
  {cycle("p_partkey", "30 days return policy", "No return policy", "7 days return policy", None)} AS return_policy,
  lpad(p_partkey::VARCHAR, 12, '0') AS barcode, 'qr-' || p_partkey AS qr_code,
  'thumb-' || p_partkey AS thumbnail, {META}
FROM part"""

CTES["raw_customers"] = f"""
SELECT c_custkey AS id, c_custkey AS source_customer_id, c_name AS first_name,
  CASE c_custkey % 50 WHEN 0 THEN NULL ELSE c_mktsegment END AS last_name,
  CASE c_custkey % 97 WHEN 0 THEN NULL ELSE 'c' || c_custkey || '@example.com' END AS email,
  '555-' || lpad(c_custkey::VARCHAR, 7, '0') AS phone,
  DATE '2010-01-01' - CAST(c_custkey * 53 % 26000 AS INTEGER) AS date_of_birth,
  {cycle("c_custkey", "Male", "Female", "Other", None)} AS gender,
  c_custkey || ' Main Street' AS street_address, 'City ' || c_custkey % 40 AS city,
  'S' || c_nationkey AS state, lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS zip_code,
  'Country ' || c_nationkey AS country,
  CAST(DATE '2024-06-30' - CAST(c_custkey * c_custkey % 1600 AS INTEGER) AS TIMESTAMP)
    + to_minutes(c_custkey * 31 % 1440) AS registration_date,
  CASE c_custkey % 17 WHEN 0 THEN NULL ELSE
    CAST(DATE '2024-06-30' - CAST(c_custkey * 7 % 400 AS INTEGER) AS TIMESTAMP)
    + to_minutes(c_custkey * 31 % 1440) END AS last_login,
  CASE c_custkey % 29 WHEN 0 THEN NULL ELSE c_custkey % 10 < 7 END AS is_active,
  CASE c_custkey % 19 WHEN 0 THEN NULL ELSE c_custkey % 2 = 0 END AS email_verified,
  CASE c_custkey % 23 WHEN 0 THEN NULL ELSE c_custkey % 3 = 0 END AS phone_verified,
  c_custkey % 5 < 3 AS marketing_opt_in,
  {cycle("c_custkey", "Email", "Phone", "SMS", "None")} AS preferred_contact_method,
  c_mktsegment AS customer_segment, {META}
FROM customer"""

CTES["line_cents"] = f"""
SELECT *, {LINE_CENTS} AS unit_cents, {LINE_QUANTITY} AS quantity FROM lineitem"""

CTES["raw_order_items"] = f"""
SELECT l_orderkey * 10 + l_linenumber AS id,
  l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS source_order_item_id,
  l_orderkey AS source_order_id,
  CASE l_orderkey % 101 WHEN 0 THEN l_partkey + 10000000 ELSE l_partkey END AS source_product_id,
  quantity, unit_cents / 100.0::DOUBLE AS unit_price, unit_cents * quantity / 100.0::DOUBLE AS total_price, {META}
FROM line_cents"""

CTES["raw_orders"] = f"""
SELECT o_orderkey AS id, o_orderkey AS source_order_id, o_custkey AS source_customer_id,
  {ORDER_TIME} AS order_date,
  {cycle("o_orderkey", "completed", "delivered", "processing", "shipped", "pending",
         "payment_pending", "cancelled", "refunded", "on_hold")} AS order_status,
  CASE WHEN o_orderkey % 3 = 0 AND line_total IS NOT NULL THEN line_total
    ELSE CAST(round(o_totalprice * 100) AS BIGINT) // 500 END / 100.0::DOUBLE AS total_amount,
  {cycle("o_orderkey", *METHODS)} AS payment_method, 'Dock ' || o_custkey % 1000 AS shipping_address, {META}
FROM orders LEFT JOIN (
  SELECT l_orderkey, SUM(unit_cents * quantity)::BIGINT AS line_total FROM line_cents GROUP BY l_orderkey
) ON l_orderkey = o_orderkey"""

CTES["event_orders"] = """
SELECT *, CASE WHEN event_id % 97 = 0 THEN event_id + 10000000 WHEN event_id % 3 = 0 THEN event_id
  ELSE event_id // 4 END AS order_key FROM events"""

CTES["raw_transactions"] = f"""
SELECT event_id AS id, event_id AS source_transaction_id, order_key AS source_order_id,
  CASE WHEN event_type = 'error' THEN 'refund' WHEN event_id % 11 = 0 THEN 'adjustment' ELSE 'payment' END
    AS transaction_type,
  {cycle("event_id", "failed", "declined", "pending", "processing", "voided", "approved", "approved")}
    AS transaction_status,
  CASE WHEN o_orderkey IS NULL THEN ts ELSE {ORDER_TIME} + to_minutes(
    CASE event_id % 5 WHEN 0 THEN event_id % 6 WHEN 1 THEN 6 + event_id % 55 WHEN 2 THEN 61 + event_id % 1300
      WHEN 3 THEN 1600 + event_id % 8000 ELSE 12000 + event_id % 5000 END) END AS transaction_date,
  round(value * 200) / 100.0::DOUBLE AS amount, {cycle("event_id", *METHODS)} AS payment_method,
  {cycle("event_id", "north", "south", "east")} AS processor_name,
  'tx-' || event_id AS processor_transaction_id, lpad((event_id % 10000)::VARCHAR, 4, '0') AS card_last_four, {META}
FROM event_orders LEFT JOIN orders ON o_orderkey = order_key"""

CTES["stg_customers"] = """
SELECT * EXCLUDE (source), source AS source_system, first_name || ' ' || last_name AS full_name FROM raw_customers"""

CTES["stg_products"] = f"""
SELECT * EXCLUDE (source, stock, minimum_order_qty, thumbnail, price, discount_percentage, rating, weight,
    width, height, depth),
  source AS source_system, stock AS stock_quantity, minimum_order_qty AS minimum_order_quantity,
  thumbnail AS thumbnail_url, price::DECIMAL(10,2) AS price,
  discount_percentage::DECIMAL(10,2) AS discount_percentage, rating::DECIMAL(3,2) AS rating,
  weight::DECIMAL(10,2) AS weight, width::DECIMAL(10,2) AS width, height::DECIMAL(10,2) AS height,
  depth::DECIMAL(10,2) AS depth,
  IF(contains(upper(return_policy), '{rules.NO_RETURN_MARK}'), 0,
     TRY_CAST(regexp_replace(return_policy, '{rules.NON_DIGITS}', '', 'g') AS INTEGER)) AS return_policy_days_clean
FROM raw_products"""

CTES["stg_orders"] = """
SELECT * EXCLUDE (source, total_amount), total_amount::DECIMAL(10,2) AS total_amount, source AS source_system
FROM raw_orders"""

CTES["stg_order_items"] = """
SELECT * EXCLUDE (source, unit_price, total_price), unit_price::DECIMAL(10,2) AS unit_price,
  total_price::DECIMAL(10,2) AS total_price, source AS source_system
FROM raw_order_items"""

CTES["stg_transactions"] = """
SELECT * EXCLUDE (source, amount, processor_name), amount::DECIMAL(10,2) AS transaction_amount,
  processor_name AS payment_processor, source AS source_system
FROM raw_transactions"""

_TENURE = case(
    [(f"days_since_registration {sign} {n}", label) for sign, n, label in rules.TENURE_BY_DAYS]
    + [(f"years_since_registration {sign} {n}", label) for sign, n, label in rules.TENURE_BY_YEARS.steps],
    rules.TENURE_BY_YEARS.otherwise,
)
_LOGIN = f"IF(last_login IS NULL, '{rules.NEVER_LOGGED_IN}', {bands('days_since_last_login', rules.ACTIVITY)})"

CTES["transform_customers"] = f"""
SELECT *, {bands("age", rules.AGE_GROUP)} AS age_group, {_TENURE} AS customer_tenure, {_LOGIN} AS activity_status,
  {case([("email_verified AND phone_verified", rules.VERIFIED_BOTH),
         ("email_verified OR phone_verified", rules.VERIFIED_ONE)], rules.VERIFIED_NONE)} AS verification_status,
  COALESCE(email_verified AND phone_verified, FALSE) AS is_fully_verified
FROM (
  SELECT *, date_diff('year', date_of_birth, {AS_OF})::INTEGER AS age,
    date_diff('day', registration_date, {AS_OF}::TIMESTAMP)::INTEGER AS days_since_registration,
    date_diff('month', registration_date, {AS_OF}::TIMESTAMP)::INTEGER AS months_since_registration,
    date_diff('year', registration_date, {AS_OF}::TIMESTAMP)::INTEGER AS years_since_registration,
    date_diff('day', last_login, {AS_OF}::TIMESTAMP)::INTEGER AS days_since_last_login
  FROM stg_customers)"""

CTES["transform_products"] = f"""
SELECT *, {bands("discounted_price", rules.PRICE_TIER)} AS price_category
FROM (
  SELECT * EXCLUDE (id, return_policy_days_clean),
    {amount(f"({cents('price')} * (10000 - {cents('discount_percentage')}) * 2 + 10000) // 20000")} AS discounted_price,
    {amount(f"({cents('price')} * {cents('discount_percentage')} * 2 + 10000) // 20000")} AS discount_amount,
    {bands("rating", rules.RATING_CATEGORY)} AS rating_category,
    {bands("stock_quantity", rules.STOCK_LEVEL)} AS stock_level,
    COALESCE(discount_percentage > 0, FALSE) AS is_on_sale,
    {bands("discount_percentage", rules.DISCOUNT_CATEGORY)} AS discount_category,
    COALESCE(stock_quantity > 0 AND availability_status = '{rules.IN_STOCK}', FALSE) AS is_available
  FROM stg_products)"""

CTES["item_totals"] = f"""
SELECT source_order_id, COUNT(*) AS item_count, SUM(quantity)::BIGINT AS total_items_quantity,
  SUM(total_price)::DECIMAL(20,2) AS calculated_order_total,
  {ratio8(f"SUM({cents('unit_price')})", "COUNT(unit_price)")} AS avg_item_price,
  MAX(unit_price) AS max_item_price, MIN(unit_price) AS min_item_price
FROM stg_order_items GROUP BY source_order_id"""

_TYPED = "COALESCE(SUM(transaction_amount) FILTER (transaction_type = '{}'), 0)"

CTES["transaction_totals"] = f"""
SELECT source_order_id, COUNT(*) AS transaction_count,
  {_TYPED.format(rules.PAYMENT)}::DECIMAL(20,2) AS total_payments,
  {_TYPED.format(rules.REFUND)}::DECIMAL(20,2) AS total_refunds,
  ({_TYPED.format(rules.PAYMENT)} - {_TYPED.format(rules.REFUND)})::DECIMAL(20,2) AS net_transaction_amount,
  COUNT(*) FILTER (transaction_type = '{rules.PAYMENT}') AS payment_count,
  COUNT(*) FILTER (transaction_type = '{rules.REFUND}') AS refund_count,
  {", ".join(f"COUNT(*) FILTER (transaction_status = '{s}') AS {s}_transaction_count" for s in rules.STATUS_COUNTS)}
FROM stg_transactions GROUP BY source_order_id"""

_COUNTS = ("transaction_count", "payment_count", "refund_count",
           *(f"{s}_transaction_count" for s in rules.STATUS_COUNTS))
_SUMS = ("total_payments", "total_refunds", "net_transaction_amount")
_FILLED = ", ".join(
    [f"COALESCE({c}, 0) AS {c}" for c in ("item_count", "total_items_quantity", *_COUNTS)]
    + [f"COALESCE({c}, 0)::DECIMAL(18,8) AS {c}" for c in ("avg_item_price",)]
    + [f"COALESCE({c}, 0)::DECIMAL(10,2) AS {c}" for c in ("max_item_price", "min_item_price")]
    + [f"COALESCE({c}, 0)::DECIMAL(20,2) AS {c}" for c in _SUMS]
)
_ORDER_FAILED = "failed_transaction_count + declined_transaction_count > 0"
_PAYMENT_STATUS = case(
    [
        ("approved_transaction_count > 0", rules.PAID),
        ("pending_transaction_count + processing_transaction_count > 0", rules.PAYMENT_PENDING),
        (_ORDER_FAILED, rules.PAYMENT_FAILED),
    ],
    rules.NO_PAYMENT,
)

CTES["transform_orders"] = f"""
SELECT *, COALESCE(amount_variance > {rules.DISCREPANCY_TOLERANCE}, FALSE) AS has_amount_discrepancy,
  IF(day_of_week IN {rules.WEEKEND_DAYS}, '{rules.WEEKEND}', '{rules.WEEKDAY}') AS weekday_weekend
FROM (
  SELECT o.* EXCLUDE (id), calculated_order_total,
    ABS(total_amount - COALESCE(calculated_order_total, 0)) AS amount_variance, {_FILLED},
    {members("order_status", rules.ORDER_STATUS_CATEGORY)} AS order_status_category,
    COALESCE(order_status IN {listed(rules.FULFILLED)}, FALSE) AS is_fulfilled,
    COALESCE(order_status IN {listed(rules.TERMINATED)}, FALSE) AS is_terminated,
    {bands("total_amount", rules.AMOUNT_SIZE)} AS order_size,
    {bands("COALESCE(i.item_count, 0)", rules.ORDER_COMPLEXITY)} AS order_complexity,
    COALESCE(t.transaction_count > 1, FALSE) AS has_multiple_transactions,
    COALESCE(t.refund_count > 0, FALSE) AS has_refunds,
    COALESCE(t.{_ORDER_FAILED}, FALSE) AS has_failed_transactions,
    {_PAYMENT_STATUS} AS payment_status,
    date_diff('day', order_date, {AS_OF}::TIMESTAMP)::INTEGER AS days_since_order,
    date_diff('hour', order_date, {AS_OF}::TIMESTAMP) AS hours_since_order,
    date_trunc('month', order_date) AS order_month, date_trunc('week', order_date) AS order_week,
    dayofweek(order_date)::INTEGER AS day_of_week, hour(order_date)::INTEGER AS hour_of_day
  FROM stg_orders o
  LEFT JOIN item_totals i ON i.source_order_id = o.source_order_id
  LEFT JOIN transaction_totals t ON t.source_order_id = o.source_order_id)"""

CTES["transform_order_items"] = f"""
SELECT * EXCLUDE (minimum_order_quantity),
  {ratio8(cents("total_price"), "quantity")} AS calculated_unit_price,
  (current_product_price - unit_price)::DECIMAL(11,2) AS discount_vs_current_price,
  COALESCE(IF(current_product_price > unit_price,
    {percentage(f"{cents('current_product_price')} - {cents('unit_price')}", cents("current_product_price"))}, 0), 0)
    ::DECIMAL(18,2) AS discount_percentage_vs_current,
  COALESCE(current_product_price > unit_price, FALSE) AS was_discounted, total_price AS item_revenue,
  {percentage(cents("total_price"), cents("order_total_amount"))} AS percent_of_order_total,
  {bands("quantity", rules.QUANTITY_CATEGORY)} AS quantity_category,
  {bands("unit_price", rules.PRICE_TIER)} AS price_tier,
  COALESCE(quantity > minimum_order_quantity, FALSE) AS exceeds_minimum_order,
  date_trunc('month', order_date) AS order_month, date_trunc('week', order_date) AS order_week
FROM (
  SELECT l.* EXCLUDE (id), o.source_customer_id, o.order_date, o.order_status, o.order_status_category,
    o.total_amount AS order_total_amount, p.product_name, p.brand, p.category, p.price AS current_product_price,
    p.minimum_order_quantity
  FROM stg_order_items l
  LEFT JOIN transform_products p ON p.source_product_id = l.source_product_id
  LEFT JOIN transform_orders o ON o.source_order_id = l.source_order_id)"""

_TIMING = case(
    [(f"{unit}s_from_order_to_transaction <= {most}", label) for unit, most, label in rules.TIMING],
    rules.TIMING_OTHERWISE,
)

CTES["transform_transactions"] = f"""
SELECT *, {_TIMING} AS transaction_timing
FROM (
  SELECT t.* EXCLUDE (id), o.source_customer_id, o.order_date, o.order_status, o.total_amount AS order_total_amount,
    {members("transaction_status", rules.TRANSACTION_STATUS_CATEGORY)} AS transaction_status_category,
    COALESCE(transaction_status = '{rules.APPROVED}', FALSE) AS is_successful,
    COALESCE(transaction_status IN {listed(rules.FAILED_STATUSES)}, FALSE) AS is_failed,
    COALESCE(transaction_type = '{rules.PAYMENT}', FALSE) AS is_payment,
    COALESCE(transaction_type = '{rules.REFUND}', FALSE) AS is_refund,
    IF(transaction_type = '{rules.REFUND}', -ABS(transaction_amount), transaction_amount) AS signed_amount,
    {", ".join(f"date_diff('{u}', order_date, transaction_date)::{t} AS {u}s_from_order_to_transaction"
               for u, t in (("minute", "BIGINT"), ("hour", "BIGINT"), ("day", "INTEGER")))},
    date_trunc('month', transaction_date) AS transaction_month,
    date_trunc('week', transaction_date) AS transaction_week,
    dayofweek(transaction_date)::INTEGER AS day_of_week, hour(transaction_date)::INTEGER AS hour_of_day,
    {bands("transaction_amount", rules.AMOUNT_SIZE)} AS transaction_size
  FROM stg_transactions t LEFT JOIN transform_orders o ON o.source_order_id = t.source_order_id)"""


def with_tables(select: str, tables: dict[str, str] = CTES) -> str:
    """A full statement: every table in scope of ``select``."""
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in tables.items()) + "\n" + select
