"""Ingestion transforms: product documents, customer segments, and pricing of baskets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.functions.columns import MONEY, ladder, money
from tillroll.functions.dates import elapsed_days, iso_text, moment
from tillroll.operators.joins import Hot, join
from tillroll.rules import CUSTOMER_SEGMENT, FREE_SHIPPING_ABOVE, ORDER_CODE_FORMAT, SHIPPING_FEE, TAX_RATE

MAX_PACKED_LINES = 1000


def flatten_products(documents: DataFrame) -> DataFrame:
    """One row per product of the landed documents; nested facts lifted to columns.

    A missing price, discount, rating or stock counts as 0; other missing facts are NULL.
    """
    p = documents.select(F.explode("products").alias("p"))

    def number(field: str, kind: str):
        return F.coalesce(F.col(f"p.{field}"), F.lit(0)).cast(kind)

    return p.select(
        F.col("p.id").alias("product_id"),
        F.col("p.title").alias("product_name"),
        "p.brand",
        "p.category",
        number("price", "double").alias("price"),
        number("discountPercentage", "double").alias("discount_percentage"),
        number("rating", "double").alias("rating"),
        number("stock", "int").alias("stock"),
        "p.description",
        "p.thumbnail",
        "p.weight",
        "p.dimensions.width",
        "p.dimensions.height",
        "p.dimensions.depth",
        F.col("p.warrantyInformation").alias("warranty_info"),
        F.col("p.shippingInformation").alias("shipping_info"),
        F.col("p.availabilityStatus").alias("availability_status"),
        F.col("p.returnPolicy").alias("return_policy"),
        F.col("p.minimumOrderQuantity").alias("minimum_order_qty"),
        "p.meta.barcode",
        F.col("p.meta.qrCode").alias("qr_code"),
    )


def with_segment(customers: DataFrame, as_of: datetime, registered: str = "registration_date") -> DataFrame:
    """Segment by whole 24-hour days since registration."""
    days = elapsed_days(F.col(registered).cast("timestamp_ntz"), moment(as_of))
    return customers.withColumn("customer_segment", ladder(days, CUSTOMER_SEGMENT))


def active_customers(customers: DataFrame) -> DataFrame:
    """Ids of customers known to be active."""
    return customers.filter("is_active").select("customer_id")


def priced_lines(lines: DataFrame, products: DataFrame, hot: Hot | None = None) -> DataFrame:
    """Lines with the name and price of their product.

    A line whose product is not in the catalogue is an error when its price is read: an order
    is never priced from part of its lines.  The measured size of the catalogue decides between
    broadcast and sort-merge; ``hot`` products spread over tasks in the second case.
    """
    catalogue = products.select(
        "product_id", "product_name", money(F.col("price")).alias("list_price"), F.lit(True).alias("listed")
    )
    unknown = F.raise_error(F.concat(F.lit("no such product: "), F.coalesce(F.col("product_id").cast("string"), F.lit("NULL"))))
    price = F.when(F.col("listed"), F.col("list_price")).otherwise(unknown.cast(MONEY))
    return (
        join(lines, [catalogue], "product_id", hot, ["order_id", "quantity"])
        .withColumn("unit_price", price)
        .withColumn("item_total", (F.col("unit_price") * F.col("quantity")).cast(MONEY))
        .drop("list_price", "listed")
    )


def _charged(subtotals: DataFrame) -> DataFrame:
    """Tax, shipping and total of (order_id, subtotal, num_items)."""
    subtotal = F.col("subtotal")
    return subtotals.withColumns(
        {
            "tax": F.round(subtotal * F.lit(TAX_RATE), 2).cast("decimal(18,2)"),
            # An order of exactly the limit still pays.
            "shipping_cost": F.when(subtotal > F.lit(FREE_SHIPPING_ABOVE), F.lit(0))
            .otherwise(F.lit(SHIPPING_FEE))
            .cast(MONEY),
        }
    ).withColumn("total_amount", (subtotal + F.col("tax") + F.col("shipping_cost")).cast("decimal(18,2)"))


def price_orders(priced: DataFrame) -> DataFrame:
    """Subtotal, tax, shipping, total and line count of each order."""
    return _charged(
        priced.groupBy("order_id").agg(
            F.sum("item_total").cast("decimal(18,2)").alias("subtotal"), F.count("*").alias("num_items")
        )
    )


CONTENT = ("product_id", "product_name", "quantity", "unit_price", "item_total")


def pack_lines(priced: DataFrame, max_lines: int = MAX_PACKED_LINES, hot: Hot | None = None) -> DataFrame:
    """Lines of each order as JSON text: (order_id, part, parts, items_detail); see ``priced_parts``."""
    return priced_parts(priced, max_lines, hot).select("order_id", "part", "parts", "items_detail")


def priced_parts(priced: DataFrame, max_lines: int = MAX_PACKED_LINES, hot: Hot | None = None) -> DataFrame:
    """Packed lines with what they come to: (order_id, part, parts, items_detail, part_total, part_lines).

    An order of at most ``max_lines`` lines is one row with part 0.  A larger one is cut
    into parts of at most ``max_lines``, so no array grows with an order; every line is in
    exactly one part.  The lines of an order meet in one task, sorted, and their running number
    tells the part: one shuffle, and no more memory than a part takes.  The lines of ``hot`` orders
    are dealt to tasks and parts by what they hold instead.
    """
    if not hot:
        return _packed(_numbered(priced, max_lines))
    named = [v for v in hot if v is not None]
    is_hot = F.coalesce(F.col("order_id").isin(named), F.lit(False)) if named else F.lit(False)
    is_hot = is_hot | F.col("order_id").isNull() if None in hot else is_hot
    rest = _numbered(priced.filter(~is_hot), max_lines)
    return _packed(rest).unionByName(_packed(_dealt(priced.filter(is_hot), max_lines)))


def _numbered(priced: DataFrame, max_lines: int) -> DataFrame:
    """Lines with the part that their number in the order gives them."""
    inside = Window.partitionBy("order_id")
    number, lines = F.row_number().over(inside.orderBy(*CONTENT)), F.count("*").over(inside)
    return priced.select(
        "order_id",
        *CONTENT,
        ((number - 1) / max_lines).cast("int").alias("part"),
        F.ceil(lines / max_lines).cast("int").alias("parts"),
        F.lit(1).alias("held"),
    )


def _dealt(priced: DataFrame, max_lines: int) -> DataFrame:
    """Lines of hot orders with a part that follows from the line, so that no task meets a whole order.

    Equal lines are counted first and dealt out in blocks.  The part follows from the line and the number of its
    block alone, so it is the same however the lines are read, and copies of one line spread too; parts hold
    about ``max_lines``.
    """
    equal = priced.groupBy("order_id", *CONTENT).agg(F.count("*").alias("copies"))
    sizes = equal.groupBy("order_id").agg(F.ceil(F.sum("copies") / max_lines).cast("int").alias("parts"))
    most = max(1, max_lines // 10)
    # A row per hot order, of which there are a bounded number.
    cut = equal.join(F.broadcast(sizes), equal["order_id"].eqNullSafe(sizes["order_id"])).drop(sizes["order_id"])
    blocks = cut.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {most}"))).alias("block"))
    return blocks.select(
        "order_id",
        *CONTENT,
        F.pmod(F.xxhash64(*CONTENT, "block"), F.col("parts")).cast("int").alias("part"),
        "parts",
        F.least(F.lit(most), F.col("copies") - F.col("block") * most).cast("int").alias("held"),
    )


def _packed(cut: DataFrame) -> DataFrame:
    """Parts of lines that know their part and how often they are held."""
    held = F.array_repeat(F.struct(*CONTENT), F.col("held"))
    return (
        cut.groupBy("order_id", "part", "parts")
        .agg(
            F.array_sort(F.flatten(F.collect_list(held))).alias("lines"),
            F.sum(F.col("item_total") * F.col("held")).cast("decimal(18,2)").alias("part_total"),
            F.sum("held").alias("part_lines"),
        )
        .select("order_id", "part", "parts", F.to_json("lines").alias("items_detail"), "part_total", "part_lines")
    )


_FIRST = ("subtotal", "tax", "shipping_cost", "total_amount", "num_items")
_LAST = ("payment_method", "shipping_method")


def ordered_transactions(headers: DataFrame, priced: DataFrame, hot_headers: Hot | None = None) -> DataFrame:
    """Order headers with their priced totals, as loaded, without the packed lines.

    An order without lines is not an order here.
    """
    return _as_loaded(headers, price_orders(priced), hot_headers)


def _as_loaded(headers: DataFrame, totals: DataFrame, hot_headers: Hot | None) -> DataFrame:
    """Headers joined with the totals of their orders; what else the totals hold follows the number of lines."""
    ordered = join(headers, [totals], "order_id", hot_headers, ["customer_id"], "inner")
    return ordered.select(
        F.col("order_id").alias("transaction_id"),
        F.format_string(ORDER_CODE_FORMAT, "order_id").alias("order_id"),
        "customer_id",
        iso_text(F.col("ordered_at")).alias("order_date"),
        "order_status",
        *_FIRST,
        *[c for c in totals.columns if c not in ("order_id", *_FIRST)],
        *_LAST,
    )


def assemble_transactions(
    headers: DataFrame, priced: DataFrame, hot_lines: Hot | None = None, hot_headers: Hot | None = None
) -> DataFrame:
    """Orders as loaded to the source layer, with their packed lines where one text holds them.

    ``items_parts`` tells into how many parts the lines are cut; where there are more than one,
    ``items_detail`` is NULL and ``large_order_parts`` has the lines.  Pricing and packing share the shuffle of the lines.
    """
    return packed_transactions(headers, priced_parts(priced, hot=hot_lines), hot_headers)


def packed_transactions(headers: DataFrame, packed: DataFrame, hot_headers: Hot | None = None) -> DataFrame:
    """``assemble_transactions`` from lines that ``priced_parts`` has packed."""
    whole = packed.groupBy("order_id").agg(
        F.sum("part_total").cast("decimal(18,2)").alias("subtotal"),
        F.sum("part_lines").alias("num_items"),
        F.max(F.when(F.col("parts") == 1, F.col("items_detail"))).alias("items_detail"),
        F.max("parts").alias("items_parts"),
    )
    return _as_loaded(headers, _charged(whole), hot_headers)


def large_order_parts(priced: DataFrame, hot_lines: Hot | None = None) -> DataFrame:
    """All parts of the orders that one text does not hold: (order_id, part, parts, items_detail)."""
    return pack_lines(priced, hot=hot_lines).filter("parts > 1")
