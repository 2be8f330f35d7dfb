"""From the tables ingestion loads to the raw tables staging reads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.schemas import PACKED_LINES, RAW

# Python's None where JSON has null, before the end of a field.
_PYTHON_NONE = r": None(?=[,}])"
_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _contract(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW[name].fields])


def _loaded(df: DataFrame) -> DataFrame:
    """``loaded_at`` is the batch time."""
    return df.withColumn("loaded_at", F.col("batch_id").cast("timestamp_ntz"))


def raw_products(products: DataFrame) -> DataFrame:
    keyed = _loaded(products).withColumns({"id": F.col("product_id"), "source_product_id": F.col("product_id")})
    return _contract(keyed, "raw_products")


def raw_customers(customers: DataFrame) -> DataFrame:
    keyed = _loaded(customers).withColumns({"id": F.col("customer_id"), "source_customer_id": F.col("customer_id")})
    return _contract(keyed, "raw_customers")


def order_number(code: Column) -> Column:
    """The number in an order code."""
    return F.regexp_extract(code, r"(\d+)$", 1).cast("bigint")


def raw_orders(transactions: DataFrame) -> DataFrame:
    """Statuses are lower-cased here because the models compare lower case."""
    number = order_number(F.col("order_id"))
    shaped = _loaded(transactions).withColumns(
        {
            "id": number,
            "source_order_id": number,
            "source_customer_id": F.col("customer_id"),
            "order_status": F.lower("order_status"),
            "shipping_address": F.lit(None).cast("string"),
        }
    )
    return _contract(shaped, "raw_orders")


def parse_lines(text: Column) -> Column:
    """Lines packed as JSON or as the text of a Python list; NULL where neither reads."""
    plain = F.from_json(text, PACKED_LINES, _JSON_OPTIONS)
    patched = F.from_json(F.regexp_replace(text, _PYTHON_NONE, ": null"), PACKED_LINES, _JSON_OPTIONS)
    return F.coalesce(plain, patched)


def unreadable_lines(packed: DataFrame, column: str = "items_detail") -> DataFrame:
    """Rows whose packed lines cannot be read; ``raw_order_items`` fails on them unless told to skip them."""
    return packed.filter(F.col(column).isNotNull() & parse_lines(F.col(column)).isNull())


def loaded_lines(transactions: DataFrame, parts: DataFrame | None = None) -> DataFrame:
    """Packed lines of the loaded orders: those held in the order's row, and the ``parts`` of large orders.

    Both are the tables that ``load_transactions`` writes.
    """
    stamps = ("generated_at", "batch_id", "source")
    held = transactions.filter("items_detail IS NOT NULL").select(
        order_number(F.col("order_id")).alias("order_id"), F.lit(0).alias("part"), "items_detail", *stamps
    )
    return held if parts is None else held.unionByName(parts.select(*held.columns))


def raw_order_items(packed: DataFrame, skip_unreadable: bool = False) -> DataFrame:
    """Packed lines (order_id, part, items_detail + batch columns) to one row per line.

    The item id is order, part and position.  All three follow from the lines alone, so it is the
    same on every run.  ``id`` holds the three in one number: an order above 2 to the 35, a part
    above 2 to the 14 or a position above 2 to the 14 is an error, not another line's id.
    Text that cannot be read is an error, unless ``unreadable_lines`` has reported it and it is to
    be skipped.
    """
    text = F.col("items_detail")
    lines = parse_lines(text)
    if not skip_unreadable:
        unreadable = F.raise_error(F.concat(F.lit("unreadable lines of order "), F.col("order_id").cast("string")))
        lines = F.coalesce(lines, F.when(text.isNotNull(), unreadable.cast(PACKED_LINES)))
    exploded = _loaded(packed).select("*", F.posexplode(lines).alias("position", "line"))
    within = (F.col("order_id") < 1 << 35) & (F.col("part") < 1 << 14) & (F.col("position") < 1 << 14)
    number = (F.col("order_id") * (1 << 28)) + F.col("part") * (1 << 14) + F.col("position")
    shaped = exploded.withColumns(
        {
            "id": F.when(within, number).otherwise(F.raise_error(F.lit("no id for the line")).cast("bigint")),
            "source_order_item_id": F.concat_ws(
                "-", "order_id", F.col("part").cast("string"), F.col("position").cast("string")
            ),
            "source_order_id": F.col("order_id"),
            "source_product_id": F.col("line.product_id"),
            "quantity": F.col("line.quantity"),
            "unit_price": F.col("line.unit_price"),
            "total_price": F.col("line.item_total"),
        }
    )
    return _contract(shaped, "raw_order_items")


def latest_per_key(df: DataFrame, key: str, by: str = "batch_id") -> DataFrame:
    """The row of the last batch for each key; rows without a key all stay.

    Off unless called: loads append, and duplicates are reported rather than removed.
    A grouped max of the whole row combines on the map side, so a key with very many
    copies costs one row per task, where a window would sort them in one place.
    """
    rest = [c for c in df.columns if c not in (key, by)]
    newest = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max(F.struct(by, *rest)).alias("newest"))
        .select(key, "newest.*")
    )
    return newest.select(*df.columns).unionByName(df.filter(F.col(key).isNull()))
