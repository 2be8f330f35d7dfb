"""Table profiles.  Full aggregations; only the reports that are top lists carry a limit."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.columns import quotient
from tillroll.sources.tables import shared_dir

SAMPLE_ROWS = 10
TOP_STATES = 10
LAST_PERIODS = 6
MEDIAN_BANDS = 4096

PRODUCT_SAMPLE = ("product_id", "product_name", "brand", "category", "price", "rating", "stock")
CUSTOMER_SAMPLE = ("customer_id", "first_name", "last_name", "email", "city", "state", "customer_segment")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def distinct_count(df: DataFrame, column: str) -> DataFrame:
    """Distinct values, NULL not counted."""
    return df.agg(F.countDistinct(column).alias(f"distinct_{column}"))


def first_rows(df: DataFrame, columns: tuple[str, ...], key: str) -> DataFrame:
    return df.select(*columns).orderBy(key).limit(SAMPLE_ROWS)


def share_true(df: DataFrame, column: str) -> DataFrame:
    """Rows where the flag is true, and their percentage of the rows where it is known."""
    known, true = F.count(column), F.count_if(F.col(column))
    return df.agg(
        true.alias("true_rows"),
        ((true * 100).cast("double") / F.nullif(known, F.lit(0))).alias("true_percent"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, NULL not counted; ties by value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    ordered = counted.orderBy(F.desc("rows"), column)
    return ordered if top is None else ordered.limit(top)


def counts_by_value(df: DataFrame, column: str) -> DataFrame:
    """Rows per value in the order of the values."""
    return df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows")).orderBy(column)


def counted_cents(df: DataFrame, amount: str) -> DataFrame:
    """Rows per value of a money column in cents, NULL included: (cents, rows), written once and read again.

    The plan of ``df`` runs once, whatever is then asked of the counts, and its rows combine before the shuffle.
    """
    counted = df.groupBy((F.col(amount) * 100).cast("bigint").alias("cents")).agg(F.count("*").alias("rows"))
    path = f"{shared_dir(df.sparkSession)}/cents/{uuid4().hex}"
    counted.write.parquet(path)
    return df.sparkSession.read.schema("cents long, rows long").parquet(path)


def middle(counted: DataFrame) -> tuple[int, int] | None:
    """The two middle values, which are one for an odd number of rows, of (cents, rows); None without a value.

    Both are looked for in the same descent.  A pass counts at most ``MEDIAN_BANDS`` bands of the range that holds them, with the
    least and the most value of each; the next pass divides the band that holds both.  Where they lie in two bands they are the
    most value of the one and the least of the other.  Nothing is sorted or held but the bands: two passes for a range of
    16 million cents, six for the full width of DECIMAL(18,2).
    """
    known = counted.filter(F.col("cents").isNotNull())
    total, low, high = known.agg(F.sum("rows"), F.min("cents"), F.max("cents")).first()
    if not total:
        return None
    ranks, before = ((total + 1) // 2, total // 2 + 1), 0
    while low < high:
        width = -(-(high - low + 1) // MEDIAN_BANDS)
        bands = (
            known.filter(F.col("cents").between(low, high))
            .groupBy(F.expr(f"(cents - {low}L) div {width}L").alias("band"))
            .agg(F.sum("rows").alias("rows"), F.min("cents").alias("least"), F.max("cents").alias("most"))
        )
        # For each rank, the first band up to whose end there are as many rows.
        found, reached = [], before
        for row in sorted(bands.collect()):
            found += [(row, reached) for rank in ranks[len(found) :] if rank <= reached + row["rows"]]
            reached += row["rows"]
            if len(found) == 2:
                break
        (first, before), (second, _) = found
        if first["band"] != second["band"]:
            return first["most"], second["least"]
        low, high = first["least"], first["most"]
    return low, low


def exact_median(df: DataFrame, amount: str) -> float | None:
    """Exact median of a money column, the mean of the two middle values for an even count."""
    found = middle(counted_cents(df, amount))
    return None if found is None else (found[0] / 100 + found[1] / 100) / 2


def revenue_summary(transactions: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Count, revenue, mean and exact median of the order totals, all from the counts of one pass over them."""
    counted = counted_cents(transactions, amount)
    found = middle(counted)
    median = None if found is None else (found[0] / 100 + found[1] / 100) / 2
    kind = transactions.agg(F.sum(amount).alias("revenue")).schema["revenue"].dataType
    revenue = (F.sum(F.col("cents").cast("decimal(20,0)") * F.col("rows")) / 100).cast(kind)
    known = F.sum(F.when(F.col("cents").isNotNull(), F.col("rows")))
    return counted.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("transactions"),
        revenue.alias("revenue"),
        quotient(revenue, known).alias("mean"),
    ).withColumn("median", F.lit(median).cast("double"))


def _last_periods(transactions: DataFrame, period: Column, amount: str) -> DataFrame:
    last = (
        transactions.filter(period.isNotNull())
        .groupBy(period.alias("period"))
        .agg(F.sum(amount).alias("revenue"))
        .orderBy(F.desc("period"))
        .limit(LAST_PERIODS)
    )
    return last.orderBy("period")


def revenue_by_time(transactions: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Revenue of the last order times, at the resolution they are stored in."""
    return _last_periods(transactions, F.col("order_date"), amount)


def revenue_by_month(transactions: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Revenue of the last months."""
    month = F.trunc(F.col("order_date").cast("timestamp_ntz").cast("date"), "month")
    return _last_periods(transactions, month, amount)


def survey(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per value of every column: (section, value, rows), from one scan and one shuffle.

    Each row gives its value of every column, as text, and the rows combine before the shuffle, so what is shuffled follows
    the different values.  The section ``rows`` counts all rows.
    """
    pairs = [F.struct(F.lit(c).alias("section"), F.col(c).cast("string").alias("value")) for c in columns]
    every = F.struct(F.lit("rows").alias("section"), F.lit(None).cast("string").alias("value"))
    long = df.select(F.explode(F.array(every, *pairs)).alias("pair")).select("pair.*")
    return long.groupBy("section", "value").agg(F.count("*").alias("rows"))


PRODUCT_SECTIONS = ("category", "brand")
CUSTOMER_SECTIONS = ("customer_segment", "gender", "state")
CUSTOMER_FLAGS = ("is_active", "email_verified", "marketing_opt_in")


def _surveyed(df: DataFrame, *columns: str) -> DataFrame:
    """The survey, written once and read again by every section of a report."""
    path = f"{shared_dir(df.sparkSession)}/survey/{uuid4().hex}"
    found = survey(df, columns)
    found.write.parquet(path)
    return df.sparkSession.read.schema(found.schema).parquet(path)


def _rows(found: DataFrame) -> DataFrame:
    return found.agg(F.coalesce(F.sum(F.when(F.col("section") == "rows", F.col("rows"))), F.lit(0)).alias("rows"))


def _section(found: DataFrame, column: str) -> DataFrame:
    return found.filter((F.col("section") == column) & F.col("value").isNotNull())


def _distinct(found: DataFrame, column: str) -> DataFrame:
    return _section(found, column).agg(F.count("*").alias(f"distinct_{column}"))


def _share(found: DataFrame, column: str) -> DataFrame:
    true = F.sum(F.when(F.col("value") == "true", F.col("rows")))
    known = F.sum("rows")
    return _section(found, column).agg(
        F.coalesce(true, F.lit(0)).alias("true_rows"),
        ((F.coalesce(true, F.lit(0)) * 100).cast("double") / F.nullif(known, F.lit(0))).alias("true_percent"),
    )


def _values(found: DataFrame, column: str, top: int | None = None) -> DataFrame:
    listed = _section(found, column).select(F.col("value").alias(column), "rows").orderBy(F.desc("rows"), column)
    return listed if top is None else listed.limit(top)


def product_profile(products: DataFrame) -> dict[str, DataFrame]:
    """The product report: all but the sample from one scan, which runs at once."""
    found = _surveyed(products, *PRODUCT_SECTIONS)
    return {
        "rows": _rows(found),
        "categories": _distinct(found, "category"),
        "brands": _distinct(found, "brand"),
        "sample": first_rows(products, PRODUCT_SAMPLE, "product_id"),
    }


def customer_profile(customers: DataFrame) -> dict[str, DataFrame]:
    """The customer report: all but the sample from one scan, which runs at once."""
    found = _surveyed(customers, *CUSTOMER_SECTIONS, *CUSTOMER_FLAGS)
    return {
        "rows": _rows(found),
        "active": _share(found, "is_active"),
        "email_verified": _share(found, "email_verified"),
        "marketing_opt_in": _share(found, "marketing_opt_in"),
        "segments": _values(found, "customer_segment"),
        "genders": _values(found, "gender"),
        "top_states": _values(found, "state", TOP_STATES),
        "sample": first_rows(customers, CUSTOMER_SAMPLE, "customer_id"),
    }


def transaction_profile(transactions: DataFrame) -> dict[str, DataFrame]:
    """The transaction report, one lazy frame per section."""
    return {
        "summary": revenue_summary(transactions),
        "statuses": value_counts(transactions, "order_status"),
        "payment_methods": value_counts(transactions, "payment_method"),
        "items_per_order": counts_by_value(transactions, "num_items"),
        "revenue_by_time": revenue_by_time(transactions),
        "revenue_by_month": revenue_by_month(transactions),
    }
