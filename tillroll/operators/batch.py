"""Per-batch metrics and the slice of one day."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillroll.functions.dates import midnight


class EmptyBatch(ValueError):
    """A batch that must hold rows has none."""


def observed(df: DataFrame, revenue: str | None = None) -> tuple[DataFrame, Observation]:
    """The frame and an observation of its rows (and revenue), filled by the next action."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if revenue:
        metrics.append(F.sum(revenue).alias("revenue"))
    return df.observe(seen, *metrics), seen


def run_metrics(seen: Observation, run_at: datetime, allow_empty: bool = True) -> dict:
    """Metrics of a finished batch; an empty one is an error where rows are required."""
    metrics = {"run_at": run_at.isoformat(), **seen.get}
    if not allow_empty and not metrics["rows"]:
        raise EmptyBatch("the batch holds no rows")
    return metrics


def batch_metrics(df: DataFrame, by: str = "batch_id", revenue: str | None = None) -> DataFrame:
    """Rows (and revenue) of every batch in a loaded table."""
    metrics = [F.count("*").alias("rows")]
    if revenue:
        metrics.append(F.sum(revenue).alias("revenue"))
    return df.groupBy(by).agg(*metrics)


def day_slice(df: DataFrame, as_of: date, column: str = "order_date", period: str | None = None) -> DataFrame:
    """Rows of the day before ``as_of``, as a range that Parquet can skip by.

    ``period`` is that of the folders (day, month or year) where ``tables.write_by_period`` has written the rows; only the one
    that holds the day is read then.
    """
    before = as_of - timedelta(days=1)
    start, end = midnight(before), midnight(as_of)
    within = (F.col(column) >= start) & (F.col(column) < end)
    if period is None:
        return df.filter(within)
    folder = {"day": before, "month": before.replace(day=1), "year": before.replace(month=1, day=1)}[period]
    return df.filter(within & (F.col(period) == F.lit(folder)))
