"""Declared column checks.  A check that passes has no failures."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.rules import NOT_NULL, UNIQUE


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Rows that lack the column."""
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with the number of rows; NULL is not a value."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return counted.filter("rows > 1")


def check_model(df: DataFrame, model: str) -> DataFrame:
    """All declared checks of one model: (model, column, test, failures).

    One scan and one shuffle, on the unique column: each group gives its size and its
    NULLs per column, counted on the map side first, so a repeated key does not pile up.
    """
    key, required = UNIQUE[model], NOT_NULL[model]
    groups = df.groupBy(F.col(key).alias("key")).agg(
        F.count("*").alias("rows"),
        *[F.expr(f"count_if({column} is null) as null_{i}") for i, column in enumerate(required)],
    )
    totals = groups.agg(
        F.expr("count_if(key is not null and rows > 1) as repeated"),
        *[F.expr(f"coalesce(sum(null_{i}), 0L) as null_{i}") for i in range(len(required))],
    )
    checks = [(c, "not_null", f"null_{i}") for i, c in enumerate(required)] + [(key, "unique", "repeated")]
    rows = ", ".join(f"struct('{c}' as column, '{test}' as test, {n} as failures)" for c, test, n in checks)
    return totals.selectExpr(f"'{model}' as model", f"inline(array({rows}))")


class ChecksFailed(ValueError):
    """Declared checks that have failures: (model, column, test, failures)."""

    def __init__(self, failed: list[tuple[str, str, str, int]]):
        self.failed = failed
        super().__init__("; ".join(f"{model}.{column} {test}: {n} failures" for model, column, test, n in failed))


def require(results: Iterable[tuple[str, str, str, int]]) -> None:
    """An error that names every check with failures."""
    if failed := [tuple(r) for r in results if r[3]]:
        raise ChecksFailed(failed)


def suite(models: Mapping[str, DataFrame]) -> DataFrame:
    """Every declared check of the given models."""
    return reduce(DataFrame.unionAll, [check_model(df, name) for name, df in models.items()])
