"""The ten models in dependency order, lazily or as written tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from tillroll.operators import customers, order_items, orders, products, quality, transactions
from tillroll.operators.joins import Hot, hot_keys
from tillroll.operators.staging import STAGES
from tillroll.sources.tables import Version, discard, switch, write_version

ORDER_KEY = "source_order_id"
PRODUCT_KEY = "source_product_id"

STAGED = tuple(STAGES)
TRANSFORMED = (
    "transform_customers",
    "transform_products",
    "transform_orders",
    "transform_order_items",
    "transform_transactions",
)


class Retail:
    """Staged and transformed models over the five raw tables.

    ``raw`` gives a raw table by name.  Every model is a lazy frame; only the search for
    hot join keys runs at once, over one key column, when a joined model is first asked for.
    ``keep`` may replace each finished model, for instance by a written copy of it.
    """

    def __init__(
        self,
        raw: Callable[[str], DataFrame],
        as_of: date,
        find_hot: Callable[..., tuple[Hot, ...]] = hot_keys,
        keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
    ) -> None:
        self._raw, self._as_of, self._find_hot, self._keep = raw, as_of, find_hot, keep
        self._models: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._models:
            self._models[name] = self._keep(name, self._build(name))
        return self._models[name]

    @cached_property
    def hot_orders(self) -> Hot:
        return self._find_hot(self["stg_orders"], ORDER_KEY)[0]

    @cached_property
    def hot_in_items(self) -> tuple[Hot, Hot]:
        """Hot products and hot orders among the order lines."""
        return self._find_hot(self["stg_order_items"], PRODUCT_KEY, ORDER_KEY)

    @cached_property
    def hot_in_transactions(self) -> Hot:
        return self._find_hot(self["stg_transactions"], ORDER_KEY)[0]

    def _build(self, name: str) -> DataFrame:
        if name in STAGES:
            raw_name, stage = STAGES[name]
            return stage(self._raw(raw_name))
        if name == "transform_customers":
            return customers.customers(self["stg_customers"], self._as_of)
        if name == "transform_products":
            return products.products(self["stg_products"])
        if name == "transform_orders":
            return orders.orders(
                self["stg_orders"],
                self["stg_order_items"],
                self["stg_transactions"],
                self._as_of,
                self.hot_orders,
            )
        if name == "transform_order_items":
            return order_items.order_items(
                self["stg_order_items"],
                self["transform_products"],
                self["transform_orders"],
                *self.hot_in_items,
            )
        if name == "transform_transactions":
            return transactions.transactions(
                self["stg_transactions"], self["transform_orders"], self.hot_in_transactions
            )
        raise KeyError(name)

    def all(self) -> Mapping[str, DataFrame]:
        return {name: self[name] for name in (*STAGED, *TRANSFORMED)}


# Staged tables that later models group or join by order.
BY_ORDER = ("stg_orders", "stg_order_items", "stg_transactions")


CHECKED = "model string, column string, test string, failures long"


def refresh(
    spark: SparkSession,
    raw: Callable[[str], DataFrame],
    as_of: date | None = None,
    buckets: int = 0,
    find_hot: Callable[..., tuple[Hot, ...]] = hot_keys,
    gate: bool = True,
) -> DataFrame:
    """Write the ten models as tables and return the results of their column checks.

    Each model reads the written versions of the models before it, so a lost executor costs
    tasks of one model only, and nothing is computed twice.  Readers see the new rows of all ten
    once all are written and all declared checks pass; a failed write, or a failed check
    (``quality.ChecksFailed``) unless ``gate`` is off, leaves all ten tables as they were.

    With ``buckets``, the order-keyed staged tables are written bucketed by order: the
    groupings and joins of the order models then need no shuffle of them.  A table with a
    hot order stays unbucketed, since one task reads one bucket.
    """
    versions: list[Version] = []

    def written(name: str, df: DataFrame) -> DataFrame:
        table = f"{'staging' if name in STAGES else 'transform'}.{name}"
        layout = {}
        if buckets and name in BY_ORDER and not find_hot(df, ORDER_KEY)[0]:
            layout = {"cluster_by": [ORDER_KEY], "buckets": buckets}
        versions.append(write_version(df, table, **layout))
        return versions[-1].frame

    try:
        results = quality.suite(Retail(raw, as_of or date.today(), find_hot, written).all()).collect()
        if gate:
            quality.require(results)
    except Exception:
        for version in versions:
            discard(version)
        raise
    for version in versions:
        switch(version)
    return spark.createDataFrame(results, CHECKED)
