"""Batches of several tables that readers see whole or not at all.

Every attempt to load a batch writes its rows under a key of its own.  One small row set appended to the ledger publishes
the attempt for all its tables at once.  The tables are views that show published attempts only, and of each batch the
one published first; so a killed load shows nothing, and loading a batch again after it is published changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import Decimal
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import create_database, create_table, same_columns

#: Attempts are a column of the stored rows that readers do not see.
ATTEMPT = "attempt"
LEDGER_COLUMNS = (
    "batch_id string, source string, table string, attempt string, rows long, revenue decimal(28,2), published_at string"
)
_KEY = ("batch_id", "source", "table")


@dataclass(frozen=True)
class Published:
    """What the ledger says of one table's part of a batch."""

    rows: int
    revenue: Decimal | None


def _ledger(table: str) -> str:
    database = table.rpartition(".")[0]
    return f"{database}.batch_ledger" if database else "batch_ledger"


def _stored(table: str) -> str:
    return f"{table}__attempts"


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """Published batches of all tables beside ``table``; of attempts at the same batch, the first published counts."""
    if not spark.catalog.tableExists(_ledger(table)):
        return spark.createDataFrame([], LEDGER_COLUMNS)
    rest = [f.name for f in spark.table(_ledger(table)).schema if f.name not in _KEY]
    first = F.min(F.struct("published_at", *[c for c in rest if c != "published_at"]))
    return spark.table(_ledger(table)).groupBy(*_KEY).agg(first.alias("first")).select(*_KEY, "first.*")


def published(spark: SparkSession, table: str, batch_id: str, source: str) -> Published | None:
    """The table's part of a batch, if the batch is published."""
    of = (F.col("batch_id") == batch_id) & (F.col("source") == source) & (F.col("table") == table)
    row = ledger(spark, table).filter(of).first()
    return Published(row["rows"], row["revenue"]) if row else None


def publish(
    frames: Mapping[str, DataFrame], batch_id: str, source: str, revenue: Mapping[str, str] | None = None
) -> dict[str, Published]:
    """Load a batch: the rows of each table, all of one database, seen together or not at all.

    The frames carry the columns ``batch_id`` and ``source``, as ``tables.stamp`` makes them.  ``revenue`` names the column of a
    table whose sum the ledger keeps.  A batch that is published is not written again, and what the ledger has of it is
    returned; one that failed half way is written anew.  Columns that differ from the table's are an error before anything
    is written.
    """
    spark = next(iter(frames.values())).sparkSession
    if len({_ledger(table) for table in frames}) > 1:
        raise ValueError(f"tables of one batch lie in one database: {sorted(frames)}")
    done = {table: published(spark, table, batch_id, source) for table in frames}
    if any(done.values()):
        return {table: found or Published(0, None) for table, found in done.items()}
    for table, df in frames.items():
        create_database(spark, table)
        if spark.catalog.tableExists(table):
            if not spark.catalog.tableExists(_stored(table)):
                raise ValueError(f"{table} was not made of published batches")
            same_columns(df, table)
    attempt, written = uuid4().hex, {}
    for table, df in frames.items():
        written[table] = _write(df, table, attempt, (revenue or {}).get(table))
    for table, df in frames.items():
        _show(spark, table, df.columns)
    at = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    rows = [(batch_id, source, table, attempt, w.rows, w.revenue, at) for table, w in written.items()]
    # All tables' rows in one file: the batch is published with it.
    spark.createDataFrame(rows, LEDGER_COLUMNS).coalesce(1).write.mode("append").saveAsTable(
        _ledger(next(iter(frames)))
    )
    return written


def _write(df: DataFrame, table: str, attempt: str, revenue: str | None) -> Published:
    spark, stored, seen = df.sparkSession, _stored(table), Observation()
    create_table(df.withColumn(ATTEMPT, F.lit(attempt)), stored, f"PARTITIONED BY ({ATTEMPT})")
    columns = [c for c in spark.table(stored).columns if c != ATTEMPT]
    total = F.sum(revenue) if revenue else F.lit(None)
    metrics = F.count(F.lit(1)).alias("rows"), total.cast("decimal(28,2)").alias("revenue")
    watched = df.select(*columns).observe(seen, *metrics).withColumn(ATTEMPT, F.lit(attempt))
    watched.write.mode("append").format("parquet").partitionBy(ATTEMPT).saveAsTable(stored)
    return Published(seen.get["rows"], seen.get["revenue"])


def _show(spark: SparkSession, table: str, columns: list[str]) -> None:
    """The table as readers see it."""
    if spark.catalog.tableExists(table):
        return
    if not spark.catalog.tableExists(_ledger(table)):
        create_table(spark.createDataFrame([], LEDGER_COLUMNS), _ledger(table))
    shown = ", ".join(f"`{c}`" for c in columns)
    spark.sql(f"""
        CREATE VIEW {table} AS SELECT {shown} FROM {_stored(table)} LEFT SEMI JOIN (
          SELECT min_by(attempt, struct(published_at, attempt)) AS seen FROM {_ledger(table)}
          WHERE table = '{table}' GROUP BY batch_id, source
        ) ON {ATTEMPT} = seen""")


def sweep(spark: SparkSession, table: str) -> int:
    """Drop the rows of attempts that were never published; call it while no load runs.  The attempts dropped."""
    seen = spark.table(_ledger(table)).select(ATTEMPT).distinct()
    stored = spark.sql(f"SHOW PARTITIONS {_stored(table)}").select(
        F.split("partition", "=")[1].alias(ATTEMPT)
    )
    left = [r[0] for r in stored.join(seen, ATTEMPT, "left_anti").collect()]
    for attempt in left:
        spark.sql(f"ALTER TABLE {_stored(table)} DROP PARTITION ({ATTEMPT} = '{attempt}')")
    return len(left)
