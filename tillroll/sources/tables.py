"""Reading and writing tables: scans, snapshots, appends, full refreshes, ad-hoc SQL."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillroll.rules import SNAPSHOT_STAMP
from tillroll.schemas import RAW

_VERSION = "__v"
_CURRENT, _BEFORE = "tillroll.current", "tillroll.before"

REFERENCE_COLUMNS = {
    "products": ("product_id", "product_name", "category", "price", "stock"),
    "customers": ("customer_id", "customer_segment", "is_active"),
}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a local session without the setting falls back to a folder in its warehouse.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def raw_scan(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Parquet scan of raw table ``name`` under its declared schema."""
    return spark.read.schema(RAW[name]).parquet(path)


def reference_scan(loaded: DataFrame, name: str) -> DataFrame:
    """The few columns of products or customers that pricing looks up."""
    return loaded.select(*REFERENCE_COLUMNS[name])


def stamp(df: DataFrame, at: datetime, source: str | None = None) -> DataFrame:
    """Batch columns: one time for the whole batch, as ISO text."""
    text = F.lit(at.isoformat(timespec="seconds"))
    stamped = df.withColumn("batch_id", text)
    if source is None:
        return stamped
    return stamped.withColumns({"generated_at": text, "source": F.lit(source)})


def snapshot(df: DataFrame, base: str, name: str, at: datetime, again: bool = False) -> str:
    """Write a new timestamped Parquet folder; an existing one is an error, or is replaced where a load runs ``again``."""
    path = f"{base}/{name}_{at.strftime(SNAPSHOT_STAMP)}.parquet"
    df.write.mode("overwrite" if again else "errorifexists").parquet(path)
    return path


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_by_period(df: DataFrame, path: str, moment: str, period: str = "day") -> None:
    """Write Parquet in one folder per day, or month or year, of ``moment``, so that a slice of time reads its folders only.

    The folder's date is added as a column named as the period.  Rows are dealt to tasks by ranges of the moment, so a period
    with very many rows is written by several tasks and one with few makes one small file.  Rows without a moment have a
    folder of their own.
    """
    begins = F.col(moment).cast("date") if period == "day" else F.trunc(F.col(moment).cast("date"), period)
    dated = df.withColumn(period, begins)
    dated.repartitionByRange(period, moment).write.mode("errorifexists").partitionBy(period).parquet(path)


def create_database(spark: SparkSession, table: str) -> None:
    """The database that the table's name begins with."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")


def current_version(spark: SparkSession, table: str) -> str | None:
    """The physical table that ``table`` points at, if it has been overwritten or published here."""
    return _pointer(spark, table).get(_CURRENT)


def _pointer(spark: SparkSession, table: str) -> dict[str, str]:
    if not spark.catalog.tableExists(table):
        return {}
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def append(df: DataFrame, table: str) -> int:
    """Append by column name, creating the table if absent; the rows written.

    A batch with other columns than the table is an error before anything is written.  The count comes from the write itself, not from a second pass.
    """
    spark = df.sparkSession
    create_database(spark, table)
    if spark.catalog.tableExists(table):
        df = df.select(*same_columns(df, table))
        table = current_version(spark, table) or table
    counted, seen = _counted(df)
    counted.write.mode("append").format("parquet").saveAsTable(table)
    return seen.get["rows"]


def same_columns(df: DataFrame, table: str) -> list[str]:
    """The columns of the table, in its order; an error unless the frame has the same ones."""
    columns = df.sparkSession.table(table).columns
    if set(columns) != set(df.columns):
        raise ValueError(f"columns of the batch and of {table} differ: {sorted(set(columns) ^ set(df.columns))}")
    return columns


def create_table(df: DataFrame, table: str, layout: str = "") -> None:
    """An empty table for the rows of ``df``.

    The catalog knows it before rows are written, so what a failed write leaves behind can be dropped or written over.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {layout}")


@dataclass(frozen=True)
class Version:
    """A written state of a table that readers do not see yet."""

    table: str
    name: str
    rows: int
    spark: SparkSession

    @property
    def frame(self) -> DataFrame:
        return self.spark.table(self.name)


def write_version(df: DataFrame, table: str, cluster_by: Sequence[str] = (), buckets: int = 0) -> Version:
    """Write a new state of ``table`` beside it; a failed write leaves nothing behind and the table as it is.

    With ``buckets``, rows are bucketed and sorted by ``cluster_by`` so that later joins
    and groupings on it need no shuffle.  One task then reads one bucket, so leave it off
    where a key is hot.
    """
    spark = df.sparkSession
    create_database(spark, table)
    if buckets:
        df = df.repartition(buckets, *cluster_by)
    counted, seen = _counted(df)
    writer, layout = counted.write.mode("append").format("parquet"), ""
    if buckets:
        writer = writer.bucketBy(buckets, *cluster_by).sortBy(*cluster_by)
        by = ", ".join(cluster_by)
        layout = f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    name = f"{table}{_VERSION}{uuid4().hex}"
    create_table(df, name, layout)
    try:
        writer.saveAsTable(name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        raise
    return Version(table, name, seen.get["rows"], spark)


def discard(version: Version) -> None:
    """Forget a version that was not switched to."""
    version.spark.sql(f"DROP TABLE IF EXISTS {version.name}")


def switch(version: Version) -> None:
    """Point the table at the version: one change in the catalog, before which readers see the old rows and after which the new.

    The version before stays for readers that have begun; the one before that is dropped.  A plain table of that name
    becomes the version before.
    """
    spark, table = version.spark, version.table
    pointer = _pointer(spark, table)
    before = pointer.get(_CURRENT)
    if before is None and spark.catalog.tableExists(table):
        before = f"{table}{_VERSION}{uuid4().hex}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    kept = f"'{_CURRENT}' = '{version.name}'" + (f", '{_BEFORE}' = '{before}'" if before else "")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ({kept}) AS SELECT * FROM {version.name}")
    if _BEFORE in pointer:
        spark.sql(f"DROP TABLE IF EXISTS {pointer[_BEFORE]}")


def sweep(spark: SparkSession, table: str) -> list[str]:
    """Drop versions that a killed run has left behind; call it while nobody writes the table.  The names dropped."""
    database, _, name = table.rpartition(".")
    kept = set(_pointer(spark, table).values())
    found = spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{name}{_VERSION}*'").collect()
    names = [f"{database}.{r['tableName']}" if database else r["tableName"] for r in found]
    left = [n for n in names if n not in kept]
    for name in left:
        spark.sql(f"DROP TABLE {name}")
    return left


def overwrite(
    df: DataFrame,
    table: str,
    cluster_by: Sequence[str] = (),
    buckets: int = 0,
    check: Callable[[DataFrame], object] | None = None,
) -> int:
    """Replace the rows of the table as one act; the rows written.

    They are written as a new version.  ``check`` looks at it and may raise.  Only then does the table point at it, so a failed
    write or check leaves the table as it was.  ``df`` may read the table itself.
    """
    version = write_version(df, table, cluster_by, buckets)
    try:
        if check:
            check(version.frame)
        switch(version)
    except Exception:
        discard(version)
        raise
    return version.rows


def materialize(df: DataFrame, layer: str, model: str, **layout) -> DataFrame:
    """Full refresh of ``layer.model``; the frame returned reads the written table."""
    overwrite(df, f"{layer}.{model}", **layout)
    return df.sparkSession.table(f"{layer}.{model}")


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Ad-hoc SQL.  The rows stay distributed until the caller asks for them."""
    return spark.sql(sql)
