"""Tables of current rows, kept in buckets of a key; a batch rewrites the buckets that it touches and no others.

Rows lie in folders by bucket and by the merge that wrote them, and are never changed.  A manifest names the merge that counts
for every bucket; replacing it, which is one change of the catalog, shows a merge in the table and in all tables derived from
it at once.

A merge of many rows goes bucket by bucket, and what a bucket has shuffled is gone before the next: beside the rows that stay,
the disk holds the batch once and the shuffle of one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.sources.tables import create_database, create_table, current_version, overwrite, same_columns

BUCKET, WRITER = "bucket", "writer"
RETRACTED = "retracted"
_ROUND = "merge_round"
#: Buckets are merged together up to so many rows.
ROUND_ROWS = 1_000_000
_LAYOUT = f"OPTIONS (compression 'zstd') PARTITIONED BY ({BUCKET}, {WRITER})"
# Read once and dropped.  A task writes to all rounds at once, so row groups are small.
_STAGED_LAYOUT = f"OPTIONS (compression 'zstd', 'parquet.block.size' '8388608', 'parquet.enable.dictionary' 'false') PARTITIONED BY ({_ROUND})"
#: While a merge writes: a step's shuffle goes with the step, and a task keeps a file open for each of its few folders instead of sorting its rows by folder.
_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.maxConcurrentOutputFileWriters": "32"}
_MANIFEST = "name string, bucket int, writer string"

Derive = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Merged:
    """What a merge has done."""

    touched: tuple[int, ...]
    writer: str


def _stored(table: str) -> str:
    return f"{table}__buckets"


def _manifest(table: str) -> str:
    return f"{table}__manifest"


def _staged(table: str) -> str:
    return f"{table}__changes"


def bucket_of(column: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def _entries(spark: SparkSession, table: str) -> list[tuple[str, int, str]]:
    """The manifest: a row per table and bucket, so a bounded number."""
    if not spark.catalog.tableExists(_manifest(table)):
        return []
    return [tuple(r) for r in spark.table(_manifest(table)).collect()]


def _folders(spark: SparkSession, table: str, entries: list[tuple[str, int, str]]) -> DataFrame:
    named = [f"{bucket}-{writer}" for name, bucket, writer in entries if name == table]
    place = F.concat_ws("-", F.col(BUCKET).cast("string"), WRITER)
    return spark.table(_stored(table)).filter(place.isin(named) if named else F.lit(False))


def current(spark: SparkSession, table: str, entries: list[tuple[str, int, str]]) -> DataFrame:
    """Rows of ``table`` in the given buckets; only their folders are read."""
    return _folders(spark, table, entries).drop(BUCKET, WRITER)


def newest(rows: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """The last row of each key, without those that are retracted; rows without the first key all stay, unless retracted.

    At equal ``by`` a retraction counts, then the greater row.  A grouped max combines on the map side.
    """
    key = keys[0]
    rest = [c for c in rows.columns if c not in (*keys, by, RETRACTED)]
    last = (
        rows.filter(F.col(key).isNotNull())
        .groupBy(*keys)
        .agg(F.max(F.struct(by, RETRACTED, *rest)).alias("last"))
        .select(*keys, "last.*")
    )
    kept = last.select(*rows.columns).unionByName(rows.filter(F.col(key).isNull()))
    return kept.filter(~F.col(RETRACTED)).drop(RETRACTED)


def merge(
    changes: DataFrame,
    table: str,
    key: str,
    bucket_by: str,
    buckets: int = 64,
    by: str = "batch_id",
    derived: Mapping[str, Derive] | None = None,
) -> Merged:
    """Bring the rows of a batch into ``table``: of each ``key`` the row with the greatest ``by`` stays.

    ``changes`` has the table's columns and may have ``retracted``: true takes the key's row out.  Rows are kept in buckets of
    ``bucket_by``, which may be the key or a coarser column, such as the order of an order line; then a key is one within its
    ``bucket_by``, and a row that moves is retracted under the old value and comes under the new.  A retraction is not
    remembered: a later batch may bring the key again.

    ``derived`` gives tables that follow from the rows of each value of ``bucket_by`` alone, such as totals by it.
    They are built anew for the touched buckets only, from the merged rows, and are seen together with them.

    The number of buckets is that of the first merge.  A merge that fails shows nothing and can be run again.
    """
    spark, derived = changes.sparkSession, dict(derived or {})
    create_database(spark, table)
    if RETRACTED not in changes.columns:
        changes = changes.withColumn(RETRACTED, F.lit(False))
    plain = changes.drop(RETRACTED)
    if spark.catalog.tableExists(table):
        if not spark.catalog.tableExists(_stored(table)):
            raise ValueError(f"{table} was not made by merges")
        same_columns(plain, table)
    create_table(_placed(plain, bucket_by, buckets, ""), _stored(table), _LAYOUT)
    buckets = _buckets(spark, table, buckets)
    entries = _entries(spark, table)
    if left := {e[0] for e in entries} - {table, *derived}:
        raise ValueError(f"tables derived from {table} would fall behind: {sorted(left)}")
    writer = uuid4().hex
    with _held(spark, _SETTINGS):
        counts = _counts(changes.select(bucket_of(bucket_by, buckets).alias(BUCKET)))
        touched = sorted(counts)
        before = [e for e in entries if e[1] in counts]
        stored = _counts(_folders(spark, table, before)) if before else {}
        keys = list(dict.fromkeys((key, bucket_by)))
        rounds = _rounds({b: counts[b] + stored.get(b, 0) for b in touched})
        with _dealt(changes, table, bucket_by, buckets, rounds) as dealt:
            for part in rounds:
                # A round of one bucket needs no second shuffle by bucket.
                alone = len(rounds) > 1 and len(part) == 1
                old = current(spark, table, [e for e in before if e[1] in set(part)]).withColumn(RETRACTED, F.lit(False))
                merged = newest(old.unionByName(dealt(part).select(*old.columns)), keys, by)
                _write(merged, table, bucket_by, buckets, writer, alone)
                written = current(spark, table, [(table, b, writer) for b in part])
                for name, derive in derived.items():
                    rows = derive(written)
                    create_table(_placed(rows, bucket_by, buckets, ""), _stored(name), _LAYOUT)
                    _write(rows, name, bucket_by, buckets, writer, alone)
    names = (table, *derived)
    kept = [e for e in entries if e[1] not in set(touched)]
    entries = kept + [(name, b, writer) for name in names for b in touched]
    for name in names:
        _show(spark, name, table)
    overwrite(spark.createDataFrame(entries, _MANIFEST).coalesce(1), _manifest(table))
    return Merged(tuple(touched), writer)


def _buckets(spark: SparkSession, table: str, asked: int) -> int:
    """The number of buckets, which the stored table remembers."""
    stored = _stored(table)
    known = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {stored}").collect()}
    if "tillroll.buckets" not in known:
        spark.sql(f"ALTER TABLE {stored} SET TBLPROPERTIES ('tillroll.buckets' = '{asked}')")
        return asked
    return int(known["tillroll.buckets"])


def _counts(placed: DataFrame) -> dict[int, int]:
    """Rows by bucket."""
    return {r[0]: r[1] for r in placed.groupBy(BUCKET).count().collect()}


def _rounds(rows: Mapping[int, int]) -> list[list[int]]:
    """The buckets in order, cut into runs of at most ``ROUND_ROWS`` rows or one bucket."""
    rounds: list[list[int]] = []
    held = 0
    for bucket in sorted(rows):
        if not rounds or held + rows[bucket] > ROUND_ROWS:
            rounds.append([])
            held = 0
        rounds[-1].append(bucket)
        held += rows[bucket]
    return rounds


@contextmanager
def _held(spark: SparkSession, settings: Mapping[str, str]) -> Iterator[None]:
    """The settings hold within."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def _dealt(
    changes: DataFrame, table: str, bucket_by: str, buckets: int, rounds: list[list[int]]
) -> Iterator[Callable[[list[int]], DataFrame]]:
    """The rows of the batch by round.  Of several rounds, they are written once, and a round's go when the next is asked for."""
    if len(rounds) < 2:
        yield lambda part: changes
        return
    spark, name, done = changes.sparkSession, f"{_staged(table)}{uuid4().hex}", []
    kinds = dict(spark.table(_stored(table)).dtypes)
    typed = changes.withColumns({c: F.col(c).cast(kinds[c]) for c, kind in changes.dtypes if kind == "void"})
    first = {bucket: part[0] for part in rounds for bucket in part}
    of = F.get(F.array(*[F.lit(first.get(b)).cast("int") for b in range(buckets)]), bucket_of(bucket_by, buckets))
    typed = typed.withColumn(_ROUND, of)

    def dealt(part: list[int]) -> DataFrame:
        for begun in done:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({_ROUND} = {begun})")
        done[:] = [part[0]]
        return spark.table(name).filter(F.col(_ROUND) == part[0]).drop(_ROUND)

    create_table(typed, name, _STAGED_LAYOUT)
    try:
        typed.write.mode("append").format("parquet").partitionBy(_ROUND).saveAsTable(name)
        yield dealt
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def _placed(df: DataFrame, bucket_by: str, buckets: int, writer: str) -> DataFrame:
    return df.withColumns({BUCKET: bucket_of(bucket_by, buckets), WRITER: F.lit(writer)})


def _write(df: DataFrame, table: str, bucket_by: str, buckets: int, writer: str, alone: bool = False) -> None:
    columns = [c for c in df.sparkSession.table(_stored(table)).columns if c not in (BUCKET, WRITER)]
    placed = _placed(df.select(*columns), bucket_by, buckets, writer)
    if not alone:
        # Few files to a bucket, and a bucket that a hot value makes large is written by several tasks.
        placed = placed.hint("rebalance", BUCKET)
    placed.write.mode("append").format("parquet").partitionBy(BUCKET, WRITER).saveAsTable(_stored(table))


def _show(spark: SparkSession, name: str, table: str) -> None:
    """The table as readers see it: of each bucket, what the manifest's merge has written."""
    if spark.catalog.tableExists(name):
        return
    if current_version(spark, _manifest(table)) is None:
        overwrite(spark.createDataFrame([], _MANIFEST), _manifest(table))
    shown = ", ".join(f"s.`{c}`" for c in spark.table(_stored(name)).columns if c not in (BUCKET, WRITER))
    spark.sql(f"""
        CREATE VIEW {name} AS SELECT {shown} FROM {_stored(name)} AS s LEFT SEMI JOIN {_manifest(table)} AS m
        ON m.name = '{name}' AND m.{BUCKET} = s.{BUCKET} AND m.{WRITER} = s.{WRITER}""")


def sweep(spark: SparkSession, table: str, derived: tuple[str, ...] = ()) -> int:
    """Drop the folders of buckets that no reader sees any more; call it while no merge runs.  The folders dropped.

    Batches that killed merges have left written go, too.
    """
    entries, dropped = _entries(spark, table), 0
    database, _, staged = _staged(table).rpartition(".")
    for row in spark.sql(f"SHOW TABLES{f' IN {database}' if database else ''} LIKE '{staged}*'").collect():
        spark.sql(f"DROP TABLE IF EXISTS {database + '.' if database else ''}{row['tableName']}")
    for name in (table, *derived):
        kept = {(bucket, writer) for n, bucket, writer in entries if n == name}
        for row in spark.sql(f"SHOW PARTITIONS {_stored(name)}").collect():
            bucket, writer = (part.split("=")[1] for part in row["partition"].split("/"))
            if (int(bucket), writer) not in kept:
                spark.sql(f"ALTER TABLE {_stored(name)} DROP PARTITION ({BUCKET} = {bucket}, {WRITER} = '{writer}')")
                dropped += 1
    return dropped
