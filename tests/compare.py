"""Row-for-row comparison of a Spark frame with a DuckDB statement."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql.types import DataType

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def duck_type(kind: DataType) -> str:
    text = kind.simpleString()
    return DUCK_TYPES.get(text, text.upper())


def differences(df, con, sql: str) -> list[str]:
    """What differs in columns, types or rows; empty where the two agree."""
    names = sorted(df.columns)
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    if sorted(duck_names) != names:
        return [f"columns: spark only {set(names) - set(duck_names)}, duckdb only {set(duck_names) - set(names)}"]
    found = []
    types = dict(zip(duck_names, [str(d[1]) for d in result.description]))
    for field in df.schema.fields:
        want, got = duck_type(field.dataType), types[field.name]
        if want.replace(",", ", ") != got.replace(",", ", ").replace(",  ", ", "):
            found.append(f"type of {field.name}: spark {want}, duckdb {got}")
    order = [duck_names.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    actual = Counter(tuple(row[n] for n in names) for row in df.select(*names).collect())
    for label, diff in (("spark", actual - expected), ("duckdb", expected - actual)):
        if diff:
            shown = [dict(zip(names, row)) for row in list(diff)[:2]]
            found.append(f"{sum(diff.values())} rows only in {label}, such as {shown}")
    return found
