"""Small staged and raw rows, filled from defaults."""

from datetime import date, datetime
from decimal import Decimal

from tillroll.schemas import RAW

NOON = datetime(2024, 6, 15, 12, 0, 0)
DEFAULTS = {
    "bigint": 1,
    "int": 1,
    "string": "x",
    "double": 1.0,
    "boolean": True,
    "date": date(1990, 6, 15),
    "timestamp_ntz": NOON,
}


def raw(spark, name: str, *rows: dict):
    """Raw table ``name``: each row states what matters, the rest takes a default."""
    fields = RAW[name].fields
    data = [
        tuple(row[f.name] if f.name in row else DEFAULTS[f.dataType.simpleString()] for f in fields) for row in rows
    ]
    for row in rows:
        assert set(row) <= set(RAW[name].names), row
    return spark.createDataFrame(data, RAW[name])


def dec(text: str) -> Decimal:
    return Decimal(text)
