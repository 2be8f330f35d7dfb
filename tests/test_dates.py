from datetime import datetime
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from tillroll.functions.dates import (
    boundary_diff,
    day_of_week,
    elapsed_days,
    iso_text,
    moment,
    month_start,
    week_start,
)

MOMENTS = [
    datetime(2023, 12, 31, 23, 59, 59),
    datetime(2024, 1, 1, 0, 0, 0),
    datetime(2024, 1, 31, 0, 59, 0),
    datetime(2024, 1, 31, 1, 1, 0),
    datetime(2024, 2, 1, 12, 0, 0),
    datetime(2024, 2, 28, 23, 59, 0),
    datetime(2024, 2, 29, 0, 1, 0),
    datetime(2024, 3, 1, 0, 0, 0),
    datetime(2024, 6, 28, 8, 30, 15),  # Friday
    datetime(2024, 6, 29, 8, 30, 15),
    datetime(2024, 6, 30, 8, 30, 15),
    datetime(2024, 7, 1, 8, 30, 15),
    datetime(1999, 10, 31, 2, 30, 0),
    datetime(2024, 3, 10, 2, 30, 0),  # skipped by the clocks of New York
    datetime(2024, 11, 3, 1, 30, 0),  # there twice in New York
]
UNITS = ("year", "month", "day", "hour", "minute")


@pytest.fixture(scope="module")
def moments(spark):
    return spark.createDataFrame(list(product(MOMENTS, MOMENTS)), "a timestamp_ntz, b timestamp_ntz")


def test_boundary_diff_counts_as_duckdb_does(moments):
    rows = moments.select("a", "b", *[boundary_diff(u, F.col("a"), F.col("b")).alias(u) for u in UNITS]).collect()
    con = duckdb.connect()
    for row in rows:
        wanted = con.execute(
            "SELECT " + ", ".join(f"date_diff('{u}', $1::TIMESTAMP, $2::TIMESTAMP)" for u in UNITS), [row["a"], row["b"]]
        ).fetchone()
        assert tuple(row[u] for u in UNITS) == wanted, (row["a"], row["b"])


def test_boundary_is_not_elapsed_time(spark):
    df = spark.createDataFrame([(MOMENTS[0], MOMENTS[1])], "a timestamp_ntz, b timestamp_ntz")
    row = df.select(*[boundary_diff(u, F.col("a"), F.col("b")) for u in UNITS]).first()
    assert tuple(row) == (1, 1, 1, 1, 1)
    assert df.select(elapsed_days(F.col("a"), F.col("b"))).first()[0] == 0


def test_results_do_not_depend_on_the_session_zone(spark, moments):
    def run():
        columns = [elapsed_days(F.col("a"), F.col("b")), F.col("a") < moment(MOMENTS[4])]
        columns += [boundary_diff(u, F.col("a"), F.col("b")) for u in UNITS]
        extra = [month_start(F.col("a")), week_start(F.col("a")), day_of_week(F.col("a")), iso_text(F.col("a"))]
        return sorted(map(tuple, moments.select("a", "b", *columns, *extra).collect()))

    here = run()
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert run() == here
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_weeks_start_on_monday_and_days_count_from_sunday(spark):
    days = [datetime(2024, 6, 30, 9), datetime(2024, 7, 1, 0), datetime(2024, 7, 6, 23, 59)]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    rows = df.select(day_of_week(F.col("t")), week_start(F.col("t")), month_start(F.col("t"))).collect()
    assert [r[0] for r in rows] == [0, 1, 6]
    assert [r[1] for r in rows] == [datetime(2024, 6, 24), datetime(2024, 7, 1), datetime(2024, 7, 1)]
    assert [r[2] for r in rows] == [datetime(2024, 6, 1), datetime(2024, 7, 1), datetime(2024, 7, 1)]


def test_null_moments_give_null(spark):
    df = spark.createDataFrame([(None, MOMENTS[0])], "a timestamp_ntz, b timestamp_ntz")
    assert set(df.select(*[boundary_diff(u, F.col("a"), F.col("b")) for u in UNITS]).first()) == {None}


def test_unknown_unit(spark):
    with pytest.raises(ValueError):
        boundary_diff("fortnight", F.lit(1), F.lit(1))
