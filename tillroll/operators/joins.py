"""Joins that survive a key holding a large part of the rows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key of fewer rows is one small task.
HOT_ROWS = 10_000
LEAST_SHARE = 4e-6
#: Bounds on the items that a sketch keeps.
_LEAST_TRACKED = 1024
_MOST_TRACKED = 1_000_000
_SALT = "_salt"

# Hot values of a key (None for NULL) with their share of the rows.
Hot = Mapping[object, float]


def hot_keys(
    df: DataFrame, *keys: str, share: float | None = None, min_rows: int = HOT_ROWS
) -> tuple[dict[object, float], ...]:
    """For each of ``keys``, the values that hold at least ``share`` of the rows, and their shares.

    One pass over the key columns counts the rows and sketches the keys.  Each task keeps a
    fixed-size frequent-item sketch, groups of tasks merge theirs, and the last step merges
    those, so nothing that grows with the number of keys is shuffled or collected: at most
    ``1 / share`` values return.  Without a ``share``, it is a quarter of a shuffle partition's,
    at any number of partitions up to ``1 / LEAST_SHARE``.  A key of fewer than ``min_rows`` rows is
    not worth spreading, whatever its share.  The result only steers the physical plan; a missed or
    surplus value changes no row.
    """
    if share is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = max(LEAST_SHARE, 1 / (4 * partitions))
    most = max(1, int(1 / share))
    tracked = min(_MOST_TRACKED, max(_LEAST_TRACKED, 4 * most))
    most = min(most, tracked)
    sketches = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(1024)).alias("task_group")).agg(
        F.count("*").alias("rows"),
        *[F.expr(f"approx_top_k_accumulate(`{k}`, {tracked}) as sketch_{i}") for i, k in enumerate(keys)],
    )
    # Grouped by a constant: a task without any sketch has nothing to merge, where a plain total would merge an untyped one.
    whole = sketches.groupBy(F.lit(0).alias("all")).agg(
        F.sum("rows").alias("rows"),
        *[F.expr(f"approx_top_k_combine(sketch_{i}, {tracked}) as sketch_{i}") for i in range(len(keys))],
    )
    found = whole.select(
        "rows", *[F.expr(f"approx_top_k_estimate(sketch_{i}, {most})") for i in range(len(keys))]
    ).first()
    if found is None:
        return tuple({} for _ in keys)
    rows, tops = found[0], found[1:]
    least = max(min_rows, rows * share)
    return tuple({top["item"]: top["count"] / rows for top in top_k or [] if top["count"] >= least} for top_k in tops)


def _ways(key: str, hot: Hot, partitions: int) -> Column:
    """Number of sub-keys of each row's key: 1, or in proportion to the share of a hot value.

    A value gets four times its share of the shuffle partitions, as a power of two.  All
    hot values together get at most about eight times the partitions, so repeating one
    row per sub-key stays small.
    """
    groups = defaultdict(list)
    for value, share in hot.items():
        groups[2 ** max(1, ceil(log2(max(1.0, 4 * share * partitions))))].append(value)
    ways = F.lit(1)
    for count, values in groups.items():
        named = [v for v in values if v is not None]
        tests = ([F.col(key).isin(named)] if named else []) + ([F.col(key).isNull()] if None in values else [])
        ways = F.when(reduce(Column.__or__, tests), F.lit(count)).otherwise(ways)
    return ways


def join(
    left: DataFrame,
    rights: Sequence[DataFrame],
    key: str,
    hot: Hot | None = None,
    spread_by: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """``left`` joined (left or inner) with each of ``rights`` on ``key``.

    No side is broadcast by hint: Spark broadcasts a side its own statistics show to be
    under the threshold, and otherwise sort-merges with a single shuffle per input.

    The left rows of ``hot`` keys go to several sub-keys each, and the right rows of those
    keys are repeated once per sub-key, so no task holds one key whole.  NULL-key rows
    spread as well and match nothing.  The sub-key depends on the task and on the
    ``spread_by`` columns, so copies of one row also spread, and a retried task repeats
    its choice.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"cannot spread a {how} join")
    keys = [key]
    if hot:
        partitions = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ways = _ways(key, hot, partitions)
        matching = _ways(key, {value: share for value, share in hot.items() if value is not None}, partitions)
        bucket = F.pmod(F.xxhash64(F.spark_partition_id(), *spread_by), ways).cast("int")
        left = left.withColumn(_SALT, bucket)
        rights = [r.withColumn(_SALT, F.explode(F.sequence(F.lit(0), matching - 1))) for r in rights]
        keys.append(_SALT)
    joined = left
    for right in rights:
        joined = joined.join(right, keys, how)
    return joined.drop(_SALT)
