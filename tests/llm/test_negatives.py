"""Hard negatives against plain integers."""

import math
import random

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tillroll.llm import negatives, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(data, scale=256):
    kept = []
    for vec_id, vector, label in data:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((vec_id, label, [math.floor(scale * x) for x in vector]))
    out = []
    for a, (anchor_id, own, anchor) in enumerate(kept):
        if anchor_id is None or anchor_id % 100:
            continue
        scored = [
            (-sum(x * y for x, y in zip(anchor, v)), vec_id is None, vec_id or 0, label)
            for i, (vec_id, label, v) in enumerate(kept)
            if i != a
        ]
        scored.sort()
        for fall, unnamed, pos_id, _ in [s for s in scored if s[3] == own][:5]:
            rank = 0
            for f, u, neg_id, label in scored:
                if label != own and 30 * -fall <= 100 * -f <= 90 * -fall and rank < 10:
                    rank += 1
                    out.append((anchor_id, None if unnamed else pos_id, rank, None if u else neg_id, -fall, -f))
    return sorted(out, key=lambda r: [(x is not None, x) for x in r])


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: [(x is not None, x) for x in r])


def random_rows(n, size, seed, dims=6):
    rng = random.Random(seed)
    return [(i, [rng.uniform(-size, size) for _ in range(dims)], rng.randint(0, 2)) for i in range(n)]


AWKWARD = [
    (None, [0.5] * 6, 1),
    (None, [0.4] * 6, 2),
    (100, None, 1),
    (200, [0.1, None, 0.2], 1),
    (300, [float("nan")] * 6, 1),
    (400, [float("inf")] * 6, 1),
    (500, [0.3] * 6, None),
    (600, [], 1),
    (700, [0.9, 0.8], 2),
    (800, [0.5] * 6, 1),
    (800, [0.5] * 6, 1),
    (800, [0.5] * 6, 2),
    (800, [0.7] * 6, 1),
    (801, [0.5] * 6, 1),
    (802, [0.5] * 6, 1),
    (803, [0.4] * 6, 2),
    (804, [0.4] * 6, 2),
    (-100, [0.2] * 6, 0),
]


@pytest.mark.parametrize("parts", [1, 4])
def test_negatives_as_in_plain_python(spark, monkeypatch, parts):
    data = random_rows(300, 0.6, 1) + AWKWARD
    if parts > 1:
        monkeypatch.setattr(negatives, "PART_COMPONENTS", 12)
        monkeypatch.setattr(negatives, "TASK_ROWS", 30)
        monkeypatch.setattr(negatives, "BLOCK_ROWS", 7)
    df = spark.createDataFrame(data, SCHEMA).withColumn("rank", F.lit("own"))
    assert got(negatives.hard_negatives(df)) == plain(data)


def test_components_of_any_size(spark):
    # Fields of 64 bits, and of more: squares of 2 to the 28 and products of 2 to the 70 with small numbers.
    for size in (1e4, 1e6):
        data = random_rows(120, size, 2, dims=3)
        assert got(negatives.hard_negatives(spark.createDataFrame(data, SCHEMA))) == plain(data)
    data = [(i, [1e21 * (i % 5 - 2), 0.5 + i], i % 3) for i in range(40)]
    data = [(100, [0.0, 3.0], 1)] + [(i + 1, v, label) for i, v, label in data]
    wanted = plain(data)
    rows = got(negatives.hard_negatives(spark.createDataFrame(data, SCHEMA)))
    assert rows == wanted and rows


def test_no_rows_and_no_anchors(spark):
    for data in ([], [(1, [0.5], 1), (2, [0.5], 2)], [(100, [0.5], 1)]):
        assert negatives.hard_negatives(spark.createDataFrame(data, SCHEMA)).collect() == []


def test_query_matches_its_statement(spark):
    sql = queries.statements()["op12_hard_negatives"]
    assert differences(queries.op12_hard_negatives(spark, SF), connect(SF), sql) == []
