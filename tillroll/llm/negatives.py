"""Hard negatives by exact inner products of Kronecker-packed integers.

Components become whole numbers.  A block's candidates are packed: for each dimension, the components of all of them, biased
so that none is below zero, lie side by side in fields of one wide integer.  One multiplication of that integer by an
anchor's component multiplies them all; the sum over the dimensions holds every candidate's inner product in its field.
Fields are as wide as the block's largest components ask for, so no field runs into the next, whatever the values.

Anchors go to all blocks, in parts of bounded size; a part takes two passes over the vectors, one for the positives and one
for the negatives in the bands that the positives' scores set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import record_batch, run_folder, saved

#: Components of the anchors that go to all blocks at a time.
PART_COMPONENTS = 1 << 20
#: Candidates that are packed together, and candidates of a task at least and at most.
BLOCK_ROWS = 2048
TASK_ROWS, MOST_TASK_ROWS = 4096, 1 << 20
SCALE = 256

_RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
)


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, vector) of the rows with a label and a vector whose components are all finite numbers.

    A component counts as finite if its product with ``SCALE`` is.
    """
    floats = vectors.schema[vector].dataType.simpleString() == "array<float>"
    kept = F.col(vector) if floats else F.col(vector).cast("array<double>")
    taken = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), kept.alias("vector")
    )
    finite = F.expr(f"forall(vector, x -> x is not null and abs({SCALE} * double(x)) < double('Infinity'))")
    return taken.filter(F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


def _whole(vectors: pa.Array, dimensions: int) -> np.ndarray:
    """Rows of whole components, floor(SCALE * x); a vector that is shorter than others ends with zeros.

    Python's integers where 64 bits would not hold them.
    """
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if flat.size and np.abs(flat).max() >= 2.0**62:
        numbers = np.array([int(x) for x in flat], dtype=object)
    else:
        numbers = flat.astype(np.int64)
    found = np.zeros((len(lengths), dimensions), dtype=numbers.dtype)
    found[np.arange(dimensions)[None, :] < lengths[:, None]] = numbers
    return found


class Packed:
    """Candidates of one block as one wide integer per dimension."""

    def __init__(self, rows: np.ndarray, largest: int):
        """``largest``: the largest component of any anchor, whatever its sign."""
        self.n, dimensions = rows.shape
        self.bias = int(np.abs(rows).max()) if rows.size else 0
        # A sum of products lies between -most and most, and is biased by that, too.
        self.most = dimensions * largest * 2 * self.bias
        bits = (2 * self.most).bit_length()
        self.width = 4 if bits <= 32 else 8 if bits <= 64 else -(-bits // 8)
        self.wide = [self._integer(rows[:, d] + self.bias) for d in range(dimensions)]
        self.base = self._integer([self.most] * self.n)

    def _integer(self, fields) -> int:
        if self.width <= 8:
            return int.from_bytes(np.asarray(fields).astype(f"<u{self.width}").tobytes(), "little")
        return int.from_bytes(b"".join(int(x).to_bytes(self.width, "little") for x in fields), "little")

    def scores(self, anchor: list[int]) -> np.ndarray:
        """Inner products of the anchor with every candidate, exact; an error beyond 64 bits."""
        total = self.base + sum(a * w for a, w in zip(anchor, self.wide) if a)
        raw = total.to_bytes(self.n * self.width, "little")
        shift = self.most + self.bias * sum(anchor)
        if self.width <= 8 and shift.bit_length() < 63 and (2 * self.most).bit_length() < 63:
            return np.frombuffer(raw, f"<u{self.width}").astype(np.int64) - shift
        fields = (raw[i : i + self.width] for i in range(0, len(raw), self.width))
        return np.array([int.from_bytes(x, "little") - shift for x in fields], dtype=np.int64)


@dataclass
class _Best:
    """The best rows of a task so far, by score and then id: those without an id last."""

    most: int
    rows: list[tuple[int, bool, int, bool]] = field(default_factory=list)

    def add(self, scores: np.ndarray, ids: np.ndarray, unnamed: np.ndarray, own: np.ndarray) -> None:
        if not len(scores):
            return
        order = np.lexsort((ids, unnamed, -scores))[: self.most]
        columns = (-scores[order], unnamed[order], ids[order], own[order])
        self.rows = sorted(self.rows + list(zip(*(c.tolist() for c in columns))))[: self.most]


@dataclass(frozen=True)
class _Anchors:
    """A part of the anchors: different rows, with the scores of their positives once these are known."""

    ids: list[int]
    labels: list[int]
    rows: list[list[int]]
    bands: list[list[tuple[int, int]]]

    @property
    def largest(self) -> int:
        return max((abs(x) for row in self.rows for x in row), default=0)


def _blocks(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            ids = part.column("vec_id")
            numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
            unnamed = ids.is_null().to_numpy(zero_copy_only=False)
            yield numbers, unnamed, part.column("label").to_numpy(), _whole(part.column("vector"), dimensions)


def _positives(candidates: DataFrame, anchors: _Anchors, dimensions: int, positives: int) -> DataFrame:
    """(anchor, vec_id, score, own) of each task's best rows of the anchors' labels, the anchors themselves among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [_Best(positives + 1) for _ in anchors.ids]
        for ids, unnamed, labels, rows in _blocks(batches, dimensions):
            of_label = {label: np.flatnonzero(labels == label) for label in set(labels.tolist())}
            packed = {label: Packed(rows[at], anchors.largest) for label, at in of_label.items()}
            for i, (label, anchor) in enumerate(zip(anchors.labels, anchors.rows)):
                if label in packed:
                    at = of_label[label]
                    own = ~unnamed[at] & (ids[at] == anchors.ids[i])
                    own[own] = [row.tolist() == anchor for row in rows[at][own]]
                    best[i].add(packed[label].scores(anchor), ids[at], unnamed[at], own)
        found = [(i, None if u else v, -s, o) for i, b in enumerate(best) for s, u, v, o in b.rows]
        yield _batch("anchor int, vec_id long, score long, own boolean", found)

    return candidates.mapInArrow(run, "anchor int, vec_id long, score long, own boolean")


def _negatives(candidates: DataFrame, anchors: _Anchors, dimensions: int, negatives: int) -> DataFrame:
    """(anchor, positive, vec_id, score) of each task's best rows of other labels in the band of each positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [[_Best(negatives) for _ in bands] for bands in anchors.bands]
        for ids, unnamed, labels, rows in _blocks(batches, dimensions):
            packed = Packed(rows, anchors.largest)
            for i, bands in enumerate(anchors.bands):
                if not bands:
                    continue
                scores = packed.scores(anchors.rows[i])
                lows, highs = zip(*bands)
                at = np.flatnonzero((labels != anchors.labels[i]) & (scores >= min(lows)) & (scores <= max(highs)))
                at = at[np.lexsort((ids[at], unnamed[at], -scores[at]))]
                fall = -scores[at]
                for b, (low, high) in zip(best[i], bands):
                    # In falling order: from the first score that is not too high, down to the last not too low.
                    first = np.searchsorted(fall, -high, "left")
                    last = min(first + negatives, np.searchsorted(fall, -low, "right"))
                    taken = at[first:last]
                    b.add(scores[taken], ids[taken], unnamed[taken], np.zeros(len(taken), dtype=bool))
        found = [
            (i, p, None if u else v, -s)
            for i, bests in enumerate(best)
            for p, b in enumerate(bests)
            for s, u, v, _ in b.rows
        ]
        yield _batch("anchor int, positive int, vec_id long, score long", found)

    return candidates.mapInArrow(run, "anchor int, positive int, vec_id long, score long")


_KINDS = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split() for c in schema.split(", ")]
    columns = zip(*rows) if rows else [[] for _ in names]
    fields = pa.schema([(name, _KINDS[kind]) for name, kind in names])
    return record_batch(fields, {name: list(values) for (name, _), values in zip(names, columns)})


def _first(df: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The best ``most`` rows of each key, numbered: of a few rows from each task."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mine(
    vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor, positive and negative.

    ``vectors`` and ``anchors`` are rows (vec_id, label, vector) as ``usable`` gives them; anchors are among the vectors.  A
    score is the inner product of components floor(256 * x).  Higher scores come first, then smaller ids, then rows
    without an id.  An anchor's positives are its first rows of the same label other than itself; a positive's negatives
    are the first rows of other labels with ``low`` to ``high`` percent of its score.  Fewer, or none, where there are not
    as many.

    Rows that repeat an id are rows of their own: an anchor that occurs twice has its copy among its positives, and each of
    the two has its results.  A shorter vector counts as followed by zeros.  Scores beyond 64 bits are an error.
    """
    spark = vectors.sparkSession
    rows = vectors.count()
    tasks = max(1, min(rows // TASK_ROWS, max(4 * spark.sparkContext.defaultParallelism, rows // MOST_TASK_ROWS)))
    candidates = saved(vectors.repartition(tasks), "vectors")
    asked = saved(anchors.groupBy("vec_id", "label", "vector").agg(F.count("*").alias("times")), "anchors")
    different, longest = asked.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not different:
        return spark.createDataFrame([], _RESULT)
    dimensions = candidates.agg(F.max(F.size("vector"))).first()[0]
    parts = -(-different * max(1, longest) // PART_COMPONENTS)
    path = run_folder(spark, "negatives")
    for part in range(parts):
        own = asked.filter(F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(parts)) == part)
        _mine_part(candidates, own, dimensions, positives, negatives, low, high).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)


def _mine_part(
    candidates: DataFrame, asked: DataFrame, dimensions: int, positives: int, negatives: int, low: int, high: int
) -> DataFrame:
    """Results of a part of the anchors, which is small enough to go to all tasks."""
    spark = candidates.sparkSession
    table = asked.toArrow()
    whole = _whole(table.column("vector").combine_chunks(), dimensions) if table.num_rows else np.zeros((0, dimensions))
    ids, labels = table.column("vec_id").to_pylist(), table.column("label").to_pylist()
    anchors = _Anchors(ids, labels, whole.tolist(), [])
    # One row more than is asked for: the anchor itself, where it is among the first, is taken out.
    found = _first(_positives(candidates, anchors, dimensions, positives), ["anchor"], positives + 1).orderBy(
        "anchor", "rank"
    )
    firsts: list[list[tuple[int | None, int]]] = [[] for _ in ids]
    itself = [False] * len(ids)
    for r in found.toLocalIterator():
        if r["own"] and not itself[r["anchor"]]:
            itself[r["anchor"]] = True
        elif len(firsts[r["anchor"]]) < positives:
            firsts[r["anchor"]].append((r["vec_id"], r["score"]))
    # low * score <= 100 * negative <= high * score, in whole numbers.
    bands = [[(-(-low * s // 100), high * s // 100) for _, s in own] for own in firsts]
    anchors = _Anchors(ids, labels, anchors.rows, bands)
    best = _first(_negatives(candidates, anchors, dimensions, negatives), ["anchor", "positive"], negatives)
    named = spark.createDataFrame(
        [
            (a, p, ids[a], positive, score, times)
            for a, times in enumerate(table.column("times").to_pylist())
            for p, (positive, score) in enumerate(firsts[a])
        ],
        "anchor int, positive int, anchor_id long, positive_id long, positive_score long, times long",
    )
    joined = best.join(named, ["anchor", "positive"])
    return joined.select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
        F.explode(F.sequence(F.lit(1).cast("long"), "times")).alias("copy"),
    ).drop("copy")


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by 100.

    Where vec_id is divisible by 7, the label counts as the next of ten.
    """
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = usable(embeddings).withColumn("label", label)
    return mine(rows, rows.filter(F.col("vec_id") % 100 == 0))
