"""Mixture-controlled packing: deficit round-robin over source queues, and sequences of a fixed length.

Each source is a queue of its documents, in the order of a hash of their ids and tokens.  A window is a run of sequences.  Every
window takes from each queue its target share of the window's tokens; what rounding leaves over or short is the queue's
deficit and is carried into the next window.  When a queue runs dry, the others share its part in proportion, and a new
phase begins.

Within a phase, the tokens that the first queues have given before window w are together floor(K L w / T): L is a window's
length, T the phase's tokens and K those of these queues.  So the deficits at the start of any window are known in closed
form, below one token for each queue, and every task begins with the right ones wherever its documents stand.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import record_batch, saved, small_batches, texts_of
from tillroll.llm.pretokens import pre_tokens

SEQUENCE = 1024
#: Sequences of a window: the mixture holds in every run of so many.
WINDOW_SEQUENCES = 64
#: Queues; the smallest sources beyond so many share the last one, as do those below one token in a window.  A source with
#: a weight always has its own.
MOST_QUEUES = 256
#: Documents that a task numbers together, at most so many groups of them.
BUCKET_DOCS = 400
MOST_BUCKETS = 1 << 16

Piece = tuple[int, int, int, int]


@dataclass(frozen=True)
class Phase:
    """Tokens that each queue gives while the set of queues with tokens left does not change."""

    base: int
    first: tuple[int, ...]
    before: tuple[int, ...]

    @property
    def tokens(self) -> int:
        return self.before[-1]


def phases(totals: list[int], window: int, weights: list[float] | None = None) -> list[Phase]:
    """The phases of queues with these tokens.  Without weights all queues run dry together, in one phase.

    What a queue gives in a phase without coming to one token in each window goes ahead of the others.

    With weights, a queue gives tokens in proportion to its weight until it is empty.  A queue of weight 0 waits until
    the others are empty.
    """
    given, base, found = [0] * len(totals), 0, []
    while any(g < t for g, t in zip(given, totals)):
        rest = [t - g for g, t in zip(given, totals)]
        rates = list(rest) if weights is None else [w if r else 0 for w, r in zip(weights, rest)]
        if not any(rates):
            rates = list(rest)
        time = min(r / w for r, w in zip(rest, rates) if w)
        takes = [min(r, round(w * time)) for r, w in zip(rest, rates)]
        # The queue that runs dry first gives all it has, whatever rounding says.
        takes = [r if w and r / w == time else t for r, w, t in zip(rest, rates, takes)]
        few = [i for i, t in enumerate(takes) if t and t * window < sum(takes)]
        parts = [{i: takes[i]} for i in few] + [{i: t for i, t in enumerate(takes) if i not in few}]
        for part in parts:
            before = list(accumulate((part.get(i, 0) for i in range(len(totals))), initial=0))
            found.append(Phase(base, tuple(given), tuple(before)))
            given = [g + part.get(i, 0) for i, g in enumerate(given)]
            base += before[-1]
    return found


class Schedule:
    """Where the tokens of every queue go."""

    def __init__(self, found: list[Phase], window: int):
        self.phases, self.window = found, window

    def _sum(self, phase: Phase, queues: int, w: int) -> int:
        """Tokens that the first ``queues`` queues give before window ``w`` of the phase."""
        return phase.before[queues] * min(self.window * w, phase.tokens) // phase.tokens

    def runs(self, queue: int, start: int, length: int) -> Iterator[tuple[int, int, int]]:
        """(place in the queue, place among all tokens, length) of what ``length`` tokens of a queue are cut into."""
        stop = start + length
        firsts = [p.first[queue] for p in self.phases]
        i = max(0, bisect_right(firsts, start) - 1)
        while start < stop:
            phase = self.phases[i]
            given = phase.before[queue + 1] - phase.before[queue]
            x = start - phase.first[queue]
            if x >= given:
                i += 1
                continue
            # The window of token x: a guess that is off by one at most, then the exact one.
            w = x * phase.tokens // (given * self.window)
            while self._given(phase, queue, w) > x:
                w -= 1
            while self._given(phase, queue, w + 1) <= x:
                w += 1
            taken = min(stop - start, self._given(phase, queue, w + 1) - x)
            earlier = self._sum(phase, queue, w + 1) - self._sum(phase, queue, w)
            inside = earlier + x - self._given(phase, queue, w)
            yield start, phase.base + w * self.window + inside, taken
            start += taken

    def _given(self, phase: Phase, queue: int, w: int) -> int:
        return self._sum(phase, queue + 1, w) - self._sum(phase, queue, w)

    def pieces(self, queue: int, start: int, length: int, sequence: int) -> Iterator[Piece]:
        """(place in the queue, sequence, offset, length): the runs, cut where sequences end."""
        for place, at, size in self.runs(queue, start, length):
            while size:
                offset = at % sequence
                part = min(size, sequence - offset)
                yield place, at // sequence, offset, part
                place, at, size = place + part, at + part, size - part


def _tokens(docs: DataFrame, tokenizer: str, end: int) -> DataFrame:
    """(doc_id, source, n, ids) of every document, with the end id; ids as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pre_tokens(tokenizer)
        kind = _id_type(coder.vocab_size)
        schema = pa.schema({"doc_id": pa.int64(), "source": pa.string(), "n": pa.int64(), "ids": pa.binary()})
        stop = np.array([end], dtype=np.uint32)
        for batch in small_batches(batches, "text"):
            found = [np.concatenate([ids, stop]).astype(kind) for ids in coder.encode_all(texts_of(batch, "text"))]
            yield record_batch(
                schema,
                {
                    "doc_id": batch.column("doc_id"),
                    "source": batch.column("source"),
                    "n": [len(x) for x in found],
                    "ids": [x.tobytes() for x in found],
                },
            )

    texts = docs.select("doc_id", "text", F.col("source").cast("string").alias("source"))
    return texts.mapInArrow(run, "doc_id long, source string, n long, ids binary")


def _id_type(vocabulary: int) -> str:
    """Two bytes an id where they do."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _queues(
    tokens: DataFrame, window: int, weights: Mapping[str, float] | None = None
) -> tuple[list[str | None], list[int]]:
    """Sources with a queue of their own, largest first, and the tokens of every queue; the last takes the rest.

    With weights, each source that has one comes first, whatever its size, and what is left of the rest has a queue of
    its own.
    """
    by_source = tokens.groupBy("source").agg(F.sum("n").alias("n"))
    whole = by_source.agg(F.sum("n")).first()[0] or 0
    named, others = [], by_source
    if weights is not None:
        asked = [s for s, w in weights.items() if w and s is not None]
        weighted = F.coalesce(F.col("source").isin(asked), F.lit(False)) if asked else F.lit(False)
        weighted = weighted | F.col("source").isNull() if weights.get(None) else weighted
        named = by_source.filter(weighted).orderBy(F.desc("n"), "source").collect()
        others = by_source.filter(~weighted)
    top = others.orderBy(F.desc("n"), "source").limit(max(0, MOST_QUEUES - 1 - len(named))).collect()
    own = named + [r for r in top if r["n"] * window >= whole]
    totals = [r["n"] for r in own]
    rest = whole - sum(totals)
    if rest and (weights is not None or rest * window >= whole or not totals):
        totals.append(rest)
    elif rest:
        # Too few for a token in every window: they join the smallest queue, which keeps its source.
        totals[-1] += rest
    return [r["source"] for r in own], totals


def pack(
    docs: DataFrame,
    tokenizer: str,
    end: int,
    sequence: int = SEQUENCE,
    window_sequences: int = WINDOW_SEQUENCES,
    weights: Mapping[str, float] | None = None,
) -> DataFrame:
    """Pieces of all documents, packed into sequences; one row per piece.

    A document's tokens are its ids and then ``end``; null and empty texts have that alone.  Pieces are cut where windows
    and sequences end, and every sequence but the last is full, so only the last is padded.  ``weights`` are target
    proportions by source (0 for those not named); without them, the corpus's own.  A null source is a source.
    Rows without an id, and rows that repeat one, are placed by their tokens as well.  Repeated rows stand beside each other in
    their queue and are packed as often as they occur.

    Tokens are written once; the tokens before a document are the sum over groups of documents before its own, and a
    running sum within the group, which a hash of the ids keeps small however large a source is.
    """
    spark = docs.sparkSession
    tokens = saved(_tokens(docs, tokenizer, end), "tokens")
    window = sequence * window_sequences
    own, totals = _queues(tokens, window, weights)
    if not totals:
        return spark.createDataFrame([], PIECES)
    shares = None
    if weights is not None:
        named = [weights.get(s, 0.0) for s in own]
        shares = named + [0.0] * (len(totals) - len(named))
    schedule = Schedule(phases(totals, window, shares), window)

    last = len(totals) - 1
    names = [s for s in own if s is not None]
    numbers = [i for i, s in enumerate(own) if s is not None]
    at = F.array_position(F.lit(names), F.col("source")) if names else F.lit(0)
    place = F.get(F.lit(numbers), (at - 1).cast("int")) if names else F.lit(None).cast("int")
    null_place = own.index(None) if None in own else last
    queue = F.when(F.col("source").isNull(), F.lit(null_place)).when(at > 0, place).otherwise(F.lit(last))
    rows = tokens.count()
    bits = min(MOST_BUCKETS, max(1, rows // BUCKET_DOCS)).bit_length() - 1
    order = F.xxhash64("doc_id", "ids")
    bucket = F.expr(f"shiftrightunsigned(order, {64 - bits})") if bits else F.lit(0).cast("long")
    placed = tokens.withColumns({"queue": queue.cast("int"), "order": order}).withColumn("bucket", bucket)

    # Tokens before every bucket of its queue.  Buckets of a queue are few and bounded.
    before = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("queue", "bucket").agg(F.sum("n").alias("bucket_tokens"))
    bases = sums.select("queue", "bucket", F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0)).alias("base"))
    # The hash orders as an unsigned number would, so that order and bucket agree.
    unsigned = F.expr("order ^ -9223372036854775808")
    inside = Window.partitionBy("queue", "bucket").orderBy(unsigned, "doc_id", "n", "ids")
    running = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    based = placed.join(bases, ["queue", "bucket"]).select(
        "doc_id", "queue", "n", "ids", (F.col("base") + F.coalesce(running, F.lit(0))).alias("place")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _id_type(pre_tokens(tokenizer).vocab_size)
        for batch in small_batches(batches, "ids"):
            yield record_batch(_SCHEMA, _cut(batch, schedule, sequence, kind))

    return based.mapInArrow(run, PIECES)


PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, queue int"
)
_SCHEMA = pa.schema(
    [(c.split()[0], pa.int32() if c.endswith("int") else pa.int64()) for c in PIECES.split(", ")]
)


def _cut(batch: pa.RecordBatch, schedule: Schedule, sequence: int, kind: str) -> dict[str, list[int | None]]:
    out: dict[str, list[int | None]] = {f.name: [] for f in _SCHEMA}
    columns = [batch.column(c).to_pylist() for c in ("doc_id", "queue", "n", "place", "ids")]
    for doc_id, queue, n, first, raw in zip(*columns):
        ids = np.frombuffer(raw, kind).astype("<u4")
        for place, number, offset, length in schedule.pieces(queue, first, n, sequence):
            start = place - first
            crc = zlib.crc32(ids[start : start + length])
            values = (doc_id, start, length, crc, n, number, offset, queue)
            for column, value in zip(out.values(), values):
                column.append(value)
    return out
