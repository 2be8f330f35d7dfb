"""Toxicity of a text: subword-bag embeddings, averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams, each with a vector, so an unseen misspelling shares most vectors with the
word it comes from.  Vectors are averaged over windows of words, and a text is as toxic as its most toxic window: a few
words do not drown in a long text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import crc32_of, drawn_at, least_hash, record_batch, small_batches, texts_of

#: Labelled rows that the model is fitted on, half of each label if there are enough, and bytes of their texts.
SAMPLE_ROWS = 2400
SAMPLE_BYTES = 8 << 20
BUCKETS = 1 << 16
DIMENSIONS = 8
SHORTEST, LONGEST = 3, 5
#: Sampled texts that must share an n-gram before it is learned.
LEAST_TEXTS = 3
WINDOW, STEP = 8, 4
#: Windows of a text without the label that each round learns from: those it finds most toxic.
HARD_WINDOWS = 3
#: Windows that the fit takes at a time, and words whose vectors it sums at a time.
BLOCK_WINDOWS = 1 << 15
BLOCK_WORDS = 1 << 13
#: Bytes of words whose n-grams are hashed together; a longer word is taken apart by itself.
BLOCK_BYTES = 1 << 18

_WARM_UP, _ROUNDS = 3, 40
_RATE = 0.5
_DAMPING = 0.2


def subwords(word: str) -> list[int]:
    """Buckets of the word itself and of its n-grams, with marks for where it begins and ends."""
    marked = f"<{word}>"
    if marked.isascii():
        marked = marked.encode()
        grams = {marked[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)}
        return [crc & (BUCKETS - 1) for crc in map(zlib.crc32, grams | {marked})]
    grams = {marked[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)}
    return [zlib.crc32(g.encode("utf-8", "replace")) & (BUCKETS - 1) for g in grams | {marked}]


#: The table of the byte-wise CRC-32.
_CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], dtype=np.uint32)


def word_values(words: list[str], pull: np.ndarray) -> np.ndarray:
    """Sum of pulls (real) and number of subwords (imaginary) of every word."""
    marked = [f"<{w}>".encode("utf-8", "replace") for w in words]
    ends = np.cumsum(np.fromiter(map(len, marked), np.int64, len(marked)))
    found = np.empty(len(words), dtype=np.complex128)
    start = 0
    while start < len(words):
        held = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, held + BLOCK_BYTES, "right"))
        if stop > start:
            found[start:stop], again = _block_values(marked[start:stop], ends[start:stop] - held, pull)
            again = (again + start).tolist()
        else:
            stop, again = start + 1, [start]
        for i in again:
            grams = subwords(words[i])
            found[i] = complex(pull[grams].sum(), len(grams))
        start = stop
    return found


def _block_values(marked: list[bytes], ends: np.ndarray, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of words that hold no n-gram twice, and the places of those that may: their values are not right.

    The CRC-32 of all n-grams that begin at a character are one walk of ``LONGEST`` characters, for all of them at once.
    """
    held = np.frombuffer(b"".join(marked), np.uint8)
    first = np.flatnonzero((held & 0xC0) != 0x80)
    widths = np.diff(first, append=len(held))
    begins = np.searchsorted(first, ends - np.diff(ends, prepend=0))
    lengths = np.diff(begins, append=len(first))
    owners = np.repeat(np.arange(len(marked)), lengths)
    left = np.repeat(begins + lengths, lengths) - np.arange(len(first))
    crc = np.full(len(first), 0xFFFFFFFF, dtype=np.uint32)
    # Bytes of the characters from the k-th on, and which of them have a second, third and fourth one.
    wide = [np.flatnonzero(widths > n) for n in range(1, 4)]
    sums, counts = np.zeros(len(marked)), np.zeros(len(marked))
    again = np.empty(0, dtype=np.int64)
    for n in range(1, LONGEST + 1):
        own = max(0, len(first) - n + 1)
        crc = crc[:own]
        crc = _CRC[(crc ^ held[first[n - 1 :]]) & 0xFF] ^ (crc >> 8)
        for more, places in enumerate(wide, 1):
            places = places[np.searchsorted(places, n - 1) :]
            part = crc[places - n + 1]
            crc[places - n + 1] = _CRC[(part ^ held[first[places] + more]) & 0xFF] ^ (part >> 8)
        if n >= SHORTEST:
            inside = np.flatnonzero(left[:own] >= n)
            grams, of = ~crc[inside], owners[inside]
            sums += np.bincount(of, pull[grams & (BUCKETS - 1)], len(marked))
            counts += np.maximum(lengths - n + 1, 0)
        if n == SHORTEST:
            # What repeats a longer n-gram repeats a shortest one.
            keys = np.sort((of.astype(np.uint64) << 32) | grams)
            again = np.unique(keys[1:][keys[1:] == keys[:-1]] >> 32).astype(np.int64)
    # A word of up to ``LONGEST`` characters with its marks is an n-gram of itself.
    long = np.flatnonzero(lengths > LONGEST)
    whole = np.fromiter((zlib.crc32(marked[i]) for i in long.tolist()), np.int64, len(long))
    sums[long] += pull[whole & (BUCKETS - 1)]
    counts[long] += 1
    return sums + 1j * counts, again


#: Runs of letters and digits.
words_of = re.compile(r"[^\W_]+").findall


def tokens_of(text: str) -> list[str]:
    """What white space separates, in lower case; a token right after its equal counts once."""
    return [token for token, _ in groupby(text.lower().split())]


def window_starts(n: int) -> list[int]:
    """Where the windows over ``n`` words begin; every word is in one."""
    return list(range(0, max(1, n - WINDOW + STEP), STEP))


@dataclass(frozen=True)
class Model:
    """What a trained model comes to for scoring: one number per bucket and the bias."""

    pull: np.ndarray
    bias: float


class _Bags:
    """Windows of the sampled texts over a dictionary of their words."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        sequences = [
            [numbers.setdefault(w, len(numbers)) for t in tokens_of(text) for w in words_of(t)] for text in texts
        ]
        bags = [np.array(subwords(w), dtype=np.int32) for w in numbers]
        self.grams = np.concatenate([np.empty(0, dtype=np.intp), *bags])
        self.widths = np.array([len(bag) for bag in bags])
        self.owners = np.repeat(np.arange(len(bags)), self.widths)
        self.words = np.array([w for s in sequences for w in s], dtype=np.intp)
        texts_with = np.zeros(BUCKETS, dtype=np.int64)
        for s in sequences:
            texts_with[np.concatenate([self.grams[:0], *(bags[w] for w in set(s))])] += 1
        self.shared = (texts_with >= LEAST_TEXTS)[:, None]
        begins, ends, docs, at = [], [], [], 0
        for doc, s in enumerate(sequences):
            for start in window_starts(len(s)):
                begins.append(at + start)
                ends.append(at + min(len(s), start + WINDOW))
                docs.append(doc)
            at += len(s)
        self.begins, self.ends, self.docs = map(np.array, (begins, ends, docs))

    def averages(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Average vector and number of subwords of every window."""
        ends = np.cumsum(self.widths)
        of_word = np.empty((len(self.widths), vectors.shape[1]))
        for at in range(0, len(self.widths), BLOCK_WORDS):
            block = slice(at, at + BLOCK_WORDS)
            starts = ends[block] - self.widths[block]
            grams = self.grams[starts[0] : ends[block][-1]]
            of_word[block] = np.add.reduceat(vectors[grams], starts - starts[0], axis=0)
        found = np.empty((len(self.begins), vectors.shape[1]))
        counts = np.empty(len(self.begins))
        for block in self._blocks():
            first, last = self.begins[block].min(), self.ends[block].max()
            words = self.words[first:last]
            sums = np.zeros((len(words) + 1, vectors.shape[1]))
            np.cumsum(of_word[words], axis=0, out=sums[1:])
            sizes = np.concatenate([[0], np.cumsum(self.widths[words])])
            begins, ends = self.begins[block] - first, self.ends[block] - first
            counts[block] = np.maximum(sizes[ends] - sizes[begins], 1)
            found[block] = (sums[ends] - sums[begins]) / counts[block][:, None]
        return found, counts

    def _blocks(self) -> Iterator[slice]:
        for start in range(0, len(self.begins), BLOCK_WINDOWS):
            yield slice(start, start + BLOCK_WINDOWS)

    def spread(self, windows: np.ndarray, pulls: np.ndarray) -> np.ndarray:
        """Sum over the windows of their pull on each bucket."""
        of_word = np.zeros((len(self.widths), pulls.shape[1]))
        for start in range(0, len(windows), BLOCK_WINDOWS):
            part = windows[start : start + BLOCK_WINDOWS]
            lengths = self.ends[part] - self.begins[part]
            owner = np.repeat(np.arange(start, start + len(part)), lengths)
            places = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            words = self.words[np.repeat(self.begins[part], lengths) + places]
            for d in range(pulls.shape[1]):
                of_word[:, d] += np.bincount(words, pulls[owner, d], len(self.widths))
        of_bucket = np.zeros((BUCKETS, pulls.shape[1]))
        for d in range(pulls.shape[1]):
            of_bucket[:, d] = np.bincount(self.grams, of_word[self.owners, d], BUCKETS)
        return of_bucket


def fit(texts: list[str], labels: np.ndarray) -> Model:
    """Vectors and softmax by descent with per-coordinate rates; labels are 0 or 1.

    The first rounds take all windows of a text by its label, the others its most toxic ones.
    """
    bags = _Bags(texts)
    rng = np.random.default_rng(0)
    vectors = rng.uniform(-0.01, 0.01, (BUCKETS, DIMENSIONS)) * bags.shared
    # The two labels begin on opposite sides, so that the first steps of the vectors already tell them apart.
    softmax = np.stack([np.full(DIMENSIONS, -0.5), np.full(DIMENSIONS, 0.5)], axis=1)
    softmax += rng.uniform(-0.1, 0.1, softmax.shape)
    bias = np.zeros(2)
    slopes: list[np.ndarray] = []
    by_doc = labels[bags.docs]
    most = np.array([max(1, (labels == label).sum()) for label in (0, 1)])
    for turn in range(_WARM_UP + _ROUNDS):
        averages, counts = bags.averages(vectors)
        logits = averages @ softmax + bias
        if turn < _WARM_UP:
            chosen = np.arange(len(by_doc))
            weights = 1 / np.bincount(bags.docs, minlength=len(labels))[bags.docs]
        else:
            order = np.lexsort((-(logits[:, 1] - logits[:, 0]), bags.docs))
            docs = bags.docs[order]
            first = np.concatenate([[True], docs[1:] != docs[:-1]])
            rank = np.arange(len(docs)) - np.maximum.accumulate(np.where(first, np.arange(len(docs)), 0))
            chosen = order[rank < np.where(by_doc[order] == 1, 1, HARD_WINDOWS)]
            weights = np.ones(len(chosen))
        picked = by_doc[chosen]
        weights = weights / most[picked]
        shares = np.exp(logits[chosen] - logits[chosen].max(axis=1, keepdims=True))
        shares /= shares.sum(axis=1, keepdims=True)
        error = shares
        error[np.arange(len(chosen)), picked] -= 1
        error *= weights[:, None]
        pulls = (error @ softmax.T) / counts[chosen][:, None]
        steps = [bags.spread(chosen, pulls) * bags.shared, averages[chosen].T @ error, error.sum(axis=0)]
        if not slopes:
            # What is pulled least by the first round, and so is mostly chance, moves least.
            slopes = [np.full(x.shape, (_DAMPING * np.abs(x).max()) ** 2 + 1e-12) for x in steps]
        for value, slope, step in zip((vectors, softmax, bias), slopes, steps):
            slope += step * step
            value -= _RATE * step / np.sqrt(slope)
    return Model((vectors @ (softmax[:, 1] - softmax[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def train(docs: DataFrame, labels: DataFrame, learned: Column, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Model from about ``sample_rows`` of the labelled rows where ``learned`` holds, their whole texts.

    ``learned`` looks at doc_id alone.  Rows without text or label are left out; ids pick the sample, and only texts and
    ``toxic`` enter the model.
    None unless both labels occur.
    """
    labelled = labels.select("doc_id", "toxic").filter(learned & F.col("toxic").isin(0, 1))
    counted = labelled.groupBy("toxic").agg(F.count("*").alias("count"), least_hash("doc_id").alias("least"))
    found = {r["toxic"]: (r["count"], r["least"]) for r in counted.collect()}
    if set(found) != {0, 1}:
        return None
    mean = docs.agg(F.avg(F.octet_length("text"))).first()[0] or 1.0
    drawn = F.lit(False)
    for label, (rows, least) in found.items():
        rate = min(1.0, sample_rows / 2 / rows, SAMPLE_BYTES / 2 / (rows * max(1.0, mean)))
        drawn = drawn | ((F.col("toxic") == label) & drawn_at(rate, least, "doc_id"))
    # Ids are drawn before texts are fetched: so few that they are sent to every task, and no text is shuffled.
    chosen = F.broadcast(labelled.filter(drawn).limit(2 * sample_rows))
    texts = docs.select("doc_id", "text").filter(F.col("text").isNotNull())
    rows = texts.join(chosen, "doc_id").select("text", "toxic").limit(2 * sample_rows).collect()
    for label in {0, 1} - {r["toxic"] for r in rows}:
        # None of the drawn rows has a text: only rows with one, by the order of the same hash.
        own = texts.join(labelled.filter(F.col("toxic") == label), "doc_id")
        rows += own.orderBy(F.xxhash64("doc_id")).limit(max(1, sample_rows // 2)).select("text", "toxic").collect()
    targets = np.array([r["toxic"] for r in rows], dtype=np.intp)
    if len(set(targets.tolist())) < 2:
        return None
    return fit([r["text"] for r in rows], targets)


class Scorer:
    """Scores whole texts; each distinct token of a batch is taken apart once."""

    def __init__(self, model: Model | None):
        self.model = model

    def __call__(self, text: str) -> float:
        return self.scores([text])[0]

    def scores(self, texts: list[str]) -> list[float]:
        """The score of every text: of its most toxic window, 0 without a word.  Tokens are split and looked up together."""
        if self.model is None or not texts:
            return [0.0] * len(texts)
        joined = pa.array([" ".join(t.lower().split()) for t in texts], pa.large_string())
        split = pc.split_pattern(joined, " ")
        offsets = split.offsets.to_numpy()
        numbered = pc.dictionary_encode(split.flatten())
        parts = list(map(words_of, numbered.dictionary.to_numpy(zero_copy_only=False).tolist()))
        which = numbered.indices.to_numpy()
        # A token right after its equal counts once.
        counts = np.ones(len(which), dtype=bool)
        counts[1:] = which[1:] != which[:-1]
        counts[offsets[:-1]] = True
        owners = np.repeat(np.arange(len(texts)), np.diff(offsets))[counts]
        which = which[counts]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = word_values(list(chain.from_iterable(parts)), self.model.pull)
        lengths = sizes[which]
        ends = np.cumsum(lengths)
        places = np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[which] - ends + lengths, lengths)
        words = np.concatenate([flat[places], np.zeros(WINDOW)])
        own = np.bincount(owners, lengths, len(texts)).astype(np.int64)
        return self._most_toxic(words, own).tolist()

    def _most_toxic(self, words: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Scores of texts that have ``own`` words each, one after the other."""
        begins = np.cumsum(own) - own
        windows = np.where(own > 0, -(-np.maximum(1, own - WINDOW + STEP) // STEP), 0)
        of = np.repeat(np.arange(len(own)), windows)
        starts = begins[of] + STEP * (np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows))
        stops = np.minimum(starts + WINDOW, (begins + own)[of])
        best = np.full(len(own), -np.inf)
        for at in range(0, len(of), BLOCK_WINDOWS):
            block = slice(at, at + BLOCK_WINDOWS)
            inside = starts[block, None] + np.arange(WINDOW)
            sums = np.where(inside < stops[block, None], words[inside], 0).sum(axis=1)
            np.maximum.at(best, of[block], sums.real / np.maximum(sums.imag, 1))
        scores = 1 / (1 + np.exp(-np.clip(best + self.model.bias, -500, 500)))
        return np.where(own > 0, scores, 0.0)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score) of every whole text, 0 to 1.

    A null or empty text, or one without words, has score 0, as all have without a model.  Repeated rows are repeated.
    """
    schema = pa.schema({"doc_id": pa.int64(), "score": pa.float64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in small_batches(batches, "text"):
            found = scorer.scores(texts_of(batch, "text"))
            yield record_batch(schema, {"doc_id": batch.column("doc_id"), "score": found})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def toxicity_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document's held_out, score and predicted; labels of rows held out are not learned."""
    remainder = crc32_of("doc_id") % 5
    found = score(docs, train(docs, labels, remainder != 0))
    return found.select(
        "doc_id",
        F.coalesce(remainder == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
