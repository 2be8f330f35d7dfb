"""Language of a text by error-correcting output codes over character n-grams.

Each language has a codeword.  One binary classifier per bit, linear over hashed n-grams, predicts that bit; decoding
takes the codeword with the least loss, each classifier weighted by how well it knows the language, so a few wrong bits
do not change the answer.  A text whose best codeword does not beat all others together is flagged as ambiguous.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import crc32_of, hash_bound, record_batch, small_batches, texts_of

#: Labelled rows that the classifiers are fitted on, dealt evenly to the languages.
SAMPLE_ROWS = 2400
#: Languages learned, those with the most rows first: more than are in use with any amount of text.
MOST_LANGUAGES = 4096
BUCKETS = 1 << 13
LONGEST = 4
#: Words of the short extract of each sampled text, from which short texts are learned.
EXTRACT_WORDS = 8
UNKNOWN = "und"
#: Up to so many languages, all different splits in two are used as bits.
EXHAUSTIVE = 6

_ROUNDS = 120
#: Sampled vectors that are unpacked at a time.
_BLOCK = 512
_DECAY = 1e-5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Lower-case code point of every letter, and 32 for all else; made once per worker."""
    table = np.full(0x110000, 32, dtype=np.uint64)
    for c in range(0x110000):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def counts(text: str) -> np.ndarray | None:
    """Hashed counts of the n-grams of the whole text, as a unit vector of their square roots; None without a letter."""
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    blank = codes == 32
    if blank.all():
        return None
    codes = np.concatenate([[np.uint64(32)], codes[~(blank & np.roll(blank, 1))], [np.uint64(32)]])
    found = np.zeros(BUCKETS)
    grams = codes
    for n in range(1, LONGEST + 1):
        if n > 1:
            grams = grams[:-1] * _MULTIPLIER + codes[n - 1 :]
        hashed = (grams + np.uint64(n)) * _MULTIPLIER
        hashed ^= hashed >> np.uint64(29)
        places = ((hashed * _MULTIPLIER) >> np.uint64(64 - 13)).astype(np.intp)
        found += np.bincount(places, minlength=BUCKETS)
        if len(grams) < 2:
            break
    roots = np.sqrt(found)
    return (roots / np.linalg.norm(roots)).astype(np.float32)


def codewords(languages: int) -> np.ndarray:
    """One row of -1 and 1 per language: every split in two for few languages, else the best of some random codes."""
    if languages <= EXHAUSTIVE:
        splits = range(1, 2 ** (languages - 1))
        columns = [[1 if i == 0 else -1 if s >> (i - 1) & 1 else 1 for i in range(languages)] for s in splits]
        return np.array(columns, dtype=np.int8).T.reshape(languages, -1)
    bits, rng = int(np.ceil(10 * np.log2(languages))), np.random.default_rng(0)
    best, farthest = None, -1
    for _ in range(max(1, min(50, 4 * MOST_LANGUAGES // languages))):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), (languages, bits))
        same = code.astype(np.float32) @ code.T.astype(np.float32)
        np.fill_diagonal(same, -bits)
        distance = (bits - same.max()) / 2
        if distance > farthest and (np.abs(code.sum(axis=0, dtype=int)) < languages).all():
            best, farthest = code, distance
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    code: np.ndarray
    trust: np.ndarray
    weights: np.ndarray
    bias: np.ndarray

    def decode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest language of each row, and its share of the likelihood."""
        margins = vectors @ self.weights + self.bias
        # A bit's loss depends on its sign in the code alone, so the weighted sums are two products.
        distance = np.logaddexp(0, -margins) @ np.where(self.code > 0, self.trust, 0).T
        distance += np.logaddexp(0, margins) @ np.where(self.code < 0, self.trust, 0).T
        shares = np.exp(distance.min(axis=1, keepdims=True) - distance)
        best = shares.argmax(axis=1)
        return best, 1 / shares.sum(axis=1)


def fit(counted: np.ndarray, labels: np.ndarray, languages: tuple[str, ...]) -> Model:
    """Logistic classifiers of every bit of the code, by full-batch descent with momentum.

    ``counted`` holds the vectors in bytes, up to a factor; a block of them at a time becomes unit vectors.
    """
    code = codewords(len(languages))
    targets = code[labels].astype(np.float32)
    share = np.bincount(labels, minlength=len(languages)).astype(np.float32)
    weight = (1 / (len(languages) * share))[labels][:, None]
    weights = np.zeros((counted.shape[1], code.shape[1]), dtype=np.float32)
    bias = np.zeros(code.shape[1], dtype=np.float32)
    speed, bias_speed = np.zeros_like(weights), np.zeros_like(bias)
    blocks = [slice(i, i + _BLOCK) for i in range(0, len(counted), _BLOCK)]
    lengths = [np.sqrt((counted[b].astype(np.float32) ** 2).sum(axis=1, keepdims=True)) for b in blocks]

    def margins() -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
        for block, length in zip(blocks, lengths):
            vectors = counted[block].astype(np.float32)
            vectors /= np.maximum(length, 1e-9)
            yield block, vectors, vectors @ weights + bias

    for _ in range(_ROUNDS):
        slope, bias_slope = -_DECAY * weights, np.zeros_like(bias)
        for block, vectors, margin in margins():
            pull = weight[block] * targets[block] / (1 + np.exp(np.clip(targets[block] * margin, -30, 30)))
            slope += vectors.T @ pull
            bias_slope += pull.sum(axis=0)
        speed = 0.9 * speed + 20 * slope
        bias_speed = 0.9 * bias_speed + bias_slope
        weights += speed
        bias += bias_speed
    right = np.concatenate([np.sign(margin) == targets[block] for block, _, margin in margins()]).astype(np.float32)
    trust = np.zeros(code.shape)
    np.add.at(trust, labels, right)
    trust /= share[:, None]
    trust /= np.maximum(trust.mean(axis=1, keepdims=True), 1e-9)
    return Model(languages, code, trust, weights, bias)


def _vectors(rows: DataFrame) -> DataFrame:
    """(lang, vector) of the whole text and of a short extract of it, for rows (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema({"lang": pa.string(), "vector": pa.binary()})
        for batch in small_batches(batches, "text"):
            langs, found = [], []
            for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch, "text")):
                words = text.split()
                start = len(words) // 3
                for part in (text, " ".join(words[start : start + EXTRACT_WORDS])):
                    vector = counts(part)
                    if vector is not None:
                        langs.append(lang)
                        found.append((vector * 255).round().astype(np.uint8).tobytes())
            yield record_batch(schema, {"lang": langs, "vector": found})

    return rows.select("lang", "text").mapInArrow(run, "lang string, vector binary")


def sampled(docs: DataFrame, learned: Column, sample_rows: int = SAMPLE_ROWS) -> DataFrame | None:
    """(lang, text) of the rows to learn from: of each language, the same number of different rows of least hash.

    The hash is that of id and text, so rows that repeat an id are drawn by their texts, equal rows count once, and the same
    rows are drawn however they are read.  None without a row that may be learned from.
    """
    labelled = docs.filter(learned & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("doc_id", "text").alias("hash")
    )
    counted = labelled.groupBy("lang").agg(F.count("*").alias("count"), F.min("hash").alias("least"))
    found = counted.orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    if not found:
        return None
    quota = max(2, sample_rows // len(found))
    # Hashes up to which there are about twice the quota of rows; one row per language, of which there are few.
    bounds = [(r["lang"], max(r["least"], hash_bound(2 * quota / r["count"]))) for r in found]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bounds, "lang string, bound long"))
    drawn = labelled.join(bounds, "lang").filter("hash <= bound").dropDuplicates(["lang", "hash"])
    nearest = Window.partitionBy("lang").orderBy("hash")
    return drawn.withColumn("place", F.row_number().over(nearest)).filter(F.col("place") <= quota).select("lang", "text")


def train(docs: DataFrame, learned: Column, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """Model from a sample of about ``sample_rows`` of the rows where ``learned`` holds and text and lang are known.

    Only text and lang enter the model; ids and texts pick the sample.  Languages are counted over all rows.  None without rows.
    """
    rows = sampled(docs, learned, sample_rows)
    if rows is None:
        return None
    table = _vectors(rows).toArrow()
    # In a fixed order, so that the same rows give the same model however the tasks end.
    found = sorted(
        (lang, hashlib.md5(vector.as_buffer()).digest(), i)
        for i, (lang, vector) in enumerate(zip(table.column("lang").to_pylist(), table.column("vector")))
    )
    if not found:
        return None
    counted = np.empty((len(found), BUCKETS), dtype=np.uint8)
    for to, (_, _, i) in enumerate(found):
        counted[to] = np.frombuffer(table.column("vector")[i].as_buffer(), np.uint8)
    del table
    languages = tuple(sorted({lang for lang, _, _ in found}))
    number = {lang: i for i, lang in enumerate(languages)}
    return fit(counted, np.array([number[lang] for lang, _, _ in found]), languages)


class _Judge:
    """Predictions for batches of texts."""

    def __init__(self, model: Model | None):
        self.model = model

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
        vectors = [counts(t) for t in texts] if self.model else [None] * len(texts)
        known = [i for i, v in enumerate(vectors) if v is not None]
        langs, scores, unsure = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
        if known:
            best, share = self.model.decode(np.stack([vectors[i] for i in known]))
            for i, b, s in zip(known, best.tolist(), share.tolist()):
                langs[i], scores[i], unsure[i] = self.model.languages[b], s, s < 0.5
        return langs, scores, unsure


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) of every whole text.

    ``und`` with score 0 for a null text or one without a letter, and for all without a model.  ``ambiguous`` when the
    other languages together are likelier than the one named.  Repeated rows are repeated.
    """
    schema = pa.schema(
        {"doc_id": pa.int64(), "lang_pred": pa.string(), "score": pa.float64(), "ambiguous": pa.bool_()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(model)
        for batch in small_batches(batches, "text"):
            langs, scores, unsure = judge(texts_of(batch, "text"))
            columns = {"doc_id": batch.column("doc_id"), "lang_pred": langs}
            yield record_batch(schema, columns | {"score": scores, "ambiguous": unsure})

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, ambiguous boolean"
    )


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is known and not ambiguous."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(model)
        for batch in small_batches(batches, "text"):
            langs, _, unsure = judge(texts_of(batch, "text"))
            kept = [lang != UNKNOWN and not u for lang, u in zip(langs, unsure)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def learned_rows() -> Column:
    """Rows that may be learned from: the CRC-32 of the id, as text, leaves another remainder than 2 by 4."""
    return crc32_of("doc_id") % 4 != 2


def languages_of(docs: DataFrame) -> DataFrame:
    """Every document's held_out, lang_pred, score and ambiguous; rows held out are not learned from."""
    found = identify(docs, train(docs, learned_rows()))
    held_out = F.coalesce(crc32_of("doc_id") % 4 == 2, F.lit(False)).alias("held_out")
    return found.select("doc_id", held_out, "lang_pred", "score", "ambiguous")
