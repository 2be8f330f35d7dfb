"""Byte-level BPE with the tiktoken library and a local rank file: encoding of whole texts and raw-byte decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame

from tillroll.llm.common import record_batch, small_batches, texts_of

#: Texts longer than this are cut at safe boundaries before the library sees them.
CHUNK_CHARS = 100_000
#: Runs of white space this long are encoded as the single match they are; the pattern engine overflows on longer ones.
LONG_SPACE = 10_000


class RankFile:
    """A rank file (base64 token, rank per line) with the pattern that splits text before the merges.

    Each match of the pattern is merged by itself, so a text may be cut wherever no match crosses: before white space
    that follows a character which is not white space.  No match holds white space after other characters, and no
    alternative looks back.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._long_space = regex.compile(r"\s{%d,}" % LONG_SPACE)
        self._boundary = regex.compile(r"(?<=\S)(?=\s)")

    def encode(self, text: str) -> list[int]:
        """Ids of the whole text, without special tokens."""
        if len(text) <= CHUNK_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        start = 0
        for run in self._long_space.finditer(text):
            # The last white space before other text belongs to the next match.
            stop = run.end() if run.end() == len(text) else run.end() - 1
            self._encode_chunks(text[start : run.start()], ids)
            ids += self.encoding._encode_single_piece(text[run.start() : stop])
            start = stop
        self._encode_chunks(text[start:], ids)
        return ids

    def _encode_chunks(self, text: str, ids: list[int]) -> None:
        for chunk in self.chunks(text):
            ids += self.encoding.encode_ordinary(chunk)

    def chunks(self, text: str) -> Iterator[str]:
        """``text`` cut at the first safe boundary after each ``CHUNK_CHARS`` characters."""
        start = 0
        while len(text) - start > CHUNK_CHARS:
            cut = self._boundary.search(text, start + CHUNK_CHARS)
            if cut is None:
                break
            yield text[start : cut.start()]
            start = cut.start()
        if start < len(text):
            yield text[start:]

    def decode(self, ids: list[int]) -> bytes:
        """The raw bytes of the ids; they need not be valid UTF-8 where ids were cut."""
        return self.encoding.decode_bytes(ids)


@lru_cache(maxsize=2)
def rank_file(path: str, pattern: str) -> RankFile:
    """One copy per Python worker."""
    return RankFile(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text: (key, ids array<int>).  Null text counts as empty; other columns are not carried."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rank_file(path, pattern)
        for batch in small_batches(batches, "text"):
            ids = pa.array([coder.encode(t) for t in texts_of(batch, "text")], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("key"), ids], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.selectExpr(f"`{key}` as key", f"`{text}` as text").mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Raw bytes of every id list: (key, bytes binary).  A null list counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rank_file(path, pattern)
        for batch in batches:
            raw = pa.array([coder.decode(x or []) for x in batch.column("ids").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("key"), raw], names=[key, "bytes"])

    kind = encoded.schema[key].dataType.simpleString()
    return encoded.selectExpr(f"`{key}` as key", f"`{ids}` as ids").mapInArrow(run, f"`{key}` {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count, digest of the ids and digest of the decoded bytes of every document.

    Encoding and decoding meet in one pass, so that no id list is passed between Spark and Python.
    Null and empty texts have no tokens; repeated rows are repeated.
    """
    schema = pa.schema(
        {"doc_id": pa.int64(), "n_tokens": pa.int64(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = rank_file(path, pattern)
        for batch in small_batches(batches, "text"):
            counts, written, decoded = [], [], []
            for text in texts_of(batch, "text"):
                ids = coder.encode(text)
                counts.append(len(ids))
                written.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                decoded.append(hashlib.sha256(coder.decode(ids)).hexdigest())
            yield record_batch(
                schema,
                {
                    "doc_id": batch.column("doc_id"),
                    "n_tokens": counts,
                    "ids_sha256": written,
                    "decoded_sha256": decoded,
                },
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
