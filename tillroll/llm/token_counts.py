"""Token counts without ids: pieces are counted once per distinct pre-token and joined to the documents' frequencies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import record_batch, run_folder, saved, small_batches, texts_of
from tillroll.llm.pretokens import PreTokens, pre_tokens

#: A chunk of documents shares one dictionary; it ends at so many pre-tokens, or document frequencies.
CHUNK_PIECES = 400_000
CHUNK_FREQUENCIES = 4_000_000

_FREQUENCIES = pa.schema(
    {
        "doc_id": pa.int64(),
        "n_bytes": pa.int64(),
        "specials": pa.int64(),
        "places": pa.list_(pa.uint32()),
        "counts": pa.list_(pa.uint32()),
    }
)


class _Chunk:
    """Pre-token frequencies of a run of documents over one dictionary.

    Place 0 is the empty pre-token, which has no tokens, so that every chunk has an entry.
    """

    def __init__(self, coder: PreTokens):
        self.coder = coder
        self.places: dict[str, int] = {"": 0}
        self.words: dict[str, list[int]] = {}
        self.rows: list[dict[str, object]] = []
        self.held = 0

    def _places(self, pieces: list[str]) -> list[int]:
        return [self.places.setdefault(p, len(self.places)) for p in pieces]

    def add(self, doc_id: int | None, text: str) -> None:
        specials, places, times = 0, [], []
        if self.coder.plain(text):
            # A word is split into pre-tokens once per chunk.
            for word, n in Counter(self.coder.words(text)).items():
                found = self.words.get(word)
                if found is None:
                    found = self.words[word] = self._places(self.coder.pieces_of_word(word))
                places += found
                times += [n] * len(found)
        else:
            pieces, specials = self.coder.pieces(text)
            places, times = self._places(pieces), [1] * len(pieces)
        distinct, which = np.unique(np.array(places, dtype=np.uint32), return_inverse=True)
        counts = np.bincount(which, np.array(times, dtype=np.float64), len(distinct)).astype(np.uint32)
        row = {"doc_id": doc_id, "n_bytes": len(text.encode()), "specials": specials}
        self.rows.append(row | {"places": distinct, "counts": counts})
        self.held += len(distinct)

    def full(self) -> bool:
        return len(self.places) >= CHUNK_PIECES or self.held >= CHUNK_FREQUENCIES

    def close(self, folder: str) -> pa.RecordBatch:
        """Writes the frequencies to a file of their own; the dictionary with the file's number."""
        number = uuid4().int >> 65
        store, root = fs.FileSystem.from_uri(folder)
        table = pa.table({f.name: pa.array([r[f.name] for r in self.rows], f.type) for f in _FREQUENCIES})
        with store.open_output_stream(_file(root, number)) as out:
            pq.write_table(table, out, compression="zstd", use_dictionary=False)
        size = len(self.places)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(size, number, dtype=np.int64)),
                pa.array(np.arange(size, dtype=np.int32)),
                pa.array(list(self.places), pa.string()),
            ],
            names=["chunk", "place", "piece"],
        )


def _file(root: str, number: int) -> str:
    return f"{root}/{number:016x}.parquet"


def _dictionaries(docs: DataFrame, tokenizer: str, folder: str) -> DataFrame:
    """(chunk, place, piece) of every chunk; its documents' frequencies are in ``folder``.

    A repeated task writes its chunks under other numbers, and only those of the tasks that Spark counts are listed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pre_tokens(tokenizer)
        chunk = _Chunk(coder)
        for batch in small_batches(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                chunk.add(doc_id, text)
                if chunk.full():
                    yield chunk.close(folder)
                    chunk = _Chunk(coder)
        if chunk.rows:
            yield chunk.close(folder)

    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    return docs.select("doc_id", "text").mapInArrow(run, "chunk long, place int, piece string")


def piece_lengths(pieces: DataFrame, tokenizer: str) -> DataFrame:
    """Tokens of each distinct pre-token (piece): the library's model sees each once."""
    schema = pa.schema({"piece": pa.string(), "tokens": pa.int32()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = pre_tokens(tokenizer)
        for batch in batches:
            found = batch.column("piece")
            yield record_batch(schema, {"piece": found, "tokens": [coder.count(p) for p in found.to_pylist()]})

    return pieces.select("piece").distinct().mapInArrow(run, "piece string, tokens int")


def count_tokens(docs: DataFrame, tokenizer: str, limit: int) -> DataFrame:
    """Bytes, tokens and whether there are more than ``limit`` tokens, for every document.

    ``tokenizer`` is a tokenizers file (BPE over pre-tokens).  Special strings in a text count as the library takes
    them.  Null and empty texts have no bytes and no tokens; repeated rows are repeated; other columns are not carried.

    Documents are held in chunks of bounded size with one dictionary each.  A dictionary entry is one row of the join,
    however many documents of the chunk hold it, so a pre-token has at most one row per chunk, and the frequencies
    themselves are not shuffled: the entries' lengths meet them in the chunk's file.
    """
    folder = run_folder(docs.sparkSession, "frequencies")
    entries = saved(_dictionaries(docs, tokenizer, folder), "pre-tokens")
    packed = F.shiftleft(F.col("place").cast("long"), 32).bitwiseOR(F.col("tokens").cast("long"))
    found = (
        entries.join(piece_lengths(entries, tokenizer), "piece")
        .select("chunk", packed.alias("entry"))
        .groupBy("chunk")
        .agg(F.collect_list("entry").alias("entries"))
    )
    schema = pa.schema(
        {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_tokens": pa.int64(), "over_limit": pa.bool_()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for number, entries in zip(batch.column("chunk").to_pylist(), batch.column("entries")):
                values = entries.values.to_numpy()
                tokens = np.zeros(len(values), dtype=np.int64)
                tokens[values >> 32] = values & 0xFFFFFFFF
                with store.open_input_file(_file(root, number)) as source:
                    for rows in pq.ParquetFile(source).iter_batches(8192):
                        yield totals(rows, tokens)

    def totals(rows: pa.RecordBatch, tokens: np.ndarray) -> pa.RecordBatch:
        places, counts = rows.column("places"), rows.column("counts")
        each = tokens[places.flatten().to_numpy()] * counts.flatten().to_numpy()
        sums = np.concatenate([[0], np.cumsum(each)])
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())])
        n_tokens = np.diff(sums[ends]) + rows.column("specials").to_numpy()
        values = {"doc_id": rows.column("doc_id"), "n_bytes": rows.column("n_bytes"), "n_tokens": n_tokens}
        return record_batch(schema, values | {"over_limit": n_tokens > limit})

    return found.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
