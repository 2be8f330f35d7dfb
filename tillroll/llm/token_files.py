"""Files of token ids with random access: directly addressable codes.

An id is split into 8-bit chunks, lowest first.  Level 0 holds the lowest chunk of every id, and a bit that says whether
the id goes on; level 1 holds the next chunk of those that go on, and so forth.  The number of set bits before a bit
(its rank) is the place in the next level, so any id is read with a few bytes a level and no block is decoded.  A rank
directory keeps the ranks of every 512th bit.  Ids from a to b are one contiguous range of every level.

Layout, all little-endian: the magic number, then the counts of levels, documents and ids and the offset of every
section (uint64), then the sections: document ids (int64), their validity (bytes), first id of each document and the end
(uint64), and for each level its chunks (bytes), continuation bitmap and rank directory (uint64).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import ids_crc32, record_batch, run_folder, saved, small_batches, texts_of
from tillroll.llm.pretokens import pre_tokens

MAGIC = b"IDCHUNK1"
BLOCK_BITS = 512
#: A file is closed at this many ids, so that a writer's and a reader's memory is bounded.
FILE_IDS = 4_000_000
#: Ids that a reader holds at a time, unless one document alone has more.
READ_IDS = 500_000
#: Input partitions whose sizes are added up together, before the totals of such blocks are.
FILE_BLOCK = 512


def _level(values: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """What goes on to the next level, and the three sections of this one."""
    rest = values >> np.uint32(8)
    more = rest > 0
    bitmap = np.packbits(more, bitorder="little")
    bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK_BITS // 8)))
    ones = np.bitwise_count(bitmap).reshape(-1, BLOCK_BITS // 8).sum(axis=1, dtype=np.uint64)
    directory = np.concatenate([[0], np.cumsum(ones)]).astype("<u8")
    return rest[more], [(values & np.uint32(255)).astype(np.uint8).tobytes(), bitmap.tobytes(), directory.tobytes()]


def to_bytes(doc_ids: Sequence[int | None], id_lists: Sequence[np.ndarray]) -> bytes:
    """A whole file of the documents' ids."""
    starts = np.concatenate([[0], np.cumsum([len(x) for x in id_lists])]).astype("<u8")
    left = np.concatenate([*id_lists, np.zeros(0, np.uint32)]).astype(np.uint32)
    sections = [
        np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes(),
        bytes(d is not None for d in doc_ids),
        starts.tobytes(),
    ]
    levels, total = 0, len(left)
    while levels == 0 or len(left):
        left, level = _level(left)
        sections += level
        levels += 1
    counts = [levels, len(doc_ids), total]
    at = len(MAGIC) + 8 * (len(counts) + len(sections) + 1)
    offsets = np.cumsum([at, *map(len, sections)])
    return b"".join([MAGIC, np.array([*counts, *offsets], dtype="<u8").tobytes(), *sections])


class TokenFile:
    """Random access to one open file."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        if source.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError("not a file of token ids")
        self.levels, self.docs, self.ids = self._numbers(len(MAGIC), 0, 3)
        self._at = self._numbers(len(MAGIC), 3, 4 + 3 * self.levels)

    def _numbers(self, at: int, first: int, count: int, kind: str = "<u8") -> list[int]:
        return np.frombuffer(self.source.read_at(8 * count, at + 8 * first), dtype=kind).tolist()

    def doc_ids(self) -> list[int | None]:
        known = self.source.read_at(self.docs, self._at[1])
        return [d if k else None for d, k in zip(self._numbers(self._at[0], 0, self.docs, "<i8"), known)]

    def starts(self) -> list[int]:
        return self._numbers(self._at[2], 0, self.docs + 1)

    def _rank(self, level: int, bit: int) -> int:
        """Set bits before ``bit``: one directory entry and less than one block of the bitmap."""
        block = bit // BLOCK_BITS
        before = self._numbers(self._at[5 + 3 * level], block, 1)[0]
        bits = bit - block * BLOCK_BITS
        raw = self.source.read_at(-(-bits // 8), self._at[4 + 3 * level] + block * BLOCK_BITS // 8)
        return before + int(np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[:bits].sum())

    def get(self, i: int) -> int:
        """Id number ``i`` of the file."""
        if not 0 <= i < self.ids:
            raise IndexError(i)
        value = 0
        for level in range(self.levels):
            chunks, bitmap = self._at[3 + 3 * level], self._at[4 + 3 * level]
            value |= self.source.read_at(1, chunks + i)[0] << 8 * level
            if not self.source.read_at(1, bitmap + i // 8)[0] >> i % 8 & 1:
                break
            i = self._rank(level, i)
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Ids from number ``a`` up to ``b``."""
        levels = []
        for level in range(self.levels):
            chunks, bitmap = self._at[3 + 3 * level], self._at[4 + 3 * level]
            values = np.frombuffer(self.source.read_at(b - a, chunks + a), np.uint8).astype(np.uint32)
            raw = self.source.read_at(-(-b // 8) - a // 8, bitmap + a // 8)
            more = np.unpackbits(np.frombuffer(raw, np.uint8), bitorder="little")[a % 8 :][: b - a].astype(bool)
            levels.append((values, more))
            if not more.any():
                break
            a = self._rank(level, a)
            b = a + int(more.sum())
        whole = levels.pop()[0]
        while levels:
            values, more = levels.pop()
            values[more] |= whole << np.uint32(8)
            whole = values
        return whole


def write(docs: DataFrame, tokenizer: str, end: int, folder: str | None = None) -> DataFrame:
    """Encodes every whole text, in ascending doc_id, into files of ``folder``: one row per file.

    The rows are (path, docs, ids, base: ids of all files before it).  Null and empty texts have the end id alone; null
    ids come first; rows with equal ids are ordered by text.  A lost task writes its files anew under another name,
    and only the files of the tasks that Spark counts are listed.  ``folder`` must be one that all nodes reach; without
    it, a new one in the shared folder is taken.
    """
    spark = docs.sparkSession
    folder = folder or run_folder(spark, "token-files")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    schema = pa.schema(
        {"partition": pa.int32(), "part": pa.int32(), "path": pa.string(), "docs": pa.int64(), "ids": pa.int64()}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, out, stop = pre_tokens(tokenizer), fs.FileSystem.from_uri(folder)[0], np.array([end], dtype=np.uint32)
        partition, part = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        id_lists: list[np.ndarray] = []
        held = 0

        def close() -> pa.RecordBatch:
            path = f"{root}/ids-{partition:06d}-{part:04d}-{uuid4().hex}.bin"
            with out.open_output_stream(path) as file:
                file.write(to_bytes(doc_ids, id_lists))
            row = {"partition": partition, "part": part, "path": path, "docs": len(doc_ids), "ids": held}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in small_batches(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch, "text")):
                ids = np.concatenate([coder.encode(text), stop])
                if doc_ids and held + len(ids) > FILE_IDS:
                    yield close()
                    part, held, doc_ids, id_lists = part + 1, 0, [], []
                doc_ids.append(doc_id)
                id_lists.append(ids)
                held += len(ids)
        if doc_ids:
            yield close()

    # The beginnings of texts part the rows that repeat an id or have none; they sort as the texts do.
    ranges = ("doc_id", F.substring("text", 1, 64))
    ordered = docs.select("doc_id", "text").repartitionByRange(*ranges).sortWithinPartitions("doc_id", "text")
    files = saved(ordered.mapInArrow(run, "partition int, part int, path string, docs long, ids long"), "token-list")
    return _with_base(files, folder)


def _with_base(files: DataFrame, folder: str) -> DataFrame:
    """The ids before each file: totals of blocks of files first, so no task holds more than a block's files."""
    block = F.floor(F.col("partition") / FILE_BLOCK).alias("block")
    files = files.select("*", block)
    blocks = files.groupBy("block").agg(F.sum("ids").alias("ids"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("block", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("block").orderBy("partition", "part").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("earlier") + F.coalesce(F.sum("ids").over(inside), F.lit(0))
    return files.join(blocks, "block").select(F.lit(folder).alias("folder"), "path", "docs", "ids", base.alias("base"))


def read(files: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    schema = pa.schema({"doc_id": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store = fs.FileSystem.from_uri(row["folder"])[0]
                with store.open_input_file(row["path"]) as source:
                    yield from documents_of(TokenFile(source), row["base"])

    def documents_of(file: TokenFile, base: int) -> Iterator[pa.RecordBatch]:
        starts, doc_ids, first = file.starts(), file.doc_ids(), 0
        while first < file.docs:
            last = first + 1
            while last < file.docs and starts[last + 1] - starts[first] <= READ_IDS:
                last += 1
            ids = file.slice(starts[first], starts[last])
            spans = [(starts[d], starts[d + 1]) for d in range(first, last)]
            yield record_batch(
                schema,
                {
                    "doc_id": doc_ids[first:last],
                    "start": [base + a for a, _ in spans],
                    "n_tokens": [b - a for a, b in spans],
                    "ids_crc32": [ids_crc32(ids[a - starts[first] : b - starts[first]]) for a, b in spans],
                },
            )
            first = last

    # The list of files is small; its rows are dealt out one by one.
    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
