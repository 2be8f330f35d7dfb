"""Near-duplicate groups: fast similarity sketches, banding, exact verification and connected components.

A text's set is its distinct word shingles, as 64-bit hashes.  A sketch has ``t`` coordinates; in every round each
shingle is thrown into one of them by a hash, with a value that grows with the round, and each coordinate keeps its
least value.  After ``t`` rounds, one round per coordinate throws every shingle into it, so all fill.  Two sets agree in a coordinate
with a chance equal to their similarity, and the share of agreements is concentrated about it as for independent draws.

Bands of coordinates put similar sets into common buckets.  Every link is confirmed on the full sets.  No bucket is
expanded into all its pairs: its members are first compared with its smallest one, and only those still in different
components with each other, block by block.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import record_batch, saved, small_batches, texts_of

SHINGLE_WORDS = 5
#: Least similarity of a link, in percent.
THRESHOLD = 80
#: Coordinates of a band; and the chance that a pair at the threshold meets in no band.
BAND_ROWS = 5
MISS = 1e-6
#: Members of a bucket that one task compares with as many others.
BLOCK = 1000
#: Standard deviations of the estimate by which a pair must miss the threshold to be passed over.
DEVIATIONS = 6

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)
_LOW = np.uint64(0xFFFFFFFF)


def band_count(threshold: int, rows: int = BAND_ROWS, miss: float = MISS) -> int:
    """Bands that a pair at the threshold misses altogether with a chance of ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - (threshold / 100) ** rows))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the text's ``k``-word shingles; of the whole sequence where it has fewer words.

    A-Z count as a-z.  Words are what space and the five ASCII controls from tab to carriage return separate.
    """
    words = text.encode().lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    k = min(k, len(words))
    if k == 0:
        return hashes
    ends = len(words) - k + 1
    folded = hashes[:ends]
    for i in range(1, k):
        folded = mixed(folded * _MULTIPLIER + hashes[i : i + ends])
    return np.unique(folded)


def sketch(hashes: np.ndarray, t: int) -> np.ndarray:
    """The ``t`` coordinates of a set that is not empty."""
    values = np.full(t, np.iinfo(np.uint64).max, dtype=np.uint64)

    def throw(rounds: np.ndarray, bins: np.ndarray | None = None) -> None:
        thrown = mixed(hashes[None, :] ^ mixed((rounds + np.uint64(1)) * _MULTIPLIER)[:, None])
        levels = (rounds[:, None] << _SHIFT) + (thrown & _LOW)
        if bins is None:
            places = ((thrown >> _SHIFT) * np.uint64(t)) >> _SHIFT
            np.minimum.at(values, places.ravel().astype(np.intp), levels.ravel())
        else:
            values[bins] = levels.min(axis=1)

    first, step = 0, max(1, 2 * t // len(hashes))
    while first < t and (values == np.iinfo(np.uint64).max).any():
        throw(np.arange(first, min(t, first + step), dtype=np.uint64))
        first += step
    empty = np.flatnonzero(values == np.iinfo(np.uint64).max)
    if len(empty):
        throw(np.uint64(t) + empty.astype(np.uint64), empty)
    return values


def band_keys(values: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One bucket number per band."""
    bands = values.reshape(-1, rows)
    keys = mixed(np.arange(1, len(bands) + 1, dtype=np.uint64) * _MULTIPLIER)
    for i in range(rows):
        keys = mixed(keys * _MULTIPLIER + bands[:, i])
    return keys.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    """Whether 100 * intersection >= threshold * union, for sorted distinct hashes."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < threshold * large:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= threshold * (small + large - common)


def sketches(docs: DataFrame, k: int, threshold: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, digest, bands, sketch) of every text; digest is null for an empty set."""
    bands = band_count(threshold)
    schema = pa.schema(
        {
            "id": pa.int64(),
            "n_shingles": pa.int64(),
            "digest": pa.binary(),
            "bands": pa.list_(pa.int64()),
            "sketch": pa.binary(),
        }
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sizes, digests, buckets, short = [], [], [], []
            for text in texts_of(batch, "text"):
                hashes = shingles(text, k)
                sizes.append(len(hashes))
                if len(hashes):
                    values = sketch(hashes, bands * BAND_ROWS)
                    digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                    buckets.append(band_keys(values))
                    short.append((values & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    digests.append(None)
                    buckets.append([])
                    short.append(None)
            columns = {"id": batch.column("id"), "n_shingles": sizes, "digest": digests}
            yield record_batch(schema, columns | {"bands": buckets, "sketch": short})

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, "id long, n_shingles long, digest binary, bands array<long>, sketch binary"
    )


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of docs (id, text); the hashes as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            sets = pa.array([shingles(t, k).tobytes() for t in texts_of(batch, "text")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sets], names=["id", "shingles"])

    return docs.mapInArrow(run, "id long, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mask = [
                similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), threshold)
                for x, y in zip(batch.column("shingles_a"), batch.column("shingles_b"))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(mask, pa.bool_()))

    for side in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("id").alias(side), F.col("shingles").alias(f"shingles_{side}")), side)
    return pairs.select("a", "b", "shingles_a", "shingles_b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component: least node reachable) of every node of the edges (a, b).

    Alternating star contraction: each node's larger neighbours are linked to its least neighbour, then its smaller
    ones, until nothing changes.  Every step is a grouped minimum and a join, so a node with very many neighbours is
    never gathered in one place; each round is written to the shared folder.
    """
    edges = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    edges, mark = saved(edges, "links"), None
    while True:
        found = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if found == mark:
            break
        mark = found
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = saved(small.union(least.withColumnRenamed("m", "v")).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _links_in_blocks(members: DataFrame, threshold: int, t: int) -> DataFrame:
    """Links (a, b) that join different components among the members of each bucket.

    ``members`` has (band, members: how many, id, component, sketch, shingles).  A bucket is cut into blocks, and every
    two blocks meet in a task of their own, so a task's memory is bounded by two blocks however large the bucket.  Pairs
    whose sketches are far below the threshold are passed over; of the others, links that join what is
    already joined are not looked for.
    """
    similarity = threshold / 100
    least = similarity - DEVIATIONS * math.sqrt(similarity * (1 - similarity) / t)

    def compare(table: pa.Table) -> pa.Table:
        rows = table.select(["id", "component", "block"]).to_pydict()
        first, second = table.column("one")[0].as_py(), table.column("two")[0].as_py()
        sketched = np.stack([np.frombuffer(x.as_buffer(), np.uint8) for x in table.column("sketch")])
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        blocks = np.array(rows["block"])
        parent = {c: c for c in rows["component"]}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        left, right = np.flatnonzero(blocks == first), np.flatnonzero(blocks == second)
        links: list[tuple[int, int]] = []
        for x in left.tolist():
            others = right[right > x] if first == second else right
            agree = (sketched[others] == sketched[x]).mean(axis=1)
            for y in others[agree >= least].tolist():
                a, b = root(rows["component"][x]), root(rows["component"][y])
                if a != b and similar(sets[x], sets[y], threshold):
                    parent[max(a, b)] = min(a, b)
                    links.append((rows["id"][x], rows["id"][y]))
        a, b = zip(*links) if links else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    placed = members.withColumn("blocks", blocks)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"one": F.least("block", "other"), "two": F.greatest("block", "other")}
    )
    wanted = ("band", "one", "two", "id", "component", "block", "sketch", "shingles")
    return met.select(*wanted).groupBy("band", "one", "two").applyInArrow(compare, "a long, b long")


def near_duplicates(
    docs: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Rows are linked whose ``k``-word shingle sets have 100 * intersection >= ``threshold`` * union;
    component_id is the least key reachable over links, and kept tells whether it is the row's own.  A null or
    empty text, or one without words, has an empty set and is linked with nothing.  Rows with equal sets are linked
    whatever their texts.  Rows that repeat a key are one document: a link of any of their texts is its link.  A null key counts as no key: its row
    takes the component of its copies, or null, and is not kept.

    Links are found with a chance of 1 - ``MISS`` at the threshold, more above it, and none is reported that the full sets
    do not confirm.
    """
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    sketched = saved(sketches(texts, k, threshold, "id"), "sketches")
    # One row per distinct set stands for all its copies.
    classes = saved(
        sketched.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("id").alias("id"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
        .filter("id is not null"),
        "classes",
    )
    rows = classes.select("id", F.explode("bands").alias("band"))
    hubs = rows.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("members")).filter("members > 1")
    met = saved(rows.join(hubs, "band").filter("id <> hub"), "buckets")
    pairs = saved(met.select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct(), "pairs")
    # Their number grows with the texts, so they are not broadcast, and the plan is the same at any size.
    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().hint("merge")
    sets = saved(shingle_sets(texts.join(involved, "id", "left_semi"), k), "shingles")
    links = saved(confirmed(pairs, sets, threshold), "star-links")
    labels = saved(components(links), "components")

    # What the first comparison may have missed: members of a bucket, its hub apart, in different components.
    named = met.join(labels.withColumnRenamed("node", "id"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    open_bands = (
        named.groupBy("band")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("others"))
        .filter("low <> high")
        .select("band", "others")
    )
    left = (
        named.join(open_bands, "band")
        .select("band", F.col("others").alias("members"), "id", "component")
        .join(classes.select("id", "sketch"), "id")
        .join(sets, "id")
    )
    more = saved(_links_in_blocks(left, threshold, band_count(threshold) * BAND_ROWS), "block-links")
    if not more.isEmpty():
        stars = labels.select(F.col("node").alias("a"), F.col("component").alias("b"))
        labels = saved(components(stars.union(more)), "components")

    grouped = classes.select("digest", "id").join(labels.withColumnRenamed("node", "id"), "id", "left")
    of_set = grouped.select("digest", F.coalesce("component", "id").alias("component"))
    full = sketched.filter("digest is not null").select("id", "n_shingles", "digest").join(of_set, "digest", "left")
    empty = sketched.filter("digest is null").select("id", "n_shingles", F.col("id").alias("component"))
    every = full.select("id", "n_shingles", "component").union(empty)
    return every.select(
        F.col("id").alias(key),
        "n_shingles",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, k: int = SHINGLE_WORDS, threshold: int = THRESHOLD, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, one per group, with all their columns: that of the least key.

    Of rows that repeat a key, one stays.  Rows with a null key cannot be named and stay.
    """
    found = near_duplicates(docs, k, threshold, key, text)
    judged = found.groupBy(key).agg(F.max("kept").alias("kept"), F.count("*").alias("times"))
    judged = saved(judged.filter(F.col(key).isNotNull() & (~F.col("kept") | (F.col("times") > 1))), "judged")
    stay = docs.join(judged.select(key).hint("merge"), key, "left_anti").select(*docs.columns)
    repeated = judged.filter("kept").select(key)
    if repeated.isEmpty():
        return stay
    return stay.unionByName(docs.join(repeated, key, "left_semi").select(*docs.columns).dropDuplicates([key]))
