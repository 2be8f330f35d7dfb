"""Benchmark passages in documents, by winnowing.

Words are compared in lower case.  The hash of every run of ``GRAM`` words is a gram; of the grams in a window of
``WINDOW`` words, the least hash is the window's fingerprint.  It follows from the window alone, so any span of at least
``WINDOW`` words that a document and a benchmark item share has a fingerprint that both have.

A bitmap of bounded size holds the items' fingerprints and is part of the plan.  Windows of documents whose fingerprint
may be among them are joined, as texts, with the items' windows, and hits are extended to all words of the windows that
occur.  An item of fewer than ``WINDOW`` words is one window, and the hash of all its words is its fingerprint.
"""

from __future__ import annotations

import json
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import saved, settled
from tillroll.operators.joins import hot_keys, join

GRAM = 5
WINDOW = 10
#: Words before A-Z are lower-cased: what is not ASCII, digits and letters.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the bitmap, as powers of two: 64 or more a fingerprint up to 262,144 fingerprints, 8 at two million.  With more of
#: them more windows reach the join, and none is lost.
LEAST_BITS, MOST_BITS = 16, 24

_LOWER = f"'{string.ascii_uppercase}', '{string.ascii_lowercase}'"


def _words(text: str) -> Column:
    """Words of column ``text``; a null text has none.  Only words beyond ASCII take the slower way to lower case."""
    found = f"regexp_extract_all(coalesce({text}, ''), r'{WORD}', 0)"
    return F.expr(f"transform({found}, w -> if(length(w) = octet_length(w), lower(w), translate(w, {_LOWER})))")


def _runs(n: int, words: str = "words") -> str:
    """Hashes of all runs of ``n`` words, by the place where they begin."""
    rest = "".join(f", get({words}, i + {j})" for j in range(1, n))
    return f"transform(slice({words}, 1, greatest(size({words}) - {n - 1}, 0)), (w, i) -> xxhash64(w{rest}))"


def _prints(grams: str = "grams") -> str:
    """Fingerprint of every window: the least of its grams."""
    inner = WINDOW - GRAM
    rest = "".join(f", get({grams}, i + {j})" for j in range(1, inner + 1))
    return f"transform(slice({grams}, 1, greatest(size({grams}) - {inner}, 0)), (g, i) -> least(g{rest}))"


def _short_prints(n: int) -> str:
    """Fingerprints of all runs of ``n`` words, each a window of its own."""
    rest = "".join(f", get(words, i + {j})" for j in range(1, n))
    runs = f"slice(words, 1, greatest(size(words) - {n - 1}, 0))"
    return f"transform({runs}, (w, i) -> xxhash64(concat_ws(' ', w{rest})))"


def _passage(start: str, n: str) -> str:
    return f"array_join(slice(words, {start} + 1, {n}), ' ')"


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, print, n, passage) of every different window of every item.

    ``print`` is the fingerprint and ``passage`` the ``n`` words of the window, which no item without words has.
    """
    split = items.select(F.col("item_id").cast("string").alias("item_id"), _words("text").alias("words"))
    grams = settled(split, ["item_id", "words"], {"grams": F.expr(_runs(GRAM))})
    long = grams.select(
        "item_id", "words", F.posexplode(F.expr(_prints())).alias("start", "print"), F.lit(WINDOW).alias("n")
    )
    short = split.filter(F.size("words").between(1, WINDOW - 1)).select(
        "item_id", "words", F.lit(0).alias("start"), F.xxhash64(F.array_join("words", " ")).alias("print"),
        F.size("words").alias("n"),
    )
    every = long.unionByName(short)
    return every.select("item_id", "print", "n", F.expr(_passage("start", "n")).alias("passage")).distinct()


def _bitmap(prints: DataFrame) -> tuple[int, list[int]]:
    """Number of bits, as a power of two, and the bitmap of the fingerprints' first bits, 64 to a number."""
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * prints.count()).bit_length()))
    place = F.expr(f"shiftrightunsigned(print, {64 - bits})")
    word, bit = F.shiftright(place, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(at & 63 as int))")
    # At most 2 to the 18 numbers, however many fingerprints there are.
    filled = prints.select(place.alias("at"), word).groupBy("word").agg(F.bit_or(bit).alias("set"))
    numbers = [0] * (1 << (bits - 6))
    for row in filled.collect():
        numbers[row["word"]] = row["set"]
    return bits, numbers


def _marks(docs: DataFrame, bits: int, numbers: list[int], short: list[int]) -> DataFrame:
    """(doc_id, n_words, marks, digest): windows of each document whose fingerprint the bitmap has.

    A mark is (start, n, passage).  ``digest`` stands for the text where there are marks.
    """
    # Parsed once, when the plan is made.
    bitmap = F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")
    split = docs.select("doc_id", "text", _words("text").alias("words"))
    hashed = {"grams": F.expr(_runs(GRAM))}
    hashed |= {f"runs{n}": F.expr(_short_prints(n)) for n in short}
    rows = settled(split, ["doc_id", "text", "words"], hashed)

    def marked(prints: str, n: int) -> str:
        at = f"shiftrightunsigned(p, {64 - bits})"
        known = f"getbit(get(bitmap, cast(shiftright({at}, 6) as int)), cast({at} & 63 as int)) = 1"
        mark = f"named_struct('start', i, 'n', {n}, 'passage', {_passage('i', str(n))})"
        return f"filter(transform({prints}, (p, i) -> if({known}, {mark}, null)), m -> m is not null)"

    found = [marked(_prints(), WINDOW)] + [marked(f"runs{n}", n) for n in short]
    rows = rows.withColumn("bitmap", bitmap)
    judged = settled(
        rows,
        ["doc_id", "text"],
        {
            "n_words": F.size("words").cast("long"),
            "marks": F.expr(f"concat({', '.join(found)})") if short else F.expr(found[0]),
        },
    )
    digest = F.when(F.size("marks") > 0, F.sha2("text", 256))
    return judged.select("doc_id", "n_words", "marks", digest.alias("digest"))


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of every row of ``docs``.

    ``docs`` has doc_id and text, ``items`` item_id and text; other columns are not looked at.  A word is hit when it lies
    in an occurrence of a window.  Null texts and texts without words have no windows and are hit by none, and without
    items nothing is.  Repeated documents are repeated; items with equal ids count as one, and one without an id hits
    words but is not counted.  Texts may be of any length.

    Equal texts are judged once.  Windows, texts and sets of items that many documents share are spread in the joins.
    """
    windows = saved(item_windows(items), "item-windows")
    short = sorted(r["n"] for r in windows.filter(F.col("n") < WINDOW).select("n").distinct().collect())
    marked = saved(_marks(docs, *_bitmap(windows.select("print").distinct()), short), "marks")

    # A set of items is known by its size and two sums over hashes; windows of the same items share it.
    item_set = F.concat_ws(
        " ",
        F.count("item_id"),
        F.hex(F.bit_xor(F.xxhash64("item_id"))),
        F.hex(F.bit_xor(F.xxhash64("item_id", F.lit("again")))),
    )
    known = saved(windows.groupBy("passage").agg(item_set.alias("item_set")), "known-windows")
    members = windows.join(known, "passage").select("item_set", "item_id").distinct()

    texts = marked.filter("digest IS NOT NULL").groupBy("digest").agg(F.first("marks").alias("marks"))
    spots = saved(texts.select("digest", F.inline("marks")), "spots")
    (hot_passages,) = hot_keys(spots, "passage")
    hits = join(spots, [known], "passage", hot_passages, ["digest", "start"], "inner")
    covered = F.aggregate(
        F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("n")).alias("stop")))),
        F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("n")),
        lambda a, s: F.struct(
            F.greatest(a["reach"], s["stop"]).alias("reach"),
            (a["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], a["reach"]))).alias("n"),
        ),
        lambda a: a["n"],
    )
    sets = F.array_sort(F.collect_set("item_set"))
    judged = hits.groupBy("digest").agg(covered.alias("n_hit"), sets.alias("sets"))
    judged = saved(judged.withColumn("kind", F.sha2(F.array_join("sets", ","), 256)), "hit-texts")

    # Texts with the same sets of items have the same list of items.
    kinds = judged.groupBy("kind").agg(F.first("sets").alias("sets")).select("kind", F.explode("sets").alias("item_set"))
    listed = kinds.join(members, "item_set").select("kind", "item_id").distinct()
    ids = F.array_sort(F.collect_set("item_id"))
    lists = listed.groupBy("kind").agg(
        F.size(ids).cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256")
    )
    (hot_kinds,) = hot_keys(judged, "kind")
    results = saved(join(judged.drop("sets"), [lists], "kind", hot_kinds, ["digest"]).drop("kind"), "hit-results")
    rows = marked.select("doc_id", "n_words", "digest")
    (hot_texts,) = hot_keys(rows, "digest")
    zero = F.lit(0).cast("long")
    return join(rows, [results], "digest", hot_texts, ["doc_id"]).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", zero).alias("n_hit"),
        F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", zero) > 0).alias("contaminated"),
    )
