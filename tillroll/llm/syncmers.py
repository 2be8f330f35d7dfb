"""Document fingerprints from closed syncmers, and the text that follows in the corpus.

A symbol is a word, or one of two halves (16 characters and the rest) of a word of up to 32.  Longer words, and those with
``RUN`` characters of scripts without spaces in a row, are cut by what they hold instead of by where they begin: every
character beyond ASCII is a symbol, other symbols end with one of ``ENDS``, and have 16 characters only where nothing ends
them.  So the cuts of a passage and its copy meet at the first end that both have.  A window of ``WINDOW`` symbols is an
anchor when the smallest hash of its two-symbol parts lies at its first or last part.  Whether a window is an anchor
depends on the window alone, so a passage has the same anchors, in the same order, wherever it stands; only the windows
that reach the word, or stretch without an end, in which it begins or ends may differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import saved, settled

#: Inside character classes: what separates words, scripts written without spaces, and ASCII characters that end symbols.
SPACE = r" \t-\r"
UNSPACED = (
    r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
    r"\x{3000}-\x{303F}\x{30FC}\x{FF00}-\x{FFEF}"
)
ENDS = r"aeuAEOU05!-\-/:-@\[-`{-~"
RUN = 4
_BEGINS, _ENDS_HERE = f"(?<![^{SPACE}])", f"(?![^{SPACE}])"
SYMBOL = "|".join(
    [
        # Words: the plain ones first, which is faster; both halves of those of up to 32 characters.
        f"{_BEGINS}[!-~]{{1,16}}{_ENDS_HERE}",
        f"{_BEGINS}(?![^{SPACE}]{{0,32}}?[{UNSPACED}]{{{RUN}}})[^{SPACE}]{{1,16}}(?=[^{SPACE}]{{0,16}}{_ENDS_HERE})",
        f"(?<={_BEGINS}[^{SPACE}{UNSPACED}]{{16}})[^{SPACE}{UNSPACED}]{{1,16}}{_ENDS_HERE}",
        r"[^\x00-\x7F]",
        rf"[\x00-\x7F&&[^{SPACE}{ENDS}]]{{0,15}}[{ENDS}]",
        rf"[\x00-\x7F&&[^{SPACE}]]{{1,16}}",
    ]
)
#: Symbols of a window (k), of which each part has two (s).
WINDOW = 8
PARTS = WINDOW - 1
#: Rows that stand together while each looks for its successor.
NEIGHBOURS = 500
MOST_BUCKETS = 1 << 16
GROUP = 256


def anchors(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with column ``to``: the anchors of ``text`` (not null), as hashes of 64 bits, in text order.

    A text without a single anchor (fewer than ``WINDOW`` symbols, or few more) has one, made of its symbols, or of the
    text itself if it has no symbol; so equal texts have equal anchors, and only an empty text has none.
    """
    inner = ", ".join(f"get(_parts, i + {j})" for j in range(1, PARTS - 1))
    pairs = ", ".join(f"get(_parts, i + {j})" for j in range(0, PARTS, 2))
    symbols = F.regexp_extract_all(F.col(f"`{text}`"), F.lit(SYMBOL), F.lit(0))
    hashed = df.withColumn("_symbols", F.transform(symbols, lambda w: F.xxhash64(w))).withColumn(
        "_parts",
        F.expr(
            "transform(slice(_symbols, 1, greatest(size(_symbols) - 1, 0)), (h, i) -> xxhash64(h, get(_symbols, i + 1)))"
        ),
    )
    # The smaller edge part is at most the smallest inner one.
    found = F.expr(
        f"filter(transform(slice(_parts, 1, greatest(size(_parts) - {PARTS - 1}, 0)), (p, i) ->"
        f" if(least(p, get(_parts, i + {PARTS - 1})) <= least({inner}), xxhash64({pairs}), null)),"
        " a -> a is not null)"
    )
    whole = F.when(F.length(text) == 0, F.array().cast("array<bigint>")).otherwise(
        F.array(F.when(F.size("_symbols") > 0, F.xxhash64("_symbols")).otherwise(F.xxhash64(text)))
    )
    found = hashed.withColumn("_found", found)
    return settled(found, df.columns, {to: F.when(F.size("_found") > 0, F.col("_found")).otherwise(whole)})


def likeness(a: Column, b: Column) -> Column:
    """Shared anchors among all different anchors of two lists, 0 to 1; 1 for two empty lists."""
    every = F.size(F.array_union(a, b))
    return F.when(every == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / every)


def matches(left: DataFrame, right: DataFrame, key: str = "doc_id", column: str = "anchors") -> DataFrame:
    """Positional matches: shared anchors per pair of documents and shift of their places.

    ``left`` and ``right`` hold keys and anchor lists.  A shared passage gives many matches of one shift.  Each side
    counts an anchor that a document repeats at its first place only.
    """

    def exploded(df: DataFrame, side: str) -> DataFrame:
        places = df.select(F.col(key).alias(f"{side}_id"), F.posexplode(column).alias("place", "anchor"))
        return places.groupBy(f"{side}_id", "anchor").agg(F.min("place").alias(f"{side}_place"))

    joined = exploded(left, "left").join(exploded(right, "right"), "anchor")
    shift = (F.col("left_place") - F.col("right_place")).alias("shift")
    return joined.groupBy("left_id", "right_id", shift).agg(F.count("*").alias("matches"))


def _bucket(key: str, bounds: list[int]) -> Column:
    """Number that rises with the key: in which of the groups of bounds, and where in the group, it falls."""
    if not bounds:
        return F.lit(0)
    groups = [bounds[i : i + GROUP] for i in range(0, len(bounds), GROUP)]

    def below(array: str) -> str:
        return f"size(filter({array}, b -> b <= `{key}`))"

    def literal(values: list[int]) -> str:
        return f"array({', '.join(f'{v}L' for v in values)})"

    nested = f"array({', '.join(map(literal, groups))})"
    group = below(literal([g[0] for g in groups]))
    inner = below(f"get({nested}, {group} - 1)")
    return F.expr(f"if(`{key}` is null, -1, {group} * {GROUP + 1} + greatest(0, {inner}))")


def with_place(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` with ``bucket`` and ``ghost``, and a copy (ghost) of every bucket's first row in the bucket before it.

    In descending key, then, each row's successor stands in its own bucket: the first row follows the last one.
    Buckets hold neighbouring keys, about ``NEIGHBOURS`` rows each.  Their bounds are quantiles of the keys, at most
    ``MOST_BUCKETS``; they decide where rows meet, not which rows follow each other.
    """
    buckets = max(1, min(MOST_BUCKETS, docs.count() // NEIGHBOURS))
    bounds: list[int] = []
    if buckets > 1:
        shares = ", ".join(repr(i / buckets) for i in range(1, buckets))
        found = docs.select(F.expr(f"approx_percentile(`{key}`, array({shares}), {20 * buckets})")).first()[0]
        bounds = sorted(set(found or []))
    placed = docs.withColumn("bucket", _bucket(key, bounds))
    # One row per bucket; written, so that its size is known where it is joined.
    heads = placed.groupBy("bucket").agg(F.max(key).alias("head"))
    order = Window.orderBy("bucket")
    above = F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(Window.partitionBy()))
    heads = saved(heads.select("head", above.alias("before")), "bucket-heads")
    ghosts = placed.drop("bucket").join(heads, placed[key].eqNullSafe(heads["head"]))
    ghosts = ghosts.select(*docs.columns, F.col("before").alias("bucket"), F.lit(True).alias("ghost"))
    return placed.withColumn("ghost", F.lit(False)).unionByName(ghosts)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every whole text, of its edited text, and their likeness.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many, or all, of the next
    document in descending doc_id; after the last comes the first.  A null text counts as empty; null ids come last;
    rows with equal ids are ordered by text.  A fingerprint is the list of anchors, joined by spaces.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = anchors(with_place(texts), "text", "anchors")
    # A ghost has a key below all of its bucket's, or it is the first of all and stands in the last bucket.
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc_nulls_last("doc_id"), "text")
    followed = found.select(
        "doc_id",
        "text",
        "anchors",
        "ghost",
        F.lead("text").over(order).alias("next_text"),
        F.lead("anchors").over(order).alias("next_anchors"),
    ).filter("not ghost")
    edited = followed.withColumn(
        "edited",
        F.expr("concat(left(text, length(text) - length(text) div 2), left(next_text, length(text) div 2))"),
    )
    hashed = anchors(edited, "edited", "edited_anchors")

    def joined(column: str) -> Column:
        return F.array_join(F.transform(column, lambda a: F.lower(F.hex(a))), " ")

    return hashed.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        joined("anchors").alias("fingerprint"),
        joined("edited_anchors").alias("edited_fingerprint"),
        likeness(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        likeness(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )
