"""Quality rules: a threshold table over ratios of a text, compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settled

#: Inside a character class: what separates words.
SPACE = r" \t-\r"
SYMBOLS = "#*$%&|<>"
LATIN = r"\p{IsLatin}"
MIN_WORDS = 50
#: Percent of the words that may lie in 3-word windows found twice or more.
MAX_REPEATED = 50

#: Common function words of the languages that the rules know.  Rows labelled with another language are not held to
#: ``stop_word_ratio``, nor are rows without a label whose letters are mostly not Latin.
STOP_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he this are or at from but have an they which",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an er so dass",
    "fr": "de la le et les des en un une du est que qui dans pour par sur au plus ne pas ce il se sont avec à leur",
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este es",
}
LANG = "lang"


@dataclass(frozen=True)
class Rule:
    """A text fails when ``metric`` is below ``least`` or above ``most``."""

    metric: str
    least: float | None = None
    most: float | None = None

    def failed(self) -> Column:
        value, failed = F.col(self.metric), F.lit(False)
        if self.least is not None:
            failed = failed | (value < self.least)
        if self.most is not None:
            failed = failed | (value > self.most)
        return failed


#: The verdict on texts that pass the base.
RULES = (
    Rule("mean_word_length", least=2, most=20),
    Rule("symbol_ratio", most=0.1),
    Rule("shouted_ratio", most=0.3),
    Rule("stop_word_ratio", least=0.02),
    Rule("dup_line_ratio", most=0.5),
    Rule("bullet_line_ratio", most=0.9),
    Rule("ellipsis_line_ratio", most=0.3),
)

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _only(text: str, kept: str) -> Column:
    """Number of characters of the class ``kept``."""
    return F.length(F.regexp_replace(text, f"[^{kept}]+", "")).cast("long")


def _lines_with(pattern: str) -> Column:
    return F.size(F.filter("lines", lambda line: line.rlike(pattern))).cast("long")


def _listed() -> Column:
    """Whether a row's label names a language with stop words, its region left out; null if it names none."""
    name = F.lower(F.regexp_extract(LANG, "^[A-Za-z]*", 0))
    return F.when(~name.isin("", "und"), name.isin(sorted(STOP_WORDS)))


def measures(docs: DataFrame, carried: Sequence[str], text: str = "text") -> DataFrame:
    """The columns ``carried`` with the counts of the text and the ratios that rules name.

    Words are runs of characters other than space and the five ASCII controls from tab to carriage return; lines are
    what newlines separate, if they have a word.  A null text has neither; ratios of nothing are 0.  Repeated rows are
    repeated, and every row is judged by its own text alone.

    Three-word windows are compared as 64-bit hashes: equal windows always meet, and any two different windows of one
    text meet with a chance of n_words squared in 2 to the 65.
    """
    stops = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    lang = F.col(LANG).cast("string") if LANG in docs.columns else F.lit(None).cast("string")
    row = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(carried)]).alias("row")
    split = docs.select(row, lang.alias(LANG), F.coalesce(F.col(text), F.lit("")).alias("text")).select(
        "row",
        LANG,
        "text",
        F.array_remove(F.split("text", f"[{SPACE}]+"), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{SPACE}]")).alias("lines"),
    )
    # A hash for the window that begins at each word; the last two words begin none.
    hashed = split.withColumn(
        "windows",
        F.expr(
            "transform(slice(words, 1, greatest(size(words) - 2, 0)),"
            " (w, i) -> xxhash64(w, get(words, i + 1), get(words, i + 2)))"
        ),
    )
    # Only a text with some repeated window needs its windows in order of hash and place.
    none = "cast(array() as array<struct<h: bigint, i: int>>)"
    ordered = hashed.withColumn(
        "ordered",
        F.expr(
            "if(size(array_distinct(windows)) = size(windows),"
            f" {none}, sort_array(transform(windows, (h, i) -> struct(h, i))))"
        ),
    ).drop("windows")
    repeated = ordered.withColumn(
        "places",
        F.expr(
            "sort_array(transform(filter(ordered, (w, j) ->"
            " (w.h <=> get(ordered, j - 1).h) or (w.h <=> get(ordered, j + 1).h)), w -> w.i))"
        ),
    ).drop("ordered")
    n_words, n_lines = F.size("words").cast("long"), F.size("lines").cast("long")
    # A window covers three words, or those up to the next window.
    covered = F.expr(
        "aggregate(transform(places, (p, j) -> least(3, coalesce(get(places, j + 1) - p, 3))), 0L, (n, c) -> n + c)"
    )
    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.array_join("words", "")).cast("long"),
        "n_symbols": _only("text", SYMBOLS),
        "n_lines": n_lines,
        "n_dup_lines": n_lines - F.size(F.array_distinct("lines")),
        "n_repeat_words": covered,
        "n_upper": _only("text", r"\p{Lu}"),
        "n_stops": F.size(F.filter("words", lambda word: F.lower(word).isin(stops))).cast("long"),
        "n_bullets": _lines_with(rf"^[{SPACE}]*[-*•‣·]"),
        "n_ellipses": _lines_with(rf"(\.\.\.|…)[{SPACE}]*$"),
        # Scripts are looked at only where no label tells the language.
        "stop_words_known": F.coalesce(_listed(), F.lit(2) * _only("text", LATIN) >= _only("text", r"\p{L}")),
    }
    counted = settled(repeated, ["row"], counts)

    def ratio(part: str, whole: str) -> Column:
        return F.coalesce(F.col(part) / F.nullif(F.col(whole), F.lit(0)), F.lit(0.0))

    ratios = {
        "mean_word_length": ratio("word_chars", "n_words"),
        "symbol_ratio": ratio("n_symbols", "n_words"),
        "shouted_ratio": ratio("n_upper", "word_chars"),
        "stop_word_ratio": ratio("n_stops", "n_words"),
        "dup_line_ratio": ratio("n_dup_lines", "n_lines"),
        "bullet_line_ratio": ratio("n_bullets", "n_lines"),
        "ellipsis_line_ratio": ratio("n_ellipses", "n_lines"),
    }
    return counted.select("row", "stop_words_known", *_COUNTS, *[value.alias(name) for name, value in ratios.items()])


def judged(docs: DataFrame, carried: Sequence[str], rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """``measures`` with base_failed, failed (the metrics of the rules that fail) and kept.

    A rule on ``stop_word_ratio`` holds only where ``stop_words_known``.
    """
    measured = measures(docs, carried, text)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.lit(100) * F.col("n_repeat_words") > F.lit(MAX_REPEATED) * F.col("n_words")
    )

    def held(rule: Rule) -> Column:
        return F.col("stop_words_known") & rule.failed() if rule.metric == "stop_word_ratio" else rule.failed()

    failed = F.array_compact(F.array(*[F.when(held(r), F.lit(r.metric)) for r in rules]))
    return measured.withColumns({"base_failed": base_failed, "failed": failed}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed") == 0)
    )


def quality_report(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every document's counts, ratios and verdict, from its own text and label alone.

    A null or empty text has no words and fails the base, as all below ``MIN_WORDS`` do.  Texts may be of any length.  Repeated
    rows are repeated, an empty table gives an empty report, and other columns are not looked at.
    """
    ratios = sorted({r.metric for r in rules} - set(_COUNTS))
    return judged(docs, ["doc_id"], rules).select(
        F.col("row.c0").alias("doc_id"), *_COUNTS, "base_failed", "kept", F.array_join("failed", " ").alias("failed"),
        *ratios,
    )


def keep_good(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` whose text passes the base and the rules, with all their columns, whatever their names."""
    kept = judged(docs, docs.columns, rules).filter("kept")
    return kept.select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
