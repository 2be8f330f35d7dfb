"""Small documents with every awkward case, and plain Python beside the operators."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

WORDS = "the of and to in river stone cloud maple paper lantern quiet orbit velvet harbour simple copper winter".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    said = [rng.choice(WORDS) + rng.choice(["", "", "ly", "ing", "s", str(rng.randint(0, 99))]) for _ in range(words)]
    return " ".join(w + rng.choice(["", "", "", ",", ".\n"]) for w in said)


def rows():
    """(doc_id, text, lang, source): nulls, empty and very long texts, ties, repeated rows and keys."""
    long_text = prose(1, 30_000)
    texts = [
        prose(2, 120),
        prose(2, 120),
        prose(3, 60) + "\n" + prose(3, 60),
        None,
        "",
        " \t\n ",
        "one",
        "two words",
        "a\n\nb  c \n x   ",
        "Größe façade ñandú ÀÉß 日本語 テスト 한국 Σίσυφος İ \x1c x́",
        "say <|endoftext|> and <|startoftext|> don't WE'LL 12 3x4 !?'s",
        long_text,
        "z" * 150_000,
        "x" + " " * 30_000 + "y " + "\n" * 20_000,
        "same same same same " * 40,
        "1234567890 12.5 %%% ###",
    ]
    made = [(i, t, "en" if i % 2 else None, f"src{i % 3}" if i % 4 else None) for i, t in enumerate(texts)]
    return [*made, made[0], (None, prose(4, 80), "en", "src0"), (-5, prose(5, 70), "de", "src1")]


def documents(spark, data=None):
    data = rows() if data is None else data
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in data], SCHEMA)


def clashing(docs):
    """The same rows with more columns, named like what operators make."""
    names = "score kept n_words words bucket ghost anchors key id band digest queue order place component row ids n"
    return docs.withColumns({n: F.lit(f"own {n}") for n in names.split()})


def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def found(df):
    """Rows as sorted tuples; nulls first."""
    return sorted(map(tuple, df.collect()), key=lambda r: [(x is not None, x) for x in r])
