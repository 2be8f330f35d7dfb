"""Benchmark windows in documents against plain Python."""

import hashlib
import re

import pytest
from compare import connect, differences
from corpus import clashing, documents, found, nothing, prose, rows

from tillroll.llm import contamination, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, window=contamination.WINDOW):
    windows = {}
    for item_id, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item_id)
    lengths = {len(w) for w in windows}
    want = []
    for doc_id, text, *_ in docs:
        w, hit, ids = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (of := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    ids |= of - {None}
        listed = ",".join(sorted(map(str, ids)))
        digest = hashlib.sha256(listed.encode()).hexdigest()
        want.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(want, key=lambda r: [(x is not None, x) for x in r])


PASSAGE = prose(50, 40)
LEAKED = [
    (100, "before " + PASSAGE + " after", "en", "a"),
    (101, PASSAGE.upper().replace(" ", " -- "), "en", "a"),
    (102, " ".join(PASSAGE.split()[:12]), "en", "a"),
    (103, " ".join(PASSAGE.split()[:9]) + " else " + " ".join(PASSAGE.split()[9:18]), "en", "a"),
    (104, PASSAGE + " " + prose(51, 5) + " " + PASSAGE, "en", "a"),
    (105, "Größe É é ÉTÉ " * 6, "de", "a"),
    (106, "só one short item here", "pt", "a"),
]
QUESTIONS = [
    (7, PASSAGE),
    (7, prose(2, 120)),
    (10, "Größe É é été! Größe É é ÉTÉ größe É é ÉTÉ Größe É"),
    (11, "Größe É é ÉTÉ größe É é ÉTÉ Größe É é ÉTÉ Größe"),
    (2, "short ITEM"),
    (3, "one"),
    (None, "two words"),
    (4, None),
    (5, " ,;: "),
    (12, prose(50, 40) + " and more"),
]


@pytest.mark.parametrize("spread", [False, True])
def test_windows_as_in_plain_python(spark, monkeypatch, spread):
    data = rows() + LEAKED + LEAKED[:2]
    docs, items = documents(spark, data), spark.createDataFrame(QUESTIONS, ITEMS)
    if spread:
        # A full bitmap, no broadcast, and every key of a few rows spread.
        monkeypatch.setattr(contamination, "LEAST_BITS", 7)
        monkeypatch.setattr(contamination, "MOST_BITS", 7)
        found_hot = contamination.hot_keys
        monkeypatch.setattr(
            contamination, "hot_keys", lambda df, *keys: found_hot(df, *keys, share=0.01, min_rows=2)
        )
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = contamination.contamination(clashing(docs), items)
        assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        assert found(got) == plain([r[:2] for r in data], QUESTIONS)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_rows_or_items(spark):
    items = spark.createDataFrame(QUESTIONS, ITEMS)
    assert contamination.contamination(nothing(spark), items).count() == 0
    data = [r[:2] for r in rows()]
    for empty in ([], [(1, None)]):
        got = contamination.contamination(documents(spark), spark.createDataFrame(empty, ITEMS))
        assert found(got) == plain(data, [])


def test_every_shared_window_has_a_shared_fingerprint(spark):
    """A passage at shifting places, with other words around it."""
    item = prose(60, 10)
    data = [(i, prose(61 + i, i) + " " + item + " " + prose(90 + i, 7), "en", "a") for i in range(30)]
    got = contamination.contamination(documents(spark, data), spark.createDataFrame([(1, item)], ITEMS))
    assert [r.n_hit for r in got.collect()] == [len(words(item))] * 30


def test_query_matches_its_statement(spark):
    sql = queries.statements()["op13_decontamination"]
    assert differences(queries.op13_decontamination(spark, SF), connect(SF), sql) == []


def test_main_path_is_built_in_functions(spark):
    plan = queries.op13_decontamination(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
