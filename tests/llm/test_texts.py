"""Quality rules, fingerprints and near duplicates against plain Python."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import regex
import xxhash
from compare import connect, differences
from corpus import WORDS, clashing, documents, found, nothing, prose, rows
from pyspark.sql import functions as F

from tillroll.llm import neardup, quality, queries, syncmers

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(want):
    return sorted(want, key=lambda r: [(x is not None, x) for x in r])


def plain_counts(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = defaultdict(list)
    for i in range(len(words) - 2):
        windows[tuple(words[i : i + 3])].append(i)
    covered = {i + k for places in windows.values() if len(places) > 1 for i in places for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_counts(spark):
    want = []
    for doc_id, text, _, _ in rows():
        counts = plain_counts(text)
        want.append((doc_id, *counts, counts[0] < 50 or 100 * counts[4] > 50 * counts[0]))
    got = quality.quality_report(clashing(documents(spark)))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert found(got.select(*names)) == order(want)
    assert quality.quality_report(nothing(spark)).count() == 0
    assert got.filter("base_failed and kept").count() == 0


@pytest.mark.parametrize(
    "text, failed",
    [
        (prose(1, 200), ""),
        (" | ".join(prose(2, 200).split()), "symbol_ratio"),
        (prose(3, 200).upper(), "shouted_ratio"),
        (" ".join(f"word{i}" for i in range(100)), "stop_word_ratio"),
        ("\n".join("- " + " ".join(prose(i, 9).split()) for i in range(20)), "bullet_line_ratio"),
        ("\n".join(" ".join(prose(i, 9).split()) + " ..." for i in range(20)), "ellipsis_line_ratio"),
        (" ".join("abcdefghijklmnopqrstuvwxyz" + str(i) for i in range(95)) + " the of and to", "mean_word_length"),
    ],
)
def test_each_rule(spark, text, failed):
    row = quality.quality_report(documents(spark, [(1, text, "en", "s")])).first()
    assert (row["failed"], row["kept"]) == (failed, failed == "")


RUSSIAN = "река течёт мимо старого города и в нём живут люди которые не знают друг друга но любят тихие вечера".split()
ITALIAN = "il fiume scorre lento vicino alla città dove gli abitanti che non dormono parlano di vecchie storie".split()


def shuffled(seed, words, times=5):
    rng = random.Random(seed)
    return " ".join(w for _ in range(times) for w in rng.sample(words, len(words)))


@pytest.mark.parametrize("lang, known", [("ru", True), (None, True), ("en", False), ("en-GB", False)])
def test_stop_words_are_not_asked_of_other_scripts_and_languages(spark, lang, known):
    docs = documents(spark, [(1, shuffled(1, RUSSIAN), lang, "s")])
    row = quality.quality_report(docs).first()
    assert (row["failed"], row["kept"]) == (("", True) if known else ("stop_word_ratio", False))
    assert quality.keep_good(docs).count() == known


def test_unlabelled_texts_of_a_labelled_language_without_a_list(spark):
    data = [(i, shuffled(i, ITALIAN), "it", "s") for i in range(5)]
    words = [f"word{i}" for i in range(90)]
    data += [(10, shuffled(10, ITALIAN), None, "s"), (11, " ".join(words), None, "s"), (12, " ".join(words), "en", "s")]
    kept = quality.keep_good(documents(spark, data))
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4, 10]


def test_statement_and_query_agree_on_labels(spark, tmp_path):
    """Labels with a list, without one, with a region, unknown and none; and no row changes another's measures."""
    data = [
        (10 * i + j, text, lang, "s")
        for i, lang in enumerate(["ru", "it", None, "en-GB", "EN", "und", "", "de", "pt-BR"])
        for j, text in enumerate([shuffled(1, RUSSIAN), shuffled(2, ITALIAN), prose(3, 90), " ".join(f"w{k}" for k in range(60))])
    ]
    data += [(1000 + r[0], *r[1:]) for r in rows() if r[0] is not None]
    docs = documents(spark, data)
    docs.coalesce(1).write.parquet(str(tmp_path / "made"))
    (file,) = (tmp_path / "made").glob("*.parquet")
    file.rename(tmp_path / "documents.parquet")
    got = queries.op1_quality_rules(spark, str(tmp_path))
    assert differences(got, connect(str(tmp_path)), queries.statements()["op1_quality_rules"]) == []
    assert {r["doc_id"] for r in got.filter("kept").collect()} >= {0, 10, 20}
    alone = quality.quality_report(documents(spark, data[5:6])).first()
    assert alone == got.filter(F.col("doc_id") == data[5][0]).first()


def test_kept_rows_keep_their_columns(spark):
    docs = clashing(documents(spark))
    kept = quality.keep_good(docs)
    assert kept.schema.names == docs.schema.names
    report = quality.quality_report(docs).filter("kept")
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in report.collect())


def test_quality_needs_no_python_and_no_shuffle(spark):
    plan = quality.quality_report(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_quality_statement(spark):
    con = connect("/root/testdata/sf0.001")
    got = queries.op1_quality_rules(spark, "/root/testdata/sf0.001")
    assert differences(got, con, queries.statements()["op1_quality_rules"]) == []


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def hash_longs(values, seed=42):
    for v in values:
        seed = xxhash.xxh64_intdigest((v & (2**64 - 1)).to_bytes(8, "little"), seed=seed)
    return signed(seed)


UNSPACED = regex.compile(
    r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}\u3000-\u303F\u30FC\uFF00-\uFFEF]"
)
ENDS = set("aeuAEOU05/") | {chr(c) for a, b in ("!-", ":@", "[`", "{~") for c in range(ord(a), ord(b) + 1)}


def cut_by_content(part):
    """Characters beyond ASCII one by one; others up to one of ENDS, or 16 where there is none."""
    found = []
    while part:
        n = 1
        if part[0] <= "\x7f":
            ascii_ = next((i for i, c in enumerate(part[:16]) if c > "\x7f"), min(16, len(part)))
            n = next((i + 1 for i, c in enumerate(part[:ascii_]) if c in ENDS), ascii_)
        found.append(part[:n])
        part = part[n:]
    return found


def plain_symbols(text):
    found = []
    for word in re.findall(r"[^ \t-\r]+", text):
        unspaced = [bool(UNSPACED.match(c)) for c in word]
        runs = any(all(unspaced[i : i + 4]) for i in range(min(33, len(word) - 3)))
        if runs or len(word) > 32:
            found += cut_by_content(word)
        elif any(unspaced):
            found += [word[:16], *cut_by_content(word[16:])]
        else:
            found += [w for w in (word[:16], word[16:]) if w]
    return found


def plain_anchors(text):
    symbols = [signed(xxhash.xxh64_intdigest(s.encode(), seed=42)) for s in plain_symbols(text)]
    parts = [hash_longs(symbols[i : i + 2]) for i in range(len(symbols) - 1)]
    w, anchors = syncmers.PARTS, []
    for i in range(len(parts) - w + 1):
        inside = parts[i : i + w]
        if min(inside) in (inside[0], inside[-1]):
            anchors.append(hash_longs(inside[::2]))
    if anchors or not text:
        return anchors
    return [hash_longs(symbols) if symbols else signed(xxhash.xxh64_intdigest(text.encode(), seed=42))]


def plain_fingerprints(data):
    ordered = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (doc_id, text, _, _) in enumerate(ordered):
        text, after = text or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = plain_anchors(text), plain_anchors(edited), plain_anchors(after)

        def likeness(x, y):
            x, y = set(x), set(y)
            return len(x & y) / len(x | y) if x | y else 1.0

        def shown(x):
            return " ".join(f"{v & (2**64 - 1):x}" for v in x)

        digest = hashlib.sha256(edited.encode()).hexdigest()
        want.append((doc_id, len(text), digest, shown(a), shown(b), likeness(a, b), likeness(a, c)))
    return want


def test_fingerprints(spark):
    assert found(syncmers.fingerprints(clashing(documents(spark)))) == order(plain_fingerprints(rows()))
    assert syncmers.fingerprints(nothing(spark)).count() == 0


def test_successors_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(syncmers, "NEIGHBOURS", 5)
    rng = random.Random(1)
    ids = rng.sample(range(-500, 500), 60) + [10**12, 10**12 + 7]
    data = [(i, prose(i, rng.randint(0, 40)), "en", "s") for i in ids]
    assert found(syncmers.fingerprints(documents(spark, data).repartition(7))) == order(plain_fingerprints(data))
    one = [(3, prose(1, 30), "en", "s")]
    assert found(syncmers.fingerprints(documents(spark, one))) == order(plain_fingerprints(one))


def test_shared_passages_match_by_position(spark):
    passage = prose(9, 60)
    texts = [f"{prose(1, 40)} {passage} {prose(2, 10)}", f"{prose(3, 5)} {passage}"]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    anchored = syncmers.anchors(docs, "text", "anchors").select("doc_id", "anchors")
    best = syncmers.matches(anchored.filter("doc_id = 0"), anchored.filter("doc_id = 1")).orderBy(F.desc("matches")).first()
    assert best["matches"] >= 10


def unspaced(kind, n):
    rng = random.Random(n)
    if kind == "base64":
        return "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", k=n))
    if kind == "code":
        return "".join(rng.choice(WORDS) + rng.choice("();=_") for _ in range(n // 6))
    first, last = {"han": (0x4E00, 0x9000), "thai": (0x0E01, 0x0E2E), "kana": (0x3041, 0x3096)}[kind]
    return "".join(chr(rng.randint(first, last)) for _ in range(n))


@pytest.mark.parametrize("kind", ["han", "thai", "kana", "base64", "code"])
def test_unspaced_passages_have_their_anchors_at_any_offset(spark, kind):
    passage, other = unspaced(kind, 900), unspaced(kind, 31)
    texts = [passage, f"see {passage}"] + [other[:n] + passage for n in (1, 3, 7, 16, 30)]
    texts += [passage[:5] + other[:1] + passage[5:], passage[:450] + other[:1] + passage[450:]]
    docs = documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    got = dict(syncmers.anchors(docs, "text", "anchors").select("doc_id", "anchors").collect())
    assert len(got[0]) > 30
    for i in range(1, len(texts)):
        assert len(set(got[0]) & set(got[i])) > 0.8 * len(set(got[0])), i


def test_unspaced_and_mixed_texts_as_in_plain_python(spark):
    rng = random.Random(4)
    kinds = ("han", "thai", "kana", "base64", "code")
    data = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 25)):
            word = rng.choice([prose(rng.random(), 1), unspaced(rng.choice(kinds), rng.randint(1, 50)), "ÀÉ" * rng.randint(1, 20)])
            words.append(word + rng.choice(["", "", unspaced("han", rng.randint(1, 5)), "é", ",x", "\x01"]))
        data.append((i, rng.choice([" ", "\n", "\t "]).join(words), "en", "s"))
    docs = documents(spark, data)
    got = dict(syncmers.anchors(docs, "text", "anchors").select("doc_id", "anchors").collect())
    assert got == {i: plain_anchors(text) for i, text, *_ in data}


def test_short_lines_of_unspaced_scripts_match_too(spark):
    lines = [unspaced("han", 12 + i % 4) for i in range(40)]
    pairs = ["\n".join(lines), "\n".join(["起" + line for line in lines])]
    docs = documents(spark, [(i, t, "zh", "s") for i, t in enumerate(pairs)])
    got = dict(syncmers.anchors(docs, "text", "anchors").select("doc_id", "anchors").collect())
    assert set(got[0]) & set(got[1])


def test_fingerprints_need_no_python(spark):
    plan = syncmers.fingerprints(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def plain_shingles(text, k):
    words = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    k = min(k, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def plain_groups(data, k, threshold):
    sets = [plain_shingles(t, k) for _, t, _, _ in data]
    parent = list(range(len(data)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].add(i)
    pairs = {p for h in holders.values() for p in itertools.combinations(sorted(h), 2)}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
            parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for i in range(len(data)):
        least.setdefault(root(i), []).append(data[i][0])
    want = []
    for i, (doc_id, _, _, _) in enumerate(data):
        known = [d for d in least[root(i)] if d is not None]
        group = min(known) if known else None
        want.append((doc_id, len(sets[i]), group, doc_id is not None and doc_id == group))
    return want


def edited(text, rng, share):
    return " ".join(f"w{rng.random()}" if rng.random() < share else w for w in text.split())


def near_copies():
    """Exact copies, near copies of one text and of each other, and chains that drift away."""
    rng = random.Random(8)
    data = [(i, prose(100 + i, 80), "en", "s") for i in range(40)]
    base = prose(50, 300)
    data += [(100 + i, base, "en", "s") for i in range(15)]
    data += [(200 + i, edited(base, rng, 0.01), "en", "s") for i in range(60)]
    data += [(300 + i, edited(base, rng, 0.035), "en", "s") for i in range(40)]
    drift = prose(60, 400)
    for i in range(12):
        data.append((400 + i, drift, "en", "s"))
        drift = edited(drift, rng, 0.015)
    return data


@pytest.mark.parametrize("k, threshold", [(3, 85), (5, 80)])
@pytest.mark.parametrize("block", [1000, 7])
def test_near_duplicates(spark, monkeypatch, k, threshold, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    data = near_copies() + rows()
    got = found(neardup.near_duplicates(clashing(documents(spark, data)), k, threshold))
    assert got == order(plain_groups(data, k, threshold))


def test_near_duplicates_of_the_test_table(spark):
    sf = "/root/testdata/sf0.001"
    data = [tuple(r)[:4] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert found(queries.op8_near_duplicates(spark, sf)) == order(plain_groups(data, 3, 85))


def test_no_near_duplicates_of_nothing(spark):
    assert neardup.near_duplicates(nothing(spark)).count() == 0
    assert neardup.drop_near_duplicates(nothing(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    data = near_copies() + rows()
    docs = clashing(documents(spark, data))
    kept = neardup.drop_near_duplicates(docs)
    assert kept.schema.names == docs.schema.names
    want = {i for i, _, _, own in plain_groups(data, 5, 80) if own}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(want)


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(2)
    t = neardup.band_count(85) * neardup.BAND_ROWS
    for n in (1, 3, 40, 5000):
        a = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        b = np.concatenate([a[n // 10 :], np.unique(rng.integers(0, 2**63, n // 10).astype(np.uint64))])
        x, y = neardup.sketch(a, t), neardup.sketch(b, t)
        assert not (x == np.iinfo(np.uint64).max).any()
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((x == y).mean() - real) < 0.2
    assert (neardup.sketch(a[::-1].copy(), t) == neardup.sketch(a, t)).all()


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (90, 80), (85, 80)]
    frame = spark.createDataFrame(edges, "a long, b long")
    got = dict(map(tuple, neardup.components(frame).collect()))
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(50)} | {80: 80, 85: 80, 90: 80}
