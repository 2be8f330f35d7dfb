"""Repair of conversations against all cheapest repairs, row by row."""

import hashlib
import random
import re
import time
import zlib
from collections import defaultdict

import pytest
from compare import connect, differences
from pyspark.sql import functions as F

from tillroll.llm import conversations, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
AFTER = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def every_cheapest(initials, faults):
    """Least (cost, edits) by state over all edits; states are the last role."""
    best = {"": (0, "")}

    def insert(best):
        for _ in range(3):
            for state, (cost, path) in list(best.items()):
                after = "a" if state == "u" else "u"
                way = (cost + 5, path + "I")
                best[after] = min(best.get(after, way), way)
        return best

    best = insert(best)
    for initial, fault in zip(initials, faults):
        after = defaultdict(list)
        more = 5 if fault == "cut" else 0
        for state, (cost, path) in best.items():
            after[state].append((cost + 2, path + "D"))
            if fault in ("", "cut"):
                if (kept := AFTER.get((state, initial))) is not None:
                    after[kept].append((cost + more, path + "K"))
                after["a" if state == "u" else "u"].append((cost + 1 + more, path + "R"))
        best = insert({state: min(ways) for state, ways in after.items()})
    return min(best[state] for state in ("", "a") if state in best)


FAULTS = {"": conversations.NONE, "blank": conversations.BLANK, "dup": conversations.DUPLICATE, "cut": conversations.CUT}


@pytest.mark.parametrize("segment", [1, 3, 128])
def test_search_finds_the_least_cheapest_edits(monkeypatch, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    rng = random.Random(segment)
    for _ in range(1500):
        n = rng.randint(0, 9)
        initials = "".join(rng.choice("suuaax") for _ in range(n))
        faults = [rng.choice(["", "", "", *FAULTS]) for _ in range(n)]
        coded = bytes(FAULTS[f] for f in faults)
        assert conversations.cheapest(initials.replace("x", "\0").encode(), coded) == every_cheapest(initials, faults)


def test_long_conversations_take_time_in_proportion():
    rng = random.Random(5)
    took = []
    for n in (2000, 8000):
        initials = "".join(rng.choice("sua") for _ in range(n))
        faults = [rng.choice(["", "", *FAULTS]) for _ in range(n)]
        start = time.process_time()
        got = conversations.cheapest(initials.encode(), bytes(FAULTS[f] for f in faults))
        took.append(time.process_time() - start)
        if n == 2000:
            assert got == every_cheapest(initials, faults)
    assert took[1] < 12 * took[0] + 1


def plain(data):
    rows = defaultdict(list)
    for conv_id, turn, role, text in data:
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        rows[conv_id] += [(turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv_id, said in rows.items():
        said.sort(key=lambda r: (r[0] is not None, r[0], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in said:
            body = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = "blank" if not body else "dup" if (role, text) in seen else "" if body[-1] in ".!?" else "cut"
            faults.append(fault)
            seen.add((role, text))
        initials = [r[1][:1] for r in said]
        cost, audit = every_cheapest(initials, faults)
        lines, state, at = [], "", 0
        for edit in audit:
            _, role, text = said[at] if edit != "I" else (None, "", "")
            at += edit != "I"
            if edit != "D":
                role = role if edit == "K" else "assistant" if state == "u" else "user"
                state = role[:1]
                lines.append(f"{role}:{text}")
        turns = {t for t, _, _ in said if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "dup", "cut")]
        out.append((conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0]))


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0]))


def made():
    rng = random.Random(8)
    ends = [".", "!", "?", "", ".\n ", " ", "é."]
    data = [
        (c, t, rng.choice(["user", "assistant", "assistant", "user", "system", "tool"]), f"said {rng.randint(0, 6)}{rng.choice(ends)}")
        for c in range(60)
        for t in range(rng.randint(1, 12))
    ]
    data += [(200, t, "user" if t % 2 else "assistant", f"{t % 90} words.") for t in range(700)]
    data += [(None, t, r, x) for t in (None, 1, 2) for r in (None, "", "user") for x in (None, "", "hello.", "hello.")]
    data += [(300, 5, "user", "x" * 200_000 + ".\n"), (300, 6, "assistant", "日本語。" * 1000), (300, 7, "user", " " * 100_000)]
    return data + data[:5]


def test_repair_as_in_plain_python(spark, monkeypatch):
    data = made()
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("own") for c in ("kind", "copies", "digest", "part")})
    result = conversations.repaired_conversations(df)
    assert got(result) == plain(data)
    assert all(re.fullmatch("[DIKR]*", r.audit) for r in result.collect())


def test_conversations_whose_rows_are_all_dropped(spark):
    dropped = [(c, 0, "user", "a.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert dropped
    rows = got(conversations.repaired_conversations(spark.createDataFrame(dropped, SCHEMA)))
    empty = hashlib.sha256(b"").hexdigest()
    assert rows == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c, *_ in dropped]
    assert conversations.repaired_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_matches_its_statement(spark):
    sql = queries.statements()["op11_conversation_repair"]
    assert differences(queries.op11_conversation_repair(spark, SF), connect(SF), sql) == []
