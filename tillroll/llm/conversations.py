"""Repair of damaged conversations by iterative-deepening A*.

Rows of a conversation are kept, given another role, or deleted, and empty rows are inserted, until the roles read as an
optional system turn and pairs of user and assistant.  The search goes depth first, in the ASCII order of the edits' initials,
under a bound on the cost; when all paths under a bound fail, the least cost that broke it is the next bound.  So the first
path that is accepted is a cheapest one, and among these the least in ASCII.  A table keeps, for every state that failed, the
cost that its rest is known to exceed.

Long conversations are searched from the last ``SEGMENT`` rows to the first: what the rest costs from each of the four states at
a segment's end is known then, so a segment's search is exact, and time grows with the rows alone.

Rows travel once without their texts, to be judged and searched, and once with them, to be written; each time a conversation
streams through one task in the order of its turns.  That task keeps some 20 bytes of a row, never the texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import record_batch, saved, small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Rows that are searched at a time.
SEGMENT = 128
SPACE = "\t\n\x0b\x0c\r "

#: States: nothing yet, after a system turn, after a user's, after an assistant's.  The role that comes next, and the state then.
NEXT = ((ord("u"), 2), (ord("u"), 2), (ord("a"), 3), (ord("u"), 2))
SYSTEM = ord("s")
ROLES = {ord("u"): "user", ord("a"): "assistant"}
#: What is left to insert after the last row.
ENDINGS = ("", "II", "I", "")
NONE, BLANK, DUPLICATE, CUT = range(4)
_LEGAL = {b"su", b"ua", b"au"}


def _kept_state(state: int, initial: int) -> int | None:
    """The state after a kept row, if it may stay."""
    if state == 0 and initial == SYSTEM:
        return 1
    wanted, after = NEXT[state]
    return after if initial == wanted else None


class _Segment:
    """Search over a run of rows, when the cost of all that follows is known for every state at its end."""

    def __init__(self, initials: bytes, faults: bytes, ends: list[int]):
        self.initials, self.faults, self.ends = initials, faults, ends
        least = [min(ends)]
        for fault in reversed(faults):
            # Every faulty row costs its deletion, or more if it stays.
            least.append(least[-1] + (DELETE if fault else 0))
        self.least = least[::-1]
        self.failed: dict[tuple[int, int], int] = {}

    def rest(self, at: int, state: int) -> int:
        """A cost that the rest is known to have at least."""
        return max(self.least[at], self.failed.get((at, state), 0))

    def edits(self, at: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(initial, cost, row, state) of what can be done here, in ASCII order."""
        fault, (_, after) = self.faults[at], NEXT[state]
        yield "D", DELETE, at + 1, state
        yield "I", INSERT, at, after
        if fault not in (BLANK, DUPLICATE):
            more = TRUNCATED if fault == CUT else 0
            kept = _kept_state(state, self.initials[at])
            if kept is not None:
                yield "K", KEEP + more, at + 1, kept
            yield "R", REROLE + more, at + 1, after

    def search(self, state: int) -> tuple[int, str, int]:
        """(cost with all that follows, edits, state at the end) of the first accepted path."""
        bound = self.rest(0, state)
        while True:
            path: list[str] = []
            found = self._descend(0, state, bound, path)
            if found < 0:
                return bound, "".join(path), -found - 1
            bound = found

    def _descend(self, at: int, state: int, left: int, path: list[str]) -> int:
        """The end state as -1 - state if a path within ``left`` is accepted, else the least cost that might be."""
        if at == len(self.faults):
            return -1 - state if self.ends[state] <= left else self.ends[state]
        over = None
        for edit, cost, row, after in self.edits(at, state):
            need = cost + self.rest(row, after) if row < len(self.faults) else cost + self.ends[after]
            if need <= left:
                path.append(edit)
                found = self._descend(row, after, left - cost, path)
                if found < 0:
                    return found
                path.pop()
                need = cost + found
            over = need if over is None else min(over, need)
        self.failed[at, state] = over
        return over


def cheapest(initials: bytes, faults: bytes) -> tuple[int, str]:
    """Cost and edits of the repair: one initial per row and insertion, D, I, K or R, in order."""
    ends = [INSERT * len(tail) for tail in ENDINGS]
    later: list[list[tuple[str, int]]] = []
    starts = range(0, len(initials), SEGMENT)
    for start in reversed(starts):
        segment = _Segment(initials[start : start + SEGMENT], faults[start : start + SEGMENT], ends)
        found = [segment.search(state) for state in (range(4) if start else range(1))]
        later.append([(path, end) for _, path, end in found])
        ends = [cost for cost, _, _ in found]
    state, parts = 0, []
    for ways in reversed(later):
        path, state = ways[state]
        parts.append(path)
    return ends[0], "".join(parts) + ENDINGS[state]


@dataclass
class _Judged:
    """One conversation as its rows stream by."""

    conv_id: int | None
    initials: bytearray = field(default_factory=bytearray)
    flags: bytearray = field(default_factory=bytearray)
    digests: bytearray = field(default_factory=bytearray)
    turns: int = 0
    first: int | None = None
    last: int | None = None

    def add(self, turn: int | None, initial: str, flag: int, digest: bytes, copies: int) -> None:
        if copies and turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.turns, self.last = self.turns + 1, turn
        for _ in range(copies):
            # Only the three roles' initials are told apart; any other, or none, fits nowhere.
            self.initials.append(ord(initial) if initial in ("s", "u", "a") else 0)
            self.flags.append(flag)
            self.digests += digest

    def result(self) -> dict[str, object]:
        faults = np.frombuffer(self.flags, np.uint8).copy()
        digests = np.frombuffer(self.digests, "S16")
        again = np.ones(len(faults), dtype=bool)
        again[np.unique(digests, return_index=True)[1]] = False
        faults[again & (faults != BLANK)] = DUPLICATE
        initials = bytes(self.initials)
        cost, audit = cheapest(initials, faults.tobytes())
        return {
            "conv_id": self.conv_id,
            "gaps": 0 if self.first is None else self.last - self.first + 1 - self.turns,
            "blank": int((faults == BLANK).sum()),
            "duplicate": int((faults == DUPLICATE).sum()),
            "truncated": int((faults == CUT).sum()),
            "illegal": sum(initials[i : i + 2] not in _LEGAL for i in range(len(initials) - 1)),
            "cost": cost,
            "audit": audit,
        }


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_SEARCHED = f"conv_id long, {', '.join(f'{c} long' for c in _COUNTS)}, audit string"
_REPAIRED = f"{_SEARCHED}, repaired_sha256 string"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _results(ddl: str, rows: list[dict[str, object]]) -> pa.RecordBatch:
    schema = _schema(ddl)
    return record_batch(schema, {f.name: [r[f.name] for r in rows] for f in schema})


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted conversations to one row per conversation."""
    now: _Judged | None = None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "flag", "digest", "copies")]
        for conv_id, *row in zip(*columns):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.result())
                now = _Judged(conv_id)
            now.add(*row)
        yield _results(_SEARCHED, done)
    if now is not None:
        yield _results(_SEARCHED, [now.result()])


def _write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations, the search's row before the others, to the search's rows with the digest of the repair."""
    now: dict[str, object] = {}
    digest, edits, state, written = hashlib.sha256(), "", 0, False

    def put(role: str, text: str) -> None:
        nonlocal written
        if written:
            digest.update(b"\n")
        digest.update(role.encode("utf-8", "replace") + b":")
        digest.update(text.encode("utf-8", "replace"))
        written = True

    def inserted(at: int) -> int:
        """Puts the insertions that stand here; the place of the next edit of a row."""
        nonlocal state
        while edits[at : at + 1] == "I":
            wanted, state = NEXT[state]
            put(ROLES[wanted], "")
            at += 1
        return at

    at, names = 0, ("conv_id", *_COUNTS, "copies", "role", "text")
    for batch in small_batches(batches, "text"):
        done = []
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            r = dict(zip(names, row))
            if r["cost"] is not None:
                if now:
                    inserted(at)
                    done.append(now | {"repaired_sha256": digest.hexdigest()})
                now = r | {"audit": r["text"]}
                digest, edits, state, written, at = hashlib.sha256(), r["text"], 0, False, 0
                continue
            for _ in range(r["copies"]):
                at = inserted(at)
                edit, at = edits[at], at + 1
                if edit == "K":
                    state = _kept_state(state, ord(r["role"][0]))
                    put(r["role"], r["text"])
                elif edit == "R":
                    wanted, state = NEXT[state]
                    put(ROLES[wanted], r["text"])
        yield _results(_REPAIRED, done)
    if now:
        inserted(at)
        yield _results(_REPAIRED, [now | {"repaired_sha256": digest.hexdigest()}])


def damaged(conversations: DataFrame, kind: Column) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged as ``kind`` says, null roles and texts being one space.

    0 drops a row (no copies), 1 empties its text, 2 takes out its full stops, exclamation and question marks, 3 repeats it
    (two copies), 4 gives it the role user; others leave it.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        kind.alias("kind"),
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).alias("copies"),
    )


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``rows`` are (conv_id, turn, role, text, copies), role and text not null; those with no copies only name their
    conversation.  Rows of a conversation are in the order of their turns, null turns first, and rows of one turn in the order
    of the MD5 of role and text, so repeated rows stand together.  A null conv_id is a conversation.  A conversation
    without rows costs nothing and has an empty audit.  A role counts by its first character; an empty one fits nowhere.
    """
    # The length tells where the role ends and the text begins.
    content = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.withColumn("digest", F.unhex(F.md5(content)))
    ended = F.rtrim("text", F.lit(SPACE))
    flag = F.when(ended == "", BLANK).when(F.right(ended, F.lit(1)).isin(".", "!", "?"), NONE).otherwise(CUT)
    traits = keyed.select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), flag.alias("flag"), "digest", "copies"
    )
    order = ("conv_id", F.asc_nulls_first("turn"), "digest")
    searched = traits.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_judge, _SEARCHED)
    searched = saved(searched, "searched")

    heads = searched.select(
        "conv_id", F.lit(0).alias("part"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"),
        F.lit(0).alias("copies"), *_COUNTS, F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"),
    )
    nothing = [F.lit(None).cast("long").alias(c) for c in _COUNTS]
    bodies = keyed.filter("copies > 0").select(
        "conv_id", F.lit(1).alias("part"), "turn", "digest", "copies", *nothing, "role", "text"
    )
    streamed = heads.unionByName(bodies).repartition("conv_id")
    order = ("conv_id", "part", F.asc_nulls_first("turn"), "digest")
    return streamed.sortWithinPartitions(*order).drop("part", "turn", "digest").mapInArrow(_write, _REPAIRED)


def repaired_conversations(conversations: DataFrame) -> DataFrame:
    """The conversations damaged by the CRC-32 of ``conv_id:turn`` (a null being one space), and repaired."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    return repair(damaged(conversations, kind))
