"""Conversation structure repair by dynamic programming over streamed, secondary-sorted rows.

A sound conversation is ``(s?(ua)+)?`` in the initials of its roles: an optional system row, then user and assistant rows
in turn.  Every row is kept (cost 0), given the role user or assistant (3) or deleted (4; blank rows and duplicates must
be); rows of either role with an empty text may be inserted anywhere (3); a truncated row that is not deleted adds 3.  The
cheapest edits win; of equally cheap ones those whose letters (Delete, Insert, Keep, Rerole) come first in ASCII order.

Rows are dealt by conversation and sorted by turn (nulls first), role and text; ``mapInPandas`` carries four states
across Arrow batches: how far the pattern has come, each with its cost, its place in the order of edits and a running
digest of the repaired text.  Per row and state one byte points back to the state before, the inserts between and the edit.  A conversation of up to
``HELD`` rows and ``HELD_CHARS`` characters is held in memory and ends with its back-pointers walked; the rows of a longer
one leave the task with their back-pointers, four bytes a row, as output, and a second pass over such rows, sorted backwards, walks
them.  No task holds a conversation; the audit text of one letter per edit is the only value that grows with it.

Null roles and texts count as one blank.  Rows with a null id form one conversation.  Equal rows of one turn: the later
ones are duplicates.  An empty table gives none.  Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import SPACES, stored

#: Costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows and characters of a conversation that a task holds; beyond, they leave it with their back-pointers.
HELD, HELD_CHARS = 10_000, 8_000_000
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
#: Where a user or assistant row leads from each state; no other role may follow an insert.
NEXT = {START: ("user", AFTER_USER), AFTER_SYSTEM: ("user", AFTER_USER), AFTER_USER: ("assistant", AFTER_ASSISTANT), AFTER_ASSISTANT: ("user", AFTER_USER)}
#: Any state can be left for any other's continuation at this cost at most, so costlier states are dropped.
WORST = 7
ENDS = (START, AFTER_ASSISTANT)
LEGAL = frozenset(("su", "ua", "au"))

#: (cost above the cheapest, place in the order of edits) of each live state.
States = tuple[tuple[int, int, int], ...]
FIRST: States = ((START, 0, 0),)


def _inserted(state: int, n: int) -> tuple[int, list[str]]:
    roles = []
    for _ in range(n):
        role, state = NEXT[state]
        roles.append(role)
    return state, roles


@lru_cache(maxsize=None)
def step(states: States, initial: str, must_go: bool, truncated: bool) -> tuple[int, States, tuple[tuple[int, int, int, str], ...]]:
    """One row: the cost that all states share from here on, the new states, and how each came about:
    (state, state before, inserts before the row, edit).

    No more than two inserts are worth while.  Edits up to a row are never the beginning of other edits up to that row (all
    end with the row's own), so their order among each other settles the order of everything that follows.
    Costs above the cheapest are at most ``WORST``: there are few different calls.
    """
    best: dict[int, tuple] = {}
    for state, cost, place in states:
        for n in range(3):
            at, _ = _inserted(state, n)
            base = cost + INSERT * n
            moves = [("D", at, base + DELETE)]
            if not must_go:
                base += TRUNCATED if truncated else 0
                role, to = NEXT[at]
                moves.append(("R", to, base + REROLE))
                if initial == role[0]:
                    moves.append(("K", to, base))
                elif initial == "s" and at == START:
                    moves.append(("K", AFTER_SYSTEM, base))
            for edit, to, total in moves:
                key = (total, place, "I" * n + edit, state, n, edit)
                if to not in best or key < best[to]:
                    best[to] = key
    low = min(k[0] for k in best.values())
    live = {to: k for to, k in best.items() if k[0] <= low + WORST}
    order = {to: place for place, to in enumerate(sorted(live, key=lambda to: live[to][1:3]))}
    new = tuple((to, live[to][0] - low, order[to]) for to in sorted(live))
    return low, new, tuple((to, *live[to][3:]) for to in sorted(live))


@lru_cache(maxsize=None)
def finish(states: States) -> tuple[int, int, int]:
    """(cost above the shared one, last state before the closing inserts, their number)."""
    ends = [(cost + INSERT * n, place, n, state) for state, cost, place in states for n in range(3) if _inserted(state, n)[0] in ENDS]
    cost, _, n, state = min(ends)
    return cost, state, n


EDITS = "DKR"
INSERTED = "I"
#: Of a conversation; ``repaired_sha256``: of ``role:text`` of its repaired rows, joined by newlines.
SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
#: ``place`` orders a conversation's rows; its summary and, in a long one, its end stand at place -1 and behind all rows.
STREAM = f"conv_id {{id}}, place long, edit string, role string, text string, back binary, summary struct<{SUMMARY}>, ends array<int>"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_ARROW = {
    "place": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string(), "back": pa.binary(),
    "summary": pa.struct([*((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]), "ends": pa.list_(pa.int32()),
}


class Conversation:
    """What is carried from row to row."""

    def __init__(self, conv_id, held: int, held_chars: int):
        self.conv_id, self.held, self.held_chars = conv_id, held, held_chars
        self.states, self.cost = FIRST, 0
        self.digests = {START: (hashlib.sha256(), 0)}  # and how many rows went in
        self.rows: list[tuple[str, str]] = []
        self.backs: list[bytes] = []
        self.n = self.chars = 0
        self.long = False
        self.low = self.high = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None

    @staticmethod
    def _told(digest, rows: list[tuple[str, str]]):
        sha, n = digest[0].copy(), digest[1]
        for role, text in rows:
            sha.update((("\n" if n else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
            n += 1
        return sha, n

    def add(self, turn, role: str, text: str, fault: str) -> Iterator[tuple]:
        if turn is not None:
            if self.low is None:
                self.low = turn
            self.turns += turn != self.last_turn
            self.high = self.last_turn = turn
        self.blank += fault == "blank"
        self.duplicate += fault == "duplicate"
        self.truncated += fault == "truncated"
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in LEGAL
        self.initial = initial
        low, self.states, came = step(self.states, initial if initial in ("u", "a", "s") else "", fault in ("blank", "duplicate"), fault == "truncated")
        self.cost += low
        back, digests = bytearray(4), {}
        for to, before, n, edit in came:
            back[to] = before | n << 2 | EDITS.index(edit) << 4
            at, roles = _inserted(before, n)
            told = [(r, "") for r in roles]
            if edit != "D":
                told.append((role if edit == "K" else NEXT[at][0], text))
            digests[to] = self._told(self.digests[before], told) if told else self.digests[before]
        self.digests = digests
        self.rows.append((role, text))
        self.backs.append(bytes(back))
        self.n += 1
        self.chars += len(text)
        if len(self.rows) >= self.held or self.chars > self.held_chars:
            self.long = True
            yield from self.left()

    def left(self) -> Iterator[tuple]:
        """Rows that leave the task with their back-pointers."""
        first = self.n - len(self.rows)
        for k, ((role, text), back) in enumerate(zip(self.rows, self.backs)):
            yield (self.conv_id, 4 * (first + k) + 2, None, role, text, back, None, None)
        self.rows, self.backs, self.chars = [], [], 0

    def end(self) -> Iterator[tuple]:
        cost, state, n = finish(self.states)
        told = self._told(self.digests[state], [(r, "") for r in _inserted(state, n)[1]])
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        counts = dict(gaps=gaps, blank=self.blank, duplicate=self.duplicate, truncated=self.truncated, illegal=self.illegal, cost=self.cost + cost)
        if self.long:
            yield from self.left()
            yield (self.conv_id, 4 * self.n + 4, None, None, None, None, {**counts, "audit": None, "repaired_sha256": told[0].hexdigest()}, [state, n])
            return
        walk = Walk(self.conv_id, self.n, state, n)
        out = list(walk.closing())
        for k in range(self.n - 1, -1, -1):
            out += walk.back(4 * k + 2, *self.rows[k], self.backs[k])
        yield from reversed(out)
        yield (self.conv_id, -1, None, None, None, None, {**counts, "audit": walk.audit(), "repaired_sha256": told[0].hexdigest()}, None)


class Walk:
    """Follows back-pointers from a conversation's end to its beginning."""

    def __init__(self, conv_id, n: int, state: int, inserts: int):
        self.conv_id, self.n, self.state, self.inserts = conv_id, n, state, inserts
        self.letters: list[str] = []

    def _inserts(self, place: int, state: int, n: int) -> Iterator[tuple]:
        roles = _inserted(state, n)[1]
        for k in range(n - 1, -1, -1):
            self.letters.append(INSERTED)
            yield (self.conv_id, place + k, INSERTED, roles[k], "", None, None, None)

    def closing(self) -> Iterator[tuple]:
        yield from self._inserts(4 * self.n, self.state, self.inserts)

    def back(self, place: int, role: str, text: str, back: bytes) -> Iterator[tuple]:
        packed = back[self.state]
        before, n, edit = packed & 3, packed >> 2 & 3, EDITS[packed >> 4]
        self.letters.append(edit)
        if edit == "R":
            role = NEXT[_inserted(before, n)[0]][0]
        yield (self.conv_id, place, edit, role, text, None, None, None)
        yield from self._inserts(place - 2, before, n)
        self.state = before

    def audit(self) -> str:
        return "".join(reversed(self.letters))


def _batches(rows: Iterator[tuple], id_type: pa.DataType, most: int = 5000, most_chars: int = 16_000_000) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded size."""
    types = [id_type, *_ARROW.values()]
    part: list[tuple] = []
    chars = 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*part), types)], ["conv_id", *_ARROW])

    for row in rows:
        part.append(row)
        chars += len(row[4] or "")
        if len(part) == most or chars > most_chars:
            yield batch()
            part, chars = [], 0
    if part:
        yield batch()


class Repair:
    """``turns``: (conv_id, place, edit, role, text), every row after repair by ``place``, and the deleted ones (edit D) as they
    were.  ``summary``: one row per conversation, see ``SUMMARY``."""

    def __init__(self, found: DataFrame):
        self.turns = found.filter("edit IS NOT NULL").select("conv_id", "place", "edit", "role", "text")
        self.summary = found.filter("summary IS NOT NULL").select("conv_id", "summary.*")


def _faults(rows: DataFrame) -> DataFrame:
    """First faults.  Equal texts of a role are adjacent in a sort within the conversation's partition: no shuffle of their own."""
    shown = F.rtrim(F.translate("text", SPACES, " " * len(SPACES)))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    return rows.withColumn("fault", F.when(shown == "", "blank").when(seen, "duplicate").when(~F.substring(shown, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""))


def repair(df: DataFrame, there: Column | None = None, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           held: int = HELD, held_chars: int = HELD_CHARS) -> Repair:
    """Repairs all conversations.  Rows for which ``there`` is false are not there, but their conversation is reported."""
    whole = F.coalesce(there, F.lit(False)) if there is not None else F.lit(True)
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"), whole.alias("there"))
    kind = rows.schema["conv_id"].dataType.simpleString()
    # rows that are not there are in groups of their own: a null text tells them from all others
    rows = rows.withColumn("text", F.when(F.col("there"), F.col("text"))).repartition("conv_id")
    rows = _faults(rows).sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", F.col("fault") == "duplicate")

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(first: pa.RecordBatch) -> Iterator[tuple]:
            now: Conversation | None = None
            for batch in chain([first], batches):
                for key, turn, role, text, fault in zip(*(c.to_pylist() for c in batch.columns)):
                    if now is None or now.conv_id != key:
                        if now is not None:
                            yield from now.end()
                        now = Conversation(key, held, held_chars)
                    if text is not None:
                        yield from now.add(turn, role, text, fault)
            if now is not None:
                yield from now.end()

        for first in batches:
            yield from _batches(out(first), first.schema.field("conv_id").type)

    schema = STREAM.format(id=kind)
    passed = stored(rows.select("conv_id", "turn", "role", "text", "fault").mapInArrow(forward, schema))
    long = passed.filter("back IS NOT NULL OR ends IS NOT NULL")
    long = long.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("place").desc())

    def backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(first: pa.RecordBatch) -> Iterator[tuple]:
            walk, counts = None, None
            for batch in chain([first], batches):
                for key, place, role, text, back, summary, ends in zip(*(c.to_pylist() for c in batch.columns)):
                    if back is None:
                        if walk is not None:
                            yield (walk.conv_id, -1, None, None, None, None, {**counts, "audit": walk.audit()}, None)
                        walk, counts = Walk(key, (place - 4) // 4, *ends), summary
                        yield from walk.closing()
                    else:
                        yield from walk.back(place, role, text, back)
            if walk is not None:
                yield (walk.conv_id, -1, None, None, None, None, {**counts, "audit": walk.audit()}, None)

        for first in batches:
            yield from _batches(out(first), first.schema.field("conv_id").type)

    long = long.select("conv_id", "place", "role", "text", "back", "summary", "ends")
    done = passed.filter("back IS NULL AND ends IS NULL")
    if passed.filter("ends IS NOT NULL").isEmpty():
        return Repair(done)
    return Repair(done.unionByName(stored(long.mapInArrow(backward, schema))))
