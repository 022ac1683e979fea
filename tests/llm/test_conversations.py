import hashlib
import heapq
import random
import re

import pytest
from pyspark.sql import functions as F

from tidegate.llm.conversations import repair
from tidegate.llm.queries import damaged

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Cheapest and then ASCII-least edits by search over all edit strings; rows in their order."""
    seen, faults = set(), []
    for role, text in rows:
        shown = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, edits, k, got, out = heapq.heappop(heap)
        if k == len(rows) and re.fullmatch("(s?(ua)+)?", got):
            break
        state = (k, got[-2:], len(got) > 0)
        if (state, edits) in done or not re.fullmatch("s?(ua)*u?", got):
            continue
        done.add((state, edits))
        for r in ("user", "assistant"):
            if edits[-2:] != "II":
                heapq.heappush(heap, (cost + 3, edits + "I", k, got + r[0], (*out, f"{r}:")))
        if k < len(rows):
            role, text = rows[k]
            heapq.heappush(heap, (cost + 4, edits + "D", k + 1, got, out))
            if faults[k] not in ("blank", "duplicate"):
                more = 3 if faults[k] == "truncated" else 0
                heapq.heappush(heap, (cost + more, edits + "K", k + 1, got + (role[:1] or "-"), (*out, f"{role}:{text}")))
                for r in ("user", "assistant"):
                    heapq.heappush(heap, (cost + more + 3, edits + "R", k + 1, got + r[0], (*out, f"{r}:{text}")))
    pairs = [a[:1] + b[:1] for (a, _), (b, _) in zip(rows, rows[1:])]
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return [*counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, edits, hashlib.sha256("\n".join(out).encode()).hexdigest()]


def some_conversations(n, longest):
    rng = random.Random(n)
    roles = ["user", "assistant", "system", "tool", "", None]
    texts = ["a.", "b", "c!", "", " \n", None, "d? ", "é."]
    for conv in range(n):
        for turn in range(rng.randint(1, longest)):
            yield conv, turn, rng.choices(roles, [6, 6, 2, 1, 1, 1])[0], rng.choice(texts) if rng.random() < 0.6 else f"t{turn}."


@pytest.mark.parametrize("held", [10_000, 1, 3])
def test_against_search(spark, held):
    rows = list(some_conversations(150, 7))
    found = repair(spark.createDataFrame(rows, SCHEMA), held=held)
    of = {r["conv_id"]: r for r in found.summary.collect()}
    turns = found.turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "edit", "role", "text"))).alias("t"))
    turns = {r["conv_id"]: r["t"] for r in turns.collect()}
    assert len(of) == 150
    for conv in range(150):
        own = [(" " if r is None else r, " " if t is None else t) for c, _, r, t in rows if c == conv]
        r = of[conv]
        got = [r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]]
        assert got == brute(own), own
        assert "".join(t["edit"] for t in turns[conv]) == r["audit"]
        text = "\n".join(f"{t['role']}:{t['text']}" for t in turns[conv] if t["edit"] != "D")
        assert hashlib.sha256(text.encode()).hexdigest() == r["repaired_sha256"]


def test_long_conversation_alike(spark):
    rows = [(c, t // 2, r, x) for c, t, r, x in some_conversations(3, 3000)] + [(7, None, "user", "x" * 1_500_000), (None, 3, None, None), (None, None, "user", "q."), (None, 9, "assistant", "r.")]
    df = spark.createDataFrame(rows, SCHEMA)
    held, left = repair(df, held=100_000), repair(df, held=50, held_chars=1000)
    key = lambda r: repr(tuple(r))
    assert sorted(held.summary.collect(), key=key) == sorted(left.summary.collect(), key=key)
    assert sorted(held.turns.collect(), key=key) == sorted(left.turns.collect(), key=key)
    r = held.summary.filter("conv_id IS NULL").first()
    assert (r["gaps"], r["blank"], r["audit"], r["cost"]) == (5, 1, "KDK", 4)
    assert held.summary.filter("conv_id = 7").first()["audit"] == "D"


def test_order_gaps_and_absent_rows(spark):
    rows = [(1, 5, "user", "b.", True), (1, None, "system", "s.", True), (1, 9, "assistant", "c.", True), (1, 9, "assistant", "c.", True), (2, 0, "user", "x.", False), (3, None, "user", "y.", None)]
    df = spark.createDataFrame(rows, SCHEMA + ", there boolean").withColumn("Edit", F.lit(1)).withColumn("summary", F.lit("s"))
    of = {r["conv_id"]: tuple(r)[1:] for r in repair(df, F.col("there")).summary.collect()}
    assert of[1][:7] == (3, 0, 1, 0, 1, 4, "KKKD")
    empty = hashlib.sha256(b"").hexdigest()
    assert of[2] == of[3] == (0, 0, 0, 0, 0, 0, "", empty)
    nothing = repair(spark.createDataFrame([], SCHEMA))
    assert nothing.summary.collect() == nothing.turns.collect() == []


def test_large_ids_and_damage(spark):
    big = (1 << 62) + 1
    df = spark.createDataFrame([(big, 0, "user", "Hi."), (None, None, None, None)], SCHEMA)
    assert {r["conv_id"] for r in repair(df).summary.collect()} == {big, None}
    import zlib

    rows = [(c, t, "assistant", "a. b?") for c in range(30) for t in (None, 1, 2, 3)]
    got = damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else "a b" if k == 2 else text, k != 0)
        want += [row] * (2 if k == 3 else 1)
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
