import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import suffixes


def plain(rows, length=100):
    """{row: (n_removed, spans, kept)} by a table of all strings seen so far."""
    seen, out = set(), {}
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    for k in order:
        raw = (rows[k][1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out[k] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df):
    rows = suffixes.dedup_bytes(df).select("doc_id", "n_bytes", "n_removed", F.size("removed_spans").alias("n"), F.sha2("kept", 256).alias("s")).collect()
    return {r["doc_id"]: tuple(r)[1:] for r in rows}


def texts(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh é") for _ in range(r.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(r.randint(15, 60)) for _ in range(6)]
    rows = []
    for k in range(60):
        parts = [r.choice(passage) if r.random() < 0.4 else text(r.randint(1, 60)) for _ in range(r.randint(0, 6))]
        rows.append((k, " ".join(parts)))
    rows += [(60 + k, rows[k][1]) for k in range(10)]
    for k in range(20):  # near copies
        t = list(rows[20][1] or text(100))
        t[r.randrange(len(t))] = "#"
        rows.append((70 + k, "".join(t)))
    rows += [(90, None), (91, ""), (92, "x" * 99), (93, "a" * 700), (94, "a" * 400 + "b" + "a" * 150), (95, "ab" * 300), (96, "x" * 100), (97, "x" * 100)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_strings(docs, seed, monkeypatch):
    rows = texts(seed)
    expected = {rows[k][0]: v for k, v in plain(rows).items()}
    assert found(docs(rows).repartition(5)) == expected
    if seed == 1:  # anchors with many stretches dealt to several tasks, texts hashed in pieces
        monkeypatch.setattr(suffixes, "LARGE", 3)
        assert found(docs(rows).repartition(3)) == expected


def test_large_anchors_send_each_suffix_once(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "LARGE", 3)
    r = random.Random(6)
    some = lambda n: "".join(r.choices("abcdefgh ", k=n))
    common = some(90)  # shorter than the length: all surroundings differ, and some repeat as a whole
    rows = [(k, some(90) + common + some(90)) for k in range(60)]
    rows += [(60 + k, rows[k][1][20:-20] + some(40)) for k in range(10)] + [(None, rows[3][1]), (70, rows[4][1]), (70, rows[4][1])]
    df = docs(rows).repartition(3)
    source = df.select(F.col("doc_id").alias("id"), F.lit(0).cast("long").alias("h"), "text")
    different = suffixes._sort_stretches(suffixes._deal(source, 100)).filter("NOT again").drop("again", "c")
    n = different.distinct().agg(F.sum(F.col("hi") - F.col("lo") + 1)).first()[0]
    single = suffixes._single_suffixes(suffixes._with_bytes(source.distinct(), different.distinct(), 100), 100)
    assert single.count() == n and different.groupBy("v").count().filter("count > 30").count() > 0
    once = {k: t for k, t in rows}
    order = sorted(once.items(), key=lambda x: (x[0] is not None, x[0] or 0))
    wanted = plain([(k, t) for k, (_, t) in enumerate(order)])
    assert found(df) == {i: wanted[k] for k, (i, _) in enumerate(order)}


def test_pieces_of_long_texts_give_the_same_suffixes():
    b = np.frombuffer(texts(3)[0][1].encode() * 3 + b"q" * 300, np.uint8)
    v, x, lo, hi = suffixes.stretches(b, 100)
    assert lo[0] == 0 and hi[-1] == len(b) - 100 and (lo[1:] == hi[:-1] + 1).all()
    h = suffixes.gram_hashes(b)
    for a, i, j in zip(x.tolist(), lo.tolist(), hi.tolist()):
        for p in (i, j):
            assert p + h[p : p + 69].argmin() == a


def test_repeated_rows_nulls_and_extra_columns(docs):
    text = "".join(random.Random(5).choices("abcdefghij", k=300))
    df = docs([(1, text, "a"), (1, text, "b"), (None, text, "c"), (2, None, "d")], ", kept string")
    rows = suffixes.dedup_bytes(df).collect()
    removed = {(r["doc_id"], r["n_removed"]) for r in rows}
    assert len(rows) == 4 and removed == {(None, 0), (1, 300), (2, 0)}
    assert {bytes(r["kept"]) for r in rows if r["doc_id"] == 1} == {b""}


def test_empty_table(docs):
    assert suffixes.dedup_bytes(docs([])).collect() == []


def test_blind_trie():
    r = random.Random(4)
    strings = [bytes(r.choice(b"ab") for _ in range(12)) for _ in range(3000)]
    first = {}
    assert suffixes.blind_trie_repeats(strings) == [k for k, s in enumerate(strings) if first.setdefault(s, k) != k]
