import random

import numpy as np
import pytest

from tidegate.llm import jaccard
from tidegate.llm.components import components


def sets(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def plain(rows):
    s = [sets(t) for _, t in rows]
    comp = list(range(len(rows)))

    def root(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(s[i] & s[j])
            if both and 100 * both >= 80 * (len(s[i]) + len(s[j]) - both):
                comp[root(i)] = root(j)
    ids = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            ids[root(k)] = min(ids.get(root(k), i), i)
    return sorted(((i, len(s[k]), ids.get(root(k)) if s[k] else i) for k, (i, _) in enumerate(rows)), key=repr)


def found(df):
    return sorted((tuple(r) for r in jaccard.jaccard_components(df).collect()), key=repr)


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(3))
    passage = [word() for _ in range(40)]
    rows, k = [], 0
    for _ in range(12):
        base = [word() for _ in range(r.choice([3, 6, 30, 60, 200, 700]))] + (passage if r.random() < 0.5 else [])
        for _ in range(r.choice([1, 2, 6, 12])):
            t = list(base)
            for _ in range(r.choice([0, 1, 2, 4])):
                t[r.randrange(len(t))] = word()
            if r.random() < 0.2:
                t = t[: max(1, int(len(t) * 0.85))]
            rows.append((k, (" \n" if r.random() < 0.5 else " ").join(t)))
            k += 1
    chain = [word() for _ in range(100)]  # each links to the next only
    for step in range(12):
        rows.append((k, " ".join(chain)))
        k += 1
        chain = chain[3:] + [word() for _ in range(3)]
    rows += [(k, None), (k + 1, ""), (k + 2, ""), (k + 3, " \t"), (k + 4, rows[0][1].upper()), (3, rows[5][1]), (3, rows[5][1]), (None, rows[7][1]), (None, "only here x y z")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs, seed, monkeypatch):
    rows = corpus(seed)
    df = docs([(*x, 0) for x in rows], ", component_id int").repartition(4)
    assert found(df) == plain(rows)


def test_large_regions_are_dealt_in_parts(docs, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 4)
    monkeypatch.setattr(jaccard, "TURNS", 1)
    rows = corpus(3)
    assert found(docs([(*x, 0) for x in rows], ", component_id int").repartition(4)) == plain(rows)


def test_parts_hold_every_pair_and_no_whole_region(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PART", 50)
    # a component of 900 and thirty outsiders, some of them followers
    members = [(7, k, 100 + k % 20, 0) for k in range(900)] + [(7, 900 + k, (100 + k) * (-1 if k % 3 else 1), 900 + k) for k in range(30)]
    parts = {}
    for r in jaccard._parts(spark.createDataFrame(members, "token long, key long, n int, comp long"), 80).collect():
        parts.setdefault(tuple(r)[:4], set()).add(r["key"])
    assert max(map(len, parts.values())) < 200 and sum(map(len, parts.values())) < 5 * 930
    for _, a, n, c in members[900:]:
        for _, b, o, d in members:
            if c != d and 100 * min(abs(n), abs(o)) >= 80 * max(abs(n), abs(o)):
                assert any({a, b} <= p for p in parts.values())


def test_pages_of_one_passage_do_not_meet_through_it(docs):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(174))
    rows = [(k, passage + " " + " ".join(word() for _ in range(30))) for k in range(40)]  # 85 % shared, Jaccard 0.74
    often = np.sort(jaccard.shingles(passage))
    assert jaccard._regions(jaccard._prefixes(docs(rows), 5, 80, often)).count() == 0
    assert found(docs(rows)) == plain(rows)


def test_empty(docs):
    assert found(docs([])) == []
    assert found(docs([(1, None), (2, "")])) == [(1, 0, 1), (2, 0, 2)]


def test_cells_lose_no_pair(monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_CELL", 8)
    r = np.random.default_rng(3)
    members, comps = [], []
    for c in range(40):
        base = r.integers(0, 1 << 63, 100, np.uint64)
        for _ in range(8):
            s = base.copy()
            s[r.integers(0, 100, r.integers(0, 12))] = r.integers(0, 1 << 63, 1, np.uint64)
            members.append(np.unique(s))
            comps.append(len(comps))
    raw = np.stack([np.frombuffer(jaccard.sketch(s), np.uint64) for s in members])
    sizes = np.array([len(s) for s in members])
    got = {(min(p), max(p)) for p in jaccard.voronoi_pairs(raw, sizes, np.array(comps), 80)}
    want = {(j, i) for i in range(len(members)) for j in range(i) if jaccard.linked(members[i], members[j], 80)}
    assert want and want <= got and len(got) < 3 * len(want)


def test_sketches_fold():
    s = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 3000, np.uint64))
    raw = np.frombuffer(jaccard.sketch(s), np.uint64)
    assert len(raw) * 64 == 4096
    ones = np.bincount((s & np.uint64(1023)).astype(np.int64), minlength=1024) & 1
    assert (np.unpackbits(jaccard.fold(raw, 16).view(np.uint8), bitorder="little") == ones).all()


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 100), (5, 5), (200, 300), (300, 250), (61, 30)]
    got = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long").repartition(3)).collect()}
    assert got == {**{k: 0 for k in range(62)}, 100: 100, 101: 100, 200: 200, 250: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
