import random
import re

import pytest

from tidegate.llm.decontaminate import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    out = []
    for _, text in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            v = words(t)
            n = min(10, len(v))
            windows = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in windows:
                    hit |= set(range(k, k + n))
                    if item is not None:
                        found.add(str(item))
        out.append((len(w), len(hit), tuple(sorted(found))))
    return sorted(out)


def run(spark, docs, items):
    d = spark.createDataFrame([(*x, "own") for x in docs], "doc_id long, text string, items string").repartition(3)
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate(d, b).collect()
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r["hit_spans"]) == r["n_hit"]
        assert all(x["end"] < y["start"] for x, y in zip(r["hit_spans"], r["hit_spans"][1:]))
    return sorted((r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_windows(spark, seed):
    r = random.Random(seed)
    vocabulary = ["The", "of", "an", "éa", "Été", "x1", "漢字", "go", "we", "no-one"] if seed == 1 else [f"w{k}" for k in range(400)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(k, text(r.randint(10, 40))) for k in range(12)]
    items += [(100 + k, text(n)) for k, n in enumerate((1, 3, 5, 9) if seed == 2 else (6,))] + [(200, None), (201, "--"), (12, items[0][1]), (None, text(12))]
    docs = []
    for k in range(60):
        parts = [r.choice(items)[1] or "" if r.random() < 0.3 else text(r.randint(0, 50)) for _ in range(r.randint(0, 4))]
        docs.append((k, ", ".join(parts).upper() if r.random() < 0.2 else "\n".join(parts)))
    docs += [(1, docs[2][1]), (2, docs[2][1]), (None, docs[3][1]), (70, None), (71, ""), (72, " ".join([items[0][1]] * 300))]
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == []
    assert run(spark, [(1, "a b c")], []) == [(3, 0, ())]
