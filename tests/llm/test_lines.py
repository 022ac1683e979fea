import random

import pytest

from tidegate.llm import lines


def plain(rows, least):
    """Kept texts by a table of all minimal runs seen so far."""
    seen, out = set(), {}
    for key in sorted(rows, key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k)):
        own = (rows[key][1] or "").split("\n")
        gone = set()
        for i in range(len(own)):
            n, j = 0, i
            while j < len(own) and n < least:
                n += len(own[j].encode().split())
                j += 1
            if n >= least:
                run = tuple(own[i:j])
                if run in seen:
                    gone |= set(range(i, j))
                seen.add(run)
        out[key] = ("\n".join(x for k, x in enumerate(own) if k not in gone), len(gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_all_runs(docs, seed):
    r = random.Random(seed)
    stock = [" ".join(r.choice("abcdef") for _ in range(r.choice([0, 1, 2, 5, 12]))) for _ in range(14)]
    rows = {}
    for k in range(50):
        own = [r.choice(stock) if r.random() < 0.8 else f"own line {k} {r.random()}" for _ in range(r.randint(0, 25))]
        rows[k] = (k, "\n".join(own))
    rows[50], rows[51], rows[52] = (60, rows[3][1]), (None, rows[4][1]), (61, None)
    df = docs([(*rows[k], k, "x") for k in rows], ", key int, kept_text string").coalesce(1)
    got = {x["key"]: x for x in lines.dedup_lines(df, min_words=10).collect()}
    want = plain(rows, 10)
    assert {k: (x["kept_text"] or "", x["n_deleted"]) for k, x in got.items()} == want
    assert sum(n for _, n in want.values()) > 30
    assert got[52]["kept_text"] is None and got[52]["n_lines"] == 1


def test_repeated_rows_and_empty(docs):
    text = "one two three\nfour five six"
    got = lines.dedup_lines(docs([(1, text), (1, text), (2, "x\n" + text + "\ny"), (3, "one two three")]).coalesce(1), min_words=5).collect()
    assert sorted((r["doc_id"], r["kept_text"]) for r in got) == [(1, ""), (1, text), (2, "x\ny"), (3, "one two three")]
    assert lines.dedup_lines(docs([])).collect() == []
