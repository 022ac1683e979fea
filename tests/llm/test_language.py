import math

import public_tokenizers
import pytest

from tidegate.llm import language
from tidegate.llm.language import Lattice, log_word

PIECES = language.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))


def all_segmentations(word, p, pieces):
    s = "▁" + word
    number = {x: k for k, x in enumerate(pieces)}

    def total(i):
        if i == len(s):
            return 1.0
        out = 0.0
        for j in range(i + 1, len(s) + 1):
            k = number.get(s[i:j], len(pieces) if j == i + 1 else None)
            if k is not None:
                out += p[k] * total(j)
        return out

    return total(0)


def test_forward_sums_all_segmentations():
    pieces = ["▁", "▁a", "a", "b", "ab", "abc", "▁ab"]
    p = [0.1, 0.05, 0.2, 0.3, 0.1, 0.05, 0.1, 0.1]
    lattice = Lattice(pieces)
    for word in ("a", "ab", "abab", "abcé", "aabbab"):
        assert log_word(*lattice.edges(word), p) == pytest.approx(math.log(all_segmentations(word, p, pieces)))
    size, edges = lattice.edges("ab" * 200)  # in logarithms
    short = log_word(*lattice.edges("ab" * 10), p)
    assert -1e9 < log_word(size, edges, p) < short


def test_expected_counts_add_up():
    from collections import defaultdict

    pieces = ["▁", "a", "b", "ab"]
    counts = defaultdict(float)
    size, edges = Lattice(pieces).edges("abab")
    language.expect(size, edges, [0.25] * 5, 3.0, counts)
    assert sum(n * len(pieces[k]) for k, n in counts.items()) == pytest.approx(3.0 * 5)


def test_learn_and_predict(docs, spark):
    en, de = "the house and the garden with a tree", "das haus und der garten mit einem baum"
    rows = [(k, (en if k % 2 else de) + f" {k}", "en" if k % 2 else "de") for k in range(40)]
    rows += [(50, None, "en"), (51, en, None)]
    model = language.fit(docs(rows, ", lang string"), PIECES)
    ask = [(1, None), (2, ""), (3, "12 ²!"), (4, "the tree in the garden"), (4, "der baum in dem garten"), (None, "UND " * 20000)]
    got = {(r["doc_id"], r["text"]): (r["lang_pred"], r["score"]) for r in model.predict(docs(ask)).collect()}
    assert [got[x][0] for x in ask] == ["und", "und", "und", "en", "de", "de"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in language.fit(docs([], ", lang string"), PIECES).predict(docs(ask)).collect()} == {"und"}
    assert model.predict(docs([])).collect() == []


def test_held_out_accuracy(spark):
    from tidegate.llm.queries import op7_language_id

    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = op7_language_id(spark, "/root/testdata/sf0.01").filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)


def test_long_words_are_learned_from(docs):
    from collections import defaultdict

    pieces = ["▁", "a", "b", "ab", "ba", "c"]
    lattice = language.Lattice(pieces)
    p = [0.1, 0.3, 0.2, 0.2, 0.1, 0.05, 0.05]
    word = "abbaab" * 6  # both ways of summing agree
    short, long = defaultdict(float), defaultdict(float)
    size, edges = lattice.edges(word)
    language.expect(size, edges, p, 2.0, short)
    kept, language.SHORT_WORD = language.SHORT_WORD, 3
    try:
        language.expect(size, edges, p, 2.0, long)
    finally:
        language.SHORT_WORD = kept
    assert size <= kept and all(abs(short[k] - long[k]) < 1e-9 for k in {*short, *long})
    rows = [(k, ("ab" if k % 2 else "c") * 2000, "x" if k % 2 else "y") for k in range(8)]
    model = language.fit(docs(rows, ", lang string"), pieces)
    got = {r["doc_id"]: r["lang_pred"] for r in model.predict(docs(rows, ", lang string")).collect()}
    assert got == {k: "x" if k % 2 else "y" for k in range(8)}
