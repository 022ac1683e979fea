import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tidegate.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
TRUE = Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def same(vocabulary, text):
    ids = TRUE.encode(text, add_special_tokens=False).ids
    packed = vocabulary.encode(text)
    assert np.frombuffer(packed, "<u4").tolist() == ids
    assert vocabulary.decode(packed) == TRUE.decode(ids, skip_special_tokens=False)


@given(st.text(max_size=80))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    with open(PATH, encoding="utf-8") as f:
        v = test_any_text.__dict__.setdefault("v", None) or bpe.Vocabulary(f.read())
    test_any_text.__dict__["v"] = v
    same(v, text)


def test_merges_and_blanks(vocabulary):
    r = random.Random(1)
    tokens = [TRUE.decode([i]) for i in range(50000)]
    for _ in range(3000):
        same(vocabulary, "".join(r.choice(tokens) for _ in range(r.randint(1, 8))))
        same(vocabulary, "".join(r.choice(["ab", "  ", "\n", " \t", "é", "漢", "'s", "12", "=-", "<|endoftext|>", "the", " "]) for _ in range(r.randint(0, 30))))


def test_long_words_and_special_tokens(vocabulary):
    for text in ["a" * 5000, "the" * 3000, " " * 4000, "<|endoftext|>" * 3 + "a<|endoftext", "x" + "\n" * 3000]:
        same(vocabulary, text)


def test_as_columns(docs):
    rows = [(1, None), (2, ""), (3, "Hello  world\n"), (3, "Hello  world\n"), (None, "é<|endoftext|>")]
    df = docs([(*r, "x") for r in rows], ", ids string")
    out = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert [(r["doc_id"], r["decoded"]) for r in out] == [(k, t or "") for k, t in rows]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in out] == [TRUE.encode(t or "", add_special_tokens=False).ids for _, t in rows]
    both = bpe.round_trip(df, PATH).collect()
    assert [(r["doc_id"], r["ids"], r["decoded"]) for r in both] == [(r["doc_id"], r["ids"], r["decoded"]) for r in out]
    assert bpe.encode(docs([]), PATH).collect() == bpe.round_trip(docs([]), PATH).collect() == []


def test_unknown_ids_and_broken_text(vocabulary):
    assert vocabulary.decode(np.array([70000, 64], "<u4").tobytes()) == TRUE.decode([64])
    half = TRUE.encode("漢").ids[:1]
    assert vocabulary.decode(np.array(half, "<u4").tobytes()) == TRUE.decode(half)
