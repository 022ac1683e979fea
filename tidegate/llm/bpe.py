"""BPE encoding and decoding by dynamic programming over prefixes.

A byte string has one BPE encoding, and so has each of its prefixes.  The last token of a
prefix's encoding is the one token that ends there and is *compatible* with the last token of
the prefix before it: merging the two tokens' bytes from scratch would give the same two
tokens.  An automaton over the vocabulary finds all tokens that end at each position, the pair
test picks the one that fits, and following the stored tokens backwards gives the ids.  Time is
linear in the text, however long a word is; no merge loop runs.

Null texts encode as empty ones.  Repeated rows and ids are of no account: each row is encoded
by itself.  A column that bears the name of an output column is replaced.
"""

from __future__ import annotations

import json
import re
import struct
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from tidegate.llm.common import free, kept, parts, renewed, small_batches, text_or_empty

#: Fixed pattern of byte-level vocabularies: texts are cut into these pieces before merging.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A blank inside a run of white space, the one place where cutting before a blank could split a piece.
INNER_BLANK = r"\s (?=\s|\Z)"
#: Most words and token pairs that a worker remembers (memory only; results do not hang on it).
REMEMBERED_WORDS = 150_000
REMEMBERED_PAIRS = 200_000
#: Longer words are not remembered.
LONG_WORD = 64


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary file: printable bytes stand for
    themselves, the others take the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens, merges and the prefix encoder of one byte-level BPE file."""

    def __init__(self, file_text: str):
        data = json.loads(file_text)
        letters = byte_letters()
        vocab = data["model"]["vocab"]
        self.specials = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.bytes_of: list[bytes] = [b""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.specials.items():
            self.bytes_of[i] = token.encode()
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], tuple[int, int]] = {}
        for k, merge in enumerate(data["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            self.merged[left, right] = (k, whole)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (left, right), k
        self.automaton = ahocorasick.Automaton()
        reached: set[int] = set()
        for i in sorted(vocab.values(), key=lambda i: self.rank.get(i, -1)):
            if i in self.parts:
                left, right = self.parts[i]
                if not (left in reached and right in reached and self.fits(left, right, self.rank[i])):
                    continue  # merging its bytes from scratch never gives this token
            reached.add(i)
            raw = self.bytes_of[i]
            self.automaton.add_word(raw.decode("latin-1"), (i, len(raw)))
        self.automaton.make_automaton()
        self.find_pieces = regex.compile(PIECES).findall
        self.split_specials = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")").split if self.specials else None
        self.inner_blank = re.compile(INNER_BLANK).search
        self.words: dict[str, bytes] = {}
        self.pairs: dict[int, dict[int, bool]] = defaultdict(dict)
        self.n_pairs = 0

    def fits(self, left: int, right: int, below: int | None = None) -> bool:
        """Whether merging the bytes of two tokens from scratch keeps them as two tokens
        (``below``: looking only at merges that come before this rank).

        Merges are undone from the latest on, on whichever side was merged last; as long as two
        parts meet at the border, a merge of theirs that comes earlier than the ones
        undone so far would have joined them across it.
        """
        limit = len(self.merged) if below is None else below
        while True:
            across = self.merged.get((left, right))
            if across is not None and across[0] < limit:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b or a == b and left == right and b < 0:
                limit = a
                left = self.parts[left][1]
            else:
                # equal merges run from left to right, so the left one's own rank still counts
                limit = b + 1
                right = self.parts[right][0]

    def piece_ids(self, raw: bytes) -> list[int]:
        """Ids of one piece: the last token of every prefix, then back along them."""
        last = [-1] * (len(raw) + 1)
        pairs = self.pairs
        for end, (token, length) in self.automaton.iter(raw.decode("latin-1")):
            end += 1
            if last[end] >= 0:
                continue
            if end > length:
                before = last[end - length]
                fits = pairs[before].get(token)
                if fits is None:
                    fits = self._fits_noted(before, token)
                if not fits:
                    continue
            last[end] = token
        ids, end = [], len(raw)
        while end:
            ids.append(last[end])
            end -= len(self.bytes_of[last[end]])
        return ids[::-1]

    def _fits_noted(self, left: int, right: int) -> bool:
        if self.n_pairs >= REMEMBERED_PAIRS:
            self.pairs.clear()
            self.n_pairs = 0
        self.n_pairs += 1
        self.pairs[left][right] = fits = self.fits(left, right)
        return fits

    def _packed(self, text: str) -> bytes:
        ids: list[int] = []
        for piece in self.find_pieces(text):
            ids += self.piece_ids(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _ordinary(self, text: str) -> bytes:
        """A blank before a word always starts a piece, so words can be looked up one by one."""
        if self.inner_blank(text):
            return self._packed(text)
        known, out = self.words, []
        first, *words = text.split(" ")
        for word in words:
            packed = known.get(word)
            if packed is None:
                packed = self._packed(" " + word)
                if len(word) <= LONG_WORD and len(known) < REMEMBERED_WORDS:
                    known[word] = packed
            out.append(packed)
        return self._packed(first) + b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, one after another."""
        if self.split_specials is None:
            return self._ordinary(text)
        return b"".join(
            self.specials[part].to_bytes(4, "little") if k % 2 else self._ordinary(part) for k, part in enumerate(self.split_specials(text)) if part
        )

    def decode(self, packed: bytes) -> str:
        """Text of packed ids; ids outside the vocabulary are left out, broken UTF-8 is replaced."""
        known, top = self.bytes_of, len(self.bytes_of)
        return b"".join([known[i] for i in np.frombuffer(packed, "<u4").tolist() if i < top]).decode("utf-8", "replace")


def _vocabulary(shared) -> Vocabulary:
    """One per worker process and file; the file's text is shipped once, its size does not grow with the data."""
    return kept(("bpe", shared.value), lambda: Vocabulary(shared.value))


def _shared_file(df: DataFrame, path: str):
    small_batches(df.sparkSession)
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Adds ``ids`` (binary): the packed ids of ``text`` under the tokenizer file at ``path``.

    Special tokens that stand in the text get their ids; none are added.  No shuffle.
    """
    shared = _shared_file(df, path)

    @F.pandas_udf(BinaryType())
    def packed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(shared)
        for texts in batches:
            for part in parts(texts):
                yield pd.Series([vocabulary.encode(t) for t in part], dtype=object)

    return df.withColumn(ids, packed(text_or_empty(text)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Adds ``text``: the text of packed ids, special tokens included.  Null ids give an empty text."""
    shared = _shared_file(df, path)

    @F.pandas_udf(StringType())
    def unpacked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(shared)
        for packs in batches:
            yield pd.Series([vocabulary.decode(p) for p in packs], dtype=object)

    return df.withColumn(text, unpacked(F.coalesce(F.col(ids), F.lit(b""))))


def round_trip(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` of its ids in one pass, so that a task needs one Python worker and not two."""
    shared = _shared_file(df, path)

    @F.pandas_udf("ids binary, decoded string")
    def both(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(shared)
        for texts in batches:
            for part in parts(texts):
                packs = [vocabulary.encode(t) for t in part]
                yield pd.DataFrame({"ids": packs, "decoded": [vocabulary.decode(p) for p in packs]})
        free()

    found = df.select(F.struct("*").alias("row"), both(text_or_empty(text)).alias("found"))
    return renewed(found, df.columns, {ids: F.col("found.ids"), decoded: F.col("found.decoded")})
