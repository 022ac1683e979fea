"""Language identification by segmentation-marginalised unigrams.

A language is a probability for each piece of a fixed public vocabulary.  The probability of a
word is the sum over all ways to cut it into pieces, which a forward pass over its characters
adds up; a text's is the product over its words.  Piece probabilities are learned by expectation
maximisation: a forward and a backward pass give each piece's expected count in each word.

Learning reads at most about ``docs_per_language`` labelled documents of each language, picked by a
hash of their id; word counts and expected counts are Spark aggregations and only the model
(languages x vocabulary) comes to the driver.  Prediction reads every text in full and needs no
shuffle.

Texts that are null or have no letter get ``und`` and score 0.  Rows without text or language are
not learned from.  With nothing to learn from, every text is ``und``.  Ties go to the
language first in alphabetical order.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import free, kept, parts, renewed, small_batches, stored

DOCS_PER_LANGUAGE = 3000
ROUNDS = 3
UNKNOWN = "und"
#: Added to every expected count.
PRIOR = 0.05
#: Words a worker remembers (memory only).
REMEMBERED_WORDS = 120_000
#: Words up to this length are summed in plain floats, longer ones in logarithms.
SHORT_WORD = 40

_words = re.compile(r"[^\W\d_]+").findall


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case; empty if the text has no letter."""
    found = _words(text.lower())
    return found if any(c.isalpha() for w in found for c in w) else []


def read_pieces(path: str) -> list[str]:
    """The ordinary pieces of a sentencepiece file."""
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    return [p.id_to_piece(i) for i in range(p.get_piece_size()) if not (p.is_control(i) or p.is_byte(i) or p.is_unknown(i) or p.is_unused(i))]


class Lattice:
    """Finds the pieces of a word: (start, end, piece number).  Characters outside the vocabulary
    are pieces of one character that share one number."""

    def __init__(self, pieces: list[str]):
        self.number = {p: k for k, p in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=1)
        self.starts = {p[:2] for p in pieces if len(p) > 1}
        self.n = len(pieces) + 1

    def edges(self, word: str) -> tuple[int, list[tuple[int, int, int]]]:
        s, number, out = "▁" + word, self.number, []
        for i in range(len(s)):
            out.append((i, i + 1, number.get(s[i], self.n - 1)))
            if s[i : i + 2] in self.starts:
                for j in range(i + 2, min(len(s), i + self.longest) + 1):
                    k = number.get(s[i:j])
                    if k is not None:
                        out.append((i, j, k))
        return len(s), out


def _log_sum(a: float, b: float) -> float:
    top = max(a, b)
    return top + math.log(math.exp(a - top) + math.exp(b - top))


def log_word(size: int, edges: list[tuple[int, int, int]], p: list[float]) -> float:
    """Logarithm of a word's probability: the forward pass."""
    if size <= SHORT_WORD:
        total = [1.0] + [0.0] * size
        for i, j, k in edges:
            total[j] += total[i] * p[k]
        return math.log(total[size]) if total[size] > 0 else -1e4
    logs = [0.0] + [-math.inf] * size
    for i, j, k in edges:
        logs[j] = _log_sum(logs[j], logs[i] + math.log(p[k]))
    return logs[size]


def expect(size: int, edges: list[tuple[int, int, int]], p: list[float], n: float, counts: dict[int, float]) -> None:
    """Adds the expected counts of a word's pieces, times ``n``: forward and backward pass."""
    if size > SHORT_WORD:
        ahead, back = [0.0] + [-math.inf] * size, [-math.inf] * size + [0.0]
        logs = [math.log(p[k]) for _, _, k in edges]
        for (i, j, _), q in zip(edges, logs):
            ahead[j] = _log_sum(ahead[j], ahead[i] + q)
        for (i, j, _), q in zip(reversed(edges), reversed(logs)):
            back[i] = _log_sum(back[i], back[j] + q)
        for (i, j, k), q in zip(edges, logs):
            counts[k] += n * math.exp(ahead[i] + q + back[j] - ahead[size])
        return
    ahead, back = [1.0] + [0.0] * size, [0.0] * size + [1.0]
    for i, j, k in edges:
        ahead[j] += ahead[i] * p[k]
    if ahead[size] <= 0:
        return
    for i, j, k in reversed(edges):
        back[i] += back[j] * p[k]
    scale = n / ahead[size]
    for i, j, k in edges:
        counts[k] += scale * ahead[i] * p[k] * back[j]


class LanguageModel:
    def __init__(self, languages: list[str], pieces: list[str], p: np.ndarray):
        self.languages, self.pieces, self.p = languages, pieces, p

    def predict(self, df: DataFrame, text: str = "text", lang: str = "lang_pred", score: str = "score") -> DataFrame:
        """Adds the most probable language and its posterior probability (all languages alike beforehand)."""
        small_batches(df.sparkSession)
        shared = df.sparkSession.sparkContext.broadcast((self.languages, self.pieces, self.p))  # as large as the vocabulary

        @F.pandas_udf("lang string, score double")
        def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            languages, pieces, p = shared.value
            scorer = _scorer(languages, pieces, p)
            for texts in batches:
                for part in parts(texts):
                    yield pd.DataFrame(scorer.batch(part), columns=["lang", "score"])
            free()

        found = df.select(F.struct("*").alias("row"), predicted(F.col(text)).alias("found"))
        return renewed(found, df.columns, {lang: F.col("found.lang"), score: F.col("found.score")})


class PieceTable:
    """Finds pieces for many words of one length at once, by hash: two slots for each, checked by the full hash."""

    SLOTS = 22

    def __init__(self, pieces: list[str]):
        self.longest = max(map(len, pieces), default=1)
        self.unknown, self.none = len(pieces), len(pieces) + 1
        self.keys = np.zeros(len(pieces) + 2, np.uint64)
        for k, piece in enumerate(pieces):
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = self.longer(h, np.full(1, ord(c), np.uint64))
            self.keys[k] = h[0]
        for seed in range(1, 100):
            self.odd = [np.uint64(odd * (2 * seed + 1) % (1 << 64)) for odd in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)]
            self.slots = [np.full(1 << self.SLOTS, self.none, np.uint16 if self.none < 1 << 16 else np.uint32) for _ in range(2)]
            own = self.keys[: len(pieces)]
            first = self._slot(own, 0)
            _, winners = np.unique(first, return_index=True)
            rest = np.setdiff1d(np.arange(len(pieces)), winners)
            second = self._slot(own[rest], 1)
            if len(np.unique(second)) == len(second):
                self.slots[0][first[winners]] = winners
                self.slots[1][second] = rest
                return
        raise ValueError("the vocabulary has equal pieces")

    @staticmethod
    def longer(h: np.ndarray, code) -> np.ndarray:
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return h + (code + np.uint64(1)) * np.uint64(0x94D049BB133111EB)

    def _slot(self, h: np.ndarray, k: int) -> np.ndarray:
        return (h * self.odd[k]) >> np.uint64(64 - self.SLOTS)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the pieces with these hashes, ``none`` where there is none."""
        one = self.slots[0][self._slot(h, 0)]
        two = self.slots[1][self._slot(h, 1)]
        return np.where(self.keys[one] == h, one, np.where(self.keys[two] == h, two, self.none))


class Scorer:
    """Logarithms of word probabilities per language; the forward pass runs over all new words of one length at once."""

    def __init__(self, languages: list[str], pieces: list[str], p: np.ndarray):
        self.languages, self.lattice, self.lists, self.table = languages, Lattice(pieces), p.tolist(), PieceTable(pieces)
        self.p = np.concatenate([p, np.zeros((len(languages), 1))], axis=1).T.copy()  # the last one: no piece
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((0, len(languages)))

    def _forward(self, words: list[str]) -> np.ndarray:
        size = len(words[0]) + 1
        if size > SHORT_WORD:
            return np.array([[log_word(*self.lattice.edges(w), p) for p in self.lists] for w in words])
        codes = np.frombuffer("".join("▁" + w for w in words).encode("utf-32-le"), np.uint32).reshape(-1, size).T.astype(np.uint64)
        total = np.zeros((size + 1, len(words), len(self.languages)))
        total[0] = 1.0
        for i in range(size):
            h = np.zeros(len(words), np.uint64)
            for j in range(i, min(size, i + self.table.longest)):
                h = self.table.longer(h, codes[j])
                found = self.table.find(h)
                if j == i:
                    found = np.where(found == self.table.none, self.table.unknown, found)
                total[j + 1] += total[i] * self.p[found]
        return np.log(np.maximum(total[size], 1e-300))

    def _learn(self, words: set[str]) -> None:
        by_size: dict[int, list[str]] = defaultdict(list)
        for w in words:
            by_size[len(w)].append(w)
        parts = [self.logs]
        for own in by_size.values():
            for k in range(0, len(own), 5000):
                part = own[k : k + 5000]
                parts.append(self._forward(part))
                for w in part:
                    self.rows[w] = len(self.rows)
        self.logs = np.concatenate(parts)

    def batch(self, texts: list[str | None]) -> list[tuple[str, float]]:
        found = [words_of(t) if t is not None and self.languages else [] for t in texts]
        if len(self.rows) > REMEMBERED_WORDS:
            self.rows, self.logs = {}, self.logs[:0]
        new = {w for words in found for w in words if w not in self.rows}
        if new:
            self._learn(new)
        row, out = self.rows.__getitem__, []
        for words in found:
            if not words:
                out.append((UNKNOWN, 0.0))
                continue
            total = self.logs[list(map(row, words))].sum(axis=0)
            best = int(np.argmax(total))
            out.append((self.languages[best], float(1.0 / np.exp(total - total[best]).sum())))
        return out


def _scorer(languages: list[str], pieces: list[str], p: np.ndarray) -> Scorer:
    return kept(("language", xxhash.xxh3_64_intdigest(p.tobytes())), lambda: Scorer(languages, pieces, p))


def fit(docs: DataFrame, pieces: list[str], doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
        docs_per_language: int = DOCS_PER_LANGUAGE, rounds: int = ROUNDS) -> LanguageModel:
    """Learns a model from the rows that have a text and a language."""
    small_batches(docs.sparkSession)
    labelled = docs.select(F.col(doc_id).alias("id"), F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return LanguageModel([], pieces, np.zeros((0, len(pieces) + 1)))
    million = 1_000_000
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, math.ceil(million * min(1.0, docs_per_language / sizes[k])))])
    sample = labelled.filter(F.pmod(F.xxhash64(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(million)) < share[F.col("lang")])

    def count_words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found: dict[str, Counter] = defaultdict(Counter)
            for k, t in zip(rows["lang"], rows["text"]):
                found[k].update(words_of(t))
            yield pd.DataFrame([(k, w, n) for k, c in found.items() for w, n in c.items()], columns=["lang", "word", "n"])

    counted = sample.select("lang", "text").mapInPandas(count_words, "lang string, word string, n long")
    words = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    p = np.full((len(languages), len(pieces) + 1), 1.0 / (len(pieces) + 1))
    for _ in range(rounds):
        current = docs.sparkSession.sparkContext.broadcast(p)

        def expected(batches: Iterator[pd.DataFrame], current=current) -> Iterator[pd.DataFrame]:
            lattice, of = Lattice(shared.value), dict(zip(languages, current.value.tolist()))
            counts: dict[str, dict[int, float]] = {k: defaultdict(float) for k in languages}
            for rows in batches:
                for k, w, n in zip(rows["lang"], rows["word"], rows["n"]):
                    expect(*lattice.edges(w), of[k], n, counts[k])
            yield pd.DataFrame([(k, i, c) for k, own in counts.items() for i, c in own.items()], columns=["lang", "piece", "n"])

        got = words.mapInPandas(expected, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        counts = np.full(p.shape, PRIOR)
        for r in got:
            counts[languages.index(r["lang"]), r["piece"]] += r["n"]
        p = counts / counts.sum(axis=1, keepdims=True)
    return LanguageModel(languages, pieces, p)
