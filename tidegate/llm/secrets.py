"""Secret scans by a trigram inverted index.

Each rule is a regex with a Boolean query over trigrams (three characters, ASCII letters in
lower case) that every match satisfies: ``derive`` gets it from the parsed regex.  The index
holds posting rows (trigram, document) for the trigrams that some query names; a rule's
candidates are the documents found by intersecting and uniting its postings.  Only candidates
are searched with the rule's regex; a rule with no mandatory trigram searches every document.

Null texts are empty.  Rows with equal ``doc_id`` share their postings, which can only add
candidates; every row is verified by itself, so results hang on the row alone.  Null ids are
fine.  Spans are code points, end exclusive.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

try:
    from re import _constants as sre
    from re import _parser as sre_parse
except ImportError:  # before Python 3.11
    import sre_constants as sre
    import sre_parse

from tidegate.llm.common import renewed, sized, text_or_empty

#: A set of literals grows to so many members at most before it is turned into trigrams.
MOST_LITERALS = 64


@dataclass(frozen=True)
class Rule:
    """``least``: the shortest ``group`` that counts; matches below it are found and dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    # a run's match is the whole run, so the least length can stand in the pattern
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("url_password", r"://[A-Za-z0-9_.-]+:[A-Za-z0-9_.!-]+@"),
)
RULES = BASE + MORE

# ---- Boolean trigram queries -------------------------------------------------------------
# A query in disjunctive form: a set of clauses, each a set of trigrams that must all occur.
# None: no trigram is mandatory.


def _trigrams(literals: frozenset[str]) -> frozenset[frozenset[str]] | None:
    clauses = set()
    for s in literals:
        if len(s) < 3:
            return None
        clauses.add(frozenset(s[i : i + 3] for i in range(len(s) - 2)))
    return frozenset(clauses)


def _and(a, b):
    """Both: keep the side with fewer clauses if a product would be large (still necessary)."""
    if a is None or b is None:
        return b if a is None else a
    if len(a) * len(b) > MOST_LITERALS:
        return min(a, b, key=len)
    return frozenset(x | y for x in a for y in b)


def _or(parts):
    parts = list(parts)
    return None if any(p is None for p in parts) else frozenset().union(*parts)


def _range_members(items) -> frozenset[str] | None:
    """The characters of a class if they are few."""
    members: set[str] = set()
    for op, arg in items:
        if op is sre.LITERAL:
            members.add(chr(arg))
        elif op is sre.RANGE and arg[1] - arg[0] < 8:
            members |= {chr(c) for c in range(arg[0], arg[1] + 1)}
        else:
            return None
    return frozenset(members) if len(members) <= 8 else None


def _sequence(nodes):
    """(query, exact literals or None) of a sequence of parsed nodes."""
    query, run = None, frozenset({""})  # the literals that the nodes since the last gap can match

    def close():
        nonlocal query, run
        query, run = _and(query, _trigrams(run)), frozenset({""})

    exact: frozenset[str] | None = frozenset({""})
    for op, arg in nodes:
        part, own = _node(op, arg)
        query = _and(query, part)
        if own is not None and len(run) * len(own) <= MOST_LITERALS:
            run = frozenset(x + y for x in run for y in own)
        else:
            close()
            exact = None
            if own is not None:
                run = own
    if exact is not None:
        return query, run
    close()
    return query, None


def _node(op, arg):
    if op is sre.LITERAL:
        return None, frozenset({chr(arg).lower() if arg < 128 else chr(arg)})
    if op is sre.IN:
        members = _range_members(arg)
        return None, None if members is None else frozenset(c.lower() if c < "\x80" else c for c in members)
    if op is sre.SUBPATTERN:
        return _sequence(arg[-1])
    if op is sre.BRANCH:
        parts = [_sequence(x) for x in arg[1]]
        if all(lits is not None for _, lits in parts) and sum(len(lits) for _, lits in parts) <= MOST_LITERALS:
            return None, frozenset().union(*(lits for _, lits in parts))
        return _or(q if lits is None else _and(q, _trigrams(lits)) for q, lits in parts), None
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        query, lits = _sequence(inner)
        if lits is not None and (low, high) == (0, 1):
            return None, lits | {""}
        if low == high == 1:
            return query, lits
        if low == 0:
            return None, None
        return (query if lits is None else _and(query, _trigrams(lits))), None
    return None, None


def derive(pattern: str) -> list[list[str]] | None:
    """The trigram query of a regex: a list of clauses, or None if it has no mandatory trigram."""
    query, literals = _sequence(sre_parse.parse(pattern, re.ASCII))
    if literals is not None:
        query = _and(query, _trigrams(literals))
    if query is None:
        return None
    least = [c for c in query if not any(o < c for o in query)]
    return sorted(sorted(c) for c in least)


# ---- index, candidates, verification -----------------------------------------------------


def _codes(trigrams: list[str]) -> np.ndarray:
    raw = np.array([list(t.encode("latin-1")) for t in trigrams], np.int64).reshape(-1, 3)
    return raw[:, 0] << 16 | raw[:, 1] << 8 | raw[:, 2]


def postings(docs: DataFrame, trigrams: list[str], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The inverted index: a row (trigram, doc_id) for each of ``trigrams`` and each document that
    has it.  ``trigrams`` must be ASCII in lower case; their number hangs on the rules only."""
    names = sorted(set(trigrams))
    codes = _codes(names)

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        slot = np.zeros(1 << 21 if not len(codes) else int(codes.max()) + 1, np.uint16)
        slot[codes] = np.arange(1, len(codes) + 1)
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32

        def of(text: str) -> list[str]:
            b = lower[np.frombuffer(text.encode(), np.uint8)].astype(np.int32)
            if len(b) < 3 or not names:
                return []
            grams = b[:-2] << 16 | b[1:-1] << 8 | b[2:]
            return [names[i - 1] for i in np.unique(slot[grams[grams < len(slot)]]).tolist() if i]

        for texts in batches:
            yield pd.Series([of(t) for t in texts], dtype=object)

    return docs.select(F.col(doc_id).alias("doc_id"), F.explode(found(text_or_empty(text))).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the rules whose query a document's postings satisfy.

    Each posting is dealt to the clauses that ask for it; a clause holds for a document if all its
    trigrams came.  Grouped by document, a group has at most one posting per clause and trigram of
    the rules, so a frequent trigram loads no single task.
    """
    rows = [(r.kind, n, len(clause), t) for r in rules for n, clause in enumerate(derive(r.pattern) or []) for t in clause]
    spark = index.sparkSession
    clauses = spark.createDataFrame(rows, "kind string, clause int, need int, trigram string")
    return (
        index.join(F.broadcast(clauses), "trigram")  # as large as the rules
        .groupBy("doc_id", "kind", "clause", "need")
        .agg(F.size(F.collect_set("trigram")).alias("n"))
        .filter("n = need")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``spans``: array of (kind, start, end), by start, then rule order."""
    queries = {r.kind: derive(r.pattern) for r in rules}
    always = [k for k, q in queries.items() if q is None]
    wanted = [t for q in queries.values() for clause in q or [] for t in clause]
    hits = sized(candidates(postings(docs, wanted, doc_id, text), rules).withColumnRenamed("doc_id", "hit_id"))
    shapes = [(r.kind, r.pattern, r.group, r.least) for r in rules]
    always_set = frozenset(always)

    @F.pandas_udf("array<struct<kind: string, start: long, end: long>>")
    def verified(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        compiled = [(k, re.compile(p, re.ASCII).finditer, g, n) for k, p, g, n in shapes]

        def of(text: str, kinds) -> list[tuple]:
            asked = always_set if kinds is None else always_set.union(kinds)
            out = []
            for order, (kind, matches, group, least) in enumerate(compiled):
                if kind in asked:
                    for m in matches(text):
                        if m.end(group) - m.start(group) >= least:
                            out.append((m.start(), order, kind, m.end()))
            return [{"kind": k, "start": s, "end": e} for s, _, k, e in sorted(out)]

        for texts, kinds in batches:
            yield pd.Series([of(t, k) for t, k in zip(texts, kinds)], dtype=object)

    joined = docs.select(F.struct("*").alias("row")).join(hits, F.col(f"row.`{doc_id}`").eqNullSafe(F.col("hit_id")), "left")
    return renewed(joined, docs.columns, {"spans": verified(text_or_empty(f"row.`{text}`"), F.col("kinds"))})
