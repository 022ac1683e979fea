"""Benchmark decontamination by winnowing, with DataFrame functions only.

Texts are words (ASCII letters in lower case).  For each window of ``window`` words the smallest hash
of its ``gram``-word sequences is the fingerprint; a run of windows with one fingerprint is one row.
Equal windows have equal fingerprints, so every shared span of ``window`` words or more is found by
joining the documents' runs with the test fingerprints.  The windows of the runs that
meet are then compared in full, and matching windows extend to spans of hit words.

Test items of fewer words than ``window`` are one window each.  Their lengths (at most ``window`` - 1
different ones) get fingerprints of their own.

The fingerprint and window tables of the test side are broadcast if they are counted and small,
else the joins shuffle and AQE splits hot keys.  Per document only its own hits are grouped.

Defined cases.  Null or empty texts have no words and no hits.  Documents are told apart by id and
text, so repeated rows and null ids are fine: each row gets the result of its own text.  Null item
ids are left out of ``items``, their texts still hit.  Without test items nothing is hit.  Columns of
``docs`` that bear the name of an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import renewed, same, sized, stored, text_or_empty

WINDOW = 10
GRAM = 5
#: Runs of words: ASCII digits and letters, and everything outside ASCII.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, although ``body`` uses it for each element of an array."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """Words with only ASCII letters lowered; ``lower`` does just that where the text is ASCII."""
    low = F.when(F.regexp_like(text, F.lit(r"[^\x00-\x7F]")), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.regexp_extract_all(low, F.lit(WORDS), F.lit(0))


def runs(text: Column, n: int, gram: int) -> Column:
    """Array of (fp, first, last): the runs of ``n``-word windows, numbered from 1, by smallest gram hash."""
    k = min(gram, n)
    per_window = n - k + 1

    def of_hashes(h: Column) -> Column:
        size = F.size(h)
        grams = F.transform(F.sequence(F.lit(0), size - k), lambda i: F.xxhash64(*[h[i + j] for j in range(k)]))
        if per_window == 1:
            return bound(grams, of_fingerprints)
        smallest = lambda g: F.transform(F.sequence(F.lit(0), F.size(g) - per_window), lambda i: F.least(*[g[i + j] for j in range(per_window)]))
        return bound(grams, lambda g: bound(smallest(g), of_fingerprints))

    def of_fingerprints(m: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(m) - 1), lambda i: (i == 0) | (m[i] != m[F.greatest(i - 1, F.lit(0))]))
        return bound(starts, lambda s: F.transform(s, lambda at, j: F.struct(
            m[at].alias("fp"), (at + 1).alias("first"), F.coalesce(F.get(s, j + 1), F.size(m)).alias("last"))))

    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    none = F.lit(None).cast("array<struct<fp: bigint, first: int, last: int>>")
    return bound(hashes, lambda h: F.when(F.size(h) >= n, of_hashes(h)).otherwise(none))


def _windows(w: Column, n: int, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.struct(i.alias("start"), F.array_join(F.slice(w, i, n), " ").alias("words")))


def _compared(starts: Column, n: int) -> Column:
    return bound(words(F.col("t")), lambda w: _windows(w, n, starts))


def decontaminate(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, gram: int = GRAM,
) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``n_hit``, ``hit_spans`` (ranges of words from 0, end
    exclusive) and ``items`` (ids, as strings in order, of the items with a window in the text)."""
    tests = items.select(F.col(item_id).cast("string").alias("item"), text_or_empty(item_text).alias("t"))
    tests = stored(tests.withColumn("w", words(F.col("t"))).filter(F.size("w") > 0).withColumn("n", F.least(F.size("w"), F.lit(window))))
    lengths = sorted(r["n"] for r in tests.select("n").distinct().collect())  # at most `window` different ones
    source = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t")).withColumn("h", F.xxhash64("t"))

    hits = None
    for n in lengths:
        own = tests.filter(F.col("n") == n)
        fingerprints = sized(own.select(F.explode(runs(F.col("t"), n, gram)).alias("r")).select("r.fp").distinct())
        all_starts = F.sequence(F.lit(1), F.size("w") - n + 1)
        shared = own.select("item", F.explode(_windows(F.col("w"), n, all_starts)).alias("x")).groupBy("x.words").agg(F.collect_set("item").alias("items"))
        shared = sized(shared, weight=F.size("items") + 1)
        met = source.select("id", "h", F.explode(runs(F.col("t"), n, gram)).alias("r")).select("id", "h", "r.*")
        met = met.join(fingerprints, "fp", "left_semi").groupBy("id", "h").agg(F.collect_set(F.struct("first", "last")).alias("met"))
        met = sized(met.withColumnsRenamed({"id": "met_id", "h": "met_h"}), weight=F.size("met"))
        candidates = source.join(met, same(F.col("id"), F.col("met_id")) & (F.col("h") == F.col("met_h")))
        starts = F.flatten(F.transform("met", lambda r: F.sequence(r["first"], r["last"])))
        compared = _compared(starts, n)
        found = candidates.select("id", "h", F.explode(compared).alias("x")).select("id", "h", "x.*").join(shared, "words")
        found = found.select("id", "h", F.struct("start", F.lit(n).alias("n")).alias("at"), "items")
        hits = found if hits is None else hits.unionByName(found)

    full = text_or_empty(f"row.`{text}`")
    counted = docs.select(F.struct("*").alias("row"))
    n_words = F.regexp_count(full, F.lit(WORDS)).cast("long")
    empty = {"n_hit": F.lit(0).cast("long"), "hit_spans": F.array().cast("array<struct<start: int, end: int>>"), "items": F.array().cast("array<string>")}
    if hits is None:
        return renewed(counted, docs.columns, {"n_words": n_words, **empty})
    by_doc = hits.groupBy("id", "h").agg(F.array_sort(F.collect_set("at")).alias("at"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("found"))
    spans = F.aggregate(
        "at",
        F.array().cast("array<struct<start: int, end: int>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"] - 1),
            F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(
                F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["start"] - 1 + x["n"]).alias("end"))))
        ).otherwise(F.concat(done, F.array(F.struct((x["start"] - 1).alias("start"), (x["start"] - 1 + x["n"]).alias("end"))))),
    )
    by_doc = by_doc.select(F.col("id").alias("hit_id"), F.col("h").alias("hit_h"), spans.alias("found_spans"), "found")
    by_doc = sized(by_doc, weight=F.size("found_spans") + F.size("found"))
    there = same(F.col(f"row.`{doc_id}`"), F.col("hit_id")) & (F.xxhash64(full) == F.col("hit_h"))
    joined = counted.join(by_doc, there, "left")
    n_hit = F.aggregate("found_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return renewed(joined, docs.columns, {
        "n_words": n_words, "n_hit": F.coalesce(n_hit, empty["n_hit"]), "hit_spans": F.coalesce("found_spans", empty["hit_spans"]),
        "items": F.coalesce("found", empty["items"]),
    })
