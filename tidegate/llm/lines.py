"""Line dedup by a suffix array over line ids.

A document is a sequence of line ids.  Prefix doubling sorts its suffixes: ranks by the first 2^p lines
come from pairs of ranks by the first 2^(p-1).  Suffixes that agree on their first k lines are an
interval of the suffix array whose longest common prefix is k or more; the interval is named by the ranks of
the first and of the last 2^p of the k lines.  A run of lines is deleted where an interval holds an earlier
copy of it, if the run has ``min_words`` words; runs that overlap or touch join to maximal ones, so every
line that lies in a long enough repeated run goes, but for its first copy.

Each round is a sort of the distinct pairs only (grouped with map-side combining, so a line that a third of
all documents share is one row there), and a rank is kept only for suffixes that still repeat.  Sorting stops
at the depth that the longest needed run has, about log2(lines per ``min_words`` words) rounds.

Order of copies: by id (null first), then by row, then by line.  Defined cases: null texts count as empty and
keep their null; an empty text is one line without words.  Repeated rows are later copies of the first.
Lines are compared exactly (128-bit digests), white space included.  Columns that bear the name of an
output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import PART_ROWS, free, lean, release, renewed, sized, small_batches, stored

MIN_WORDS = 50


def line_table(docs: DataFrame, min_words: int) -> DataFrame:
    """(row, id, line, a, b, k): for each line its digest (two longs) and the fewest lines from it on that
    have ``min_words`` words (null if the text ends before)."""
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("line", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("k", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, ks = [], [], []
            for text in batch.column("text").to_pylist():
                own = text.encode().split(b"\n") if text else [b""]
                ends = np.cumsum([len(x.split()) for x in own])
                before = np.concatenate([[0], ends[:-1]])
                k = np.searchsorted(ends, before + min_words) - np.arange(len(own)) + 1
                k[before + min_words > ends[-1]] = 0
                sizes.append(len(own))
                ks.append(k)
                digests += map(xxhash.xxh3_128_digest, own)
            if not sizes:
                continue
            n = np.array(sizes)
            line = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            half = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            k = np.concatenate(ks)
            at = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(at), batch.column("id").take(at), pa.array(line.astype(np.int32)), pa.array(half[:, 0].copy()),
                 pa.array(half[:, 1].copy()), pa.array(k.astype(np.int32), mask=k == 0)], schema=schema)

    return docs.mapInArrow(lean(run, PART_ROWS), "row long, id long, line int, a long, b long, k int")


def _ranks(pairs: DataFrame) -> DataFrame:
    """(a, b, rank) of the pairs that occur twice or more, ranks in their order.  Ids that grow within and
    over sorted partitions are ranks; they are fixed by writing them."""
    twice = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    return sized(twice.repartitionByRange("a", "b").sortWithinPartitions("a", "b").withColumn("rank", F.monotonically_increasing_id()))


def _at(suffixes: DataFrame, offset: str) -> DataFrame:
    """Suffixes with the rank ``b`` of the one ``offset`` lines on; those without one drop out."""
    other = suffixes.select(F.col("row").alias("o_row"), F.col("line").alias("o_line"), F.col("rank").alias("b"))
    there = (F.col("row") == F.col("o_row")) & (F.col("line") + F.expr(offset) == F.col("o_line"))
    return suffixes.withColumnRenamed("rank", "a").join(other, there).drop("o_row", "o_line")


def repeated_runs(lines: DataFrame) -> DataFrame:
    """(row, line, k, first_id, first_row, first_line): the runs that have an earlier copy, with the first."""
    longest = lines.agg(F.max("k")).first()[0] or 0
    ranks = _ranks(lines.select("a", "b"))
    suffixes = stored(lines.join(ranks, ["a", "b"]).select("row", "id", "line", "k", "rank"))
    found, length = None, 1
    while length <= longest:
        due = _at(suffixes, f"k - {length}").filter(f"k >= {length} AND k < {2 * length}") if length > 1 else suffixes.filter("k = 1").withColumnsRenamed({"rank": "a"}).withColumn("b", F.col("a"))
        due = stored(due.select("row", "id", "line", "k", "a", "b"))
        place = F.struct("id", "row", "line")
        first = due.groupBy("k", "a", "b").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
        later = due.join(first, ["k", "a", "b"]).filter(~place.eqNullSafe(F.col("first")))
        later = later.select("row", "line", "k", F.col("first.id").alias("first_id"), F.col("first.row").alias("first_row"), F.col("first.line").alias("first_line"))
        found = later if found is None else found.unionByName(later)
        if 2 * length > longest:
            break
        pairs = _at(suffixes, str(length))
        ranks = _ranks(pairs.select("a", "b"))
        suffixes = stored(pairs.join(ranks, ["a", "b"]).select("row", "id", "line", "k", "rank"))
        length *= 2
    if found is None:
        found = lines.filter("false").selectExpr("row", "line", "k", "id AS first_id", "row AS first_row", "line AS first_line")
    return found


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All columns of ``docs`` and ``n_lines``, ``n_deleted``, ``deleted_runs`` (ranges of lines from 0, end
    exclusive) and ``kept_text``.

    The rows are written once, so that the row numbers hold whatever is computed twice.
    """
    small_batches(docs.sparkSession)
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("n")))
    full = F.col(f"row.`{text}`")
    lines = stored(line_table(rows.select(F.col("n").alias("row"), F.col(f"row.`{doc_id}`").cast("long").alias("id"), full.alias("text")), min_words))
    runs = repeated_runs(lines)
    by_doc = runs.groupBy("row").agg(F.array_sort(F.collect_set(F.struct(F.col("line").alias("start"), (F.col("line") + F.col("k")).alias("end")))).alias("runs"))
    by_doc = sized(by_doc.withColumnRenamed("row", "run_row"), weight=F.size("runs"))

    @F.pandas_udf("n_lines long, n_deleted long, deleted_runs array<struct<start: int, end: int>>, kept_text string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def of(text: str | None, runs) -> tuple:
            own = (text or "").split("\n")
            merged: list[list[int]] = []
            for run in runs if runs is not None else ():
                if merged and run["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], run["end"])
                else:
                    merged.append([run["start"], run["end"]])
            if not merged:
                return len(own), 0, [], text
            kept, at = [], 0
            for start, end in merged:
                kept += own[at:start]
                at = end
            kept += own[at:]
            return len(own), sum(e - s for s, e in merged), [{"start": s, "end": e} for s, e in merged], "\n".join(kept)

        release()
        for texts, runs in batches:
            for k in range(0, len(texts), PART_ROWS):
                found = [of(t, r) for t, r in zip(texts.iloc[k : k + PART_ROWS], runs.iloc[k : k + PART_ROWS])]
                yield pd.DataFrame(found, columns=["n_lines", "n_deleted", "deleted_runs", "kept_text"])
        free()

    joined = rows.join(by_doc, F.col("n") == F.col("run_row"), "left").withColumn("cut", cut(full, F.col("runs")))
    return renewed(joined, docs.columns, {c: F.col(f"cut.{c}") for c in ("n_lines", "n_deleted", "deleted_runs", "kept_text")})
