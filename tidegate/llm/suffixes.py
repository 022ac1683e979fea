"""Suffix-array dedup of exact byte repeats.

Every byte covered by a string of ``length`` bytes that also starts earlier is removed.  For that the
suffixes of all texts are sorted as far as ``length`` bytes, in parts that tasks sort by themselves:

1. *Dealing.*  A suffix goes to the part named by the smallest hash of the ``GRAM``-byte strings in its first
   ``length`` bytes (its anchor).  Equal strings have equal anchors at equal offsets, so copies always meet,
   and about ``length`` / 3 neighbouring suffixes share an anchor and travel as one stretch of text.
2. *Copies of stretches.*  Stretches are sorted by anchor and digest; all but the first of equal ones are
   repeats as a whole, and anchors with one stretch have none.  Repeats within a batch are settled
   before the shuffle, so a passage in a third of all documents sends one row per batch.
3. *Deep-shallow sorting* of the suffixes in the other stretches: a multikey quicksort, eight bytes to the
   key, orders them by their first ``SHALLOW`` bytes; groups that still agree go into blind tries, which
   branch on single bytes and compare a whole string once per insertion.  A suffix that meets its equal is a
   repeat of it.
4. Repeats are joined to spans per document and cut out.

Stretches of an anchor with more than ``LARGE`` different ones are not sorted by one task: each of their suffixes
becomes a row with its 128-bit digest, and an aggregation finds the first place of each digest.  So rows grow with the
suffixes, and no task holds more than a batch of them.

Defined cases.  Null texts are empty.  Texts shorter than ``length`` lose nothing.  Documents are ordered by id
(null first), rows with one id by a hash of their texts; rows equal in id and text count as one
document and get the same result.  What is kept may end inside a character, so ``kept`` is binary.  Other
columns stay; those with an output's name are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import renewed, same, sized, stored

LENGTH = 100
GRAM = 32
SHALLOW = 16
#: Stretches of one anchor that one task sorts at most; suffixes of more are counted one by one.
LARGE = 10_000
#: Suffixes that are hashed at a time (memory only).
PIECE = 1 << 20

_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_ODD = np.random.default_rng(8).integers(1, 1 << 62, 8, np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """Hashes of all ``GRAM``-byte strings, built by doubling their length."""
    h, size, k = _BYTE[b], 1, 0
    while size < GRAM:
        h = h[:-size] * _ODD[k] + h[size:]
        size, k = 2 * size, k + 1
    h ^= h >> np.uint64(32)
    h *= _ODD[6]
    return h ^ (h >> np.uint64(29))


def window_minima(h: np.ndarray, width: int) -> np.ndarray:
    m, size = h, 1
    while 2 * size <= width:
        m = np.minimum(m[:-size], m[size:])
        size *= 2
    rest = width - size
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def stretches(b: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, anchor, first, last suffix) of each maximal run of suffixes with one anchor, the leftmost
    smallest hash of their first ``length`` bytes."""
    width = length - GRAM + 1
    h = gram_hashes(b)
    m = window_minima(h, width)
    first = np.flatnonzero(np.concatenate([[True], m[1:] != m[:-1]]))
    last = np.concatenate([first[1:], [len(m)]]) - 1
    anchor = first + np.lib.stride_tricks.sliding_window_view(h, width)[first].argmin(axis=1)
    tied = np.flatnonzero(anchor < last)
    if len(tied):  # the same hash again within reach: the suffixes after the anchor belong to its next place
        plain = np.ones(len(first), bool)
        plain[tied] = False
        parts = [(first[plain], last[plain], anchor[plain])]
        for r in tied.tolist():
            at = first[r] + np.flatnonzero(h[first[r] : last[r] + width] == m[first[r]])
            lo = np.concatenate([[first[r]], at[:-1] + 1])
            use = lo <= last[r]
            parts.append((lo[use], np.minimum(at, last[r])[use], at[use]))
        first, last, anchor = (np.concatenate(x) for x in zip(*parts))
        by = np.argsort(first)
        first, last, anchor = first[by], last[by], anchor[by]
    return h[anchor], anchor, first, last


_ROW = "again boolean, v long, c long, id long, h long, x long, lo long, hi long"


def _deal(docs: DataFrame, length: int) -> DataFrame:
    """A row per stretch; ``again`` if an equal one comes earlier in the same batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hs = batch.column("id"), batch.column("h")
            # in the order of documents, so that the first of a batch is its earliest
            keys = [(i is not None, i or 0, h) for i, h in zip(ids.to_pylist(), hs.to_pylist())]
            order = sorted(range(len(keys)), key=keys.__getitem__)
            order = [k for n, k in enumerate(order) if not n or keys[k] != keys[order[n - 1]]]
            texts = batch.column("text")
            out: list[list] = [[], [], [], [], [], []]
            for k in order:
                raw = texts[k].as_buffer() if texts[k].is_valid else b""
                if len(raw) < length:
                    continue
                b = np.frombuffer(raw, np.uint8)
                view = memoryview(b)
                for start in range(0, len(b) - length + 1, PIECE):
                    v, x, lo, hi = stretches(b[start : start + PIECE + length - 1], length)
                    x, lo, hi = x + start, lo + start, hi + start
                    c = [xxhash.xxh3_64_intdigest(view[i : j + length], a) for i, j, a in zip(lo.tolist(), hi.tolist(), (x - lo).tolist())]
                    for own, value in zip(out, (v, np.array(c, np.uint64), np.full(len(x), k), x, lo, hi)):
                        own.append(value)
            if not out[0]:
                continue
            v, c, row, x, lo, hi = (np.concatenate(o) for o in out)
            place = np.arange(len(v))
            by = np.lexsort((place, c, v))
            repeat = np.concatenate([[False], (v[by][1:] == v[by][:-1]) & (c[by][1:] == c[by][:-1])])
            again = np.empty(len(v), bool)
            again[by] = repeat
            at = pa.array(row)
            for s in range(0, len(v), 200_000):
                part = slice(s, s + 200_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(again[part]), pa.array(v[part].view(np.int64)), pa.array(c[part].view(np.int64)), ids.take(at[part]), hs.take(at[part]),
                     pa.array(x[part]), pa.array(lo[part]), pa.array(hi[part])], ["again", "v", "c", "id", "h", "x", "lo", "hi"])

    return docs.mapInArrow(run, _ROW)


def _sort_stretches(rows: DataFrame) -> DataFrame:
    """``again`` for every stretch that has an earlier equal; of the others only those whose anchor has more than one.

    Rows come sorted by anchor, digest and place; one row is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # the last first row of the open anchor
        given = False  # whether it was given out, which is so if the anchor has several
        for batch in batches:
            again = batch.column("again").to_numpy(zero_copy_only=False)
            if again.any():
                yield batch.filter(pa.array(again))
                batch = batch.filter(pa.array(~again))
            if not batch.num_rows:
                continue
            known = held is not None and given
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            v, c = batch.column("v").to_numpy(), batch.column("c").to_numpy()
            new_v = np.concatenate([[True], v[1:] != v[:-1]])
            new_c = new_v | np.concatenate([[True], c[1:] != c[:-1]])
            group = np.cumsum(new_v) - 1
            different = np.bincount(group, weights=new_c)[group]
            if known:
                different[group == 0] += 1
            emit = new_c & (different > 1)
            if known:
                emit[0] = False
            place = [pc.fill_null(batch.column(k), -(1 << 63)).to_numpy() for k in ("id", "h", "x", "lo")]
            listed_twice = ~new_c & np.concatenate([[False], np.all([k[1:] == k[:-1] for k in place], axis=0)])
            repeat = ~new_c & ~listed_twice
            out = batch.filter(pa.array(emit | repeat))
            yield pa.RecordBatch.from_arrays([pa.array(repeat[emit | repeat]), *out.columns[1:]], out.schema.names)
            held, given = batch.slice(int(np.flatnonzero(new_c)[-1]), 1), bool(different[-1] > 1)

    key = F.when(F.col("again"), F.xxhash64("id", "x")).otherwise(F.col("v"))
    dealt = rows.withColumn("_key", key).repartition("_key").drop("_key").sortWithinPartitions("again", "v", "c", "id", "h", "x", "lo")
    return dealt.mapInArrow(run, _ROW)


# ---- deep-shallow sorting ------------------------------------------------------------------


def blind_trie_repeats(strings: list[bytes]) -> list[int]:
    """Places of the strings that are equal to an earlier one.

    Inner nodes are (depth, children by the byte at that depth); leaves are strings.  An insertion follows
    single bytes to some leaf, compares with it once, and branches where they first differ."""
    size = 8 * len(strings[0])
    root: object = strings[0]
    repeats = []
    for k in range(1, len(strings)):
        s, node = strings[k], root
        while not isinstance(node, bytes):
            depth, children = node
            node = children.get(s[depth]) or next(iter(children.values()))
        if node == s:
            repeats.append(k)
            continue
        differ = (size - (int.from_bytes(s, "big") ^ int.from_bytes(node, "big")).bit_length()) // 8
        other, parent, node = node[differ], None, root
        while not isinstance(node, bytes) and node[0] < differ:
            parent, node = node, node[1][s[node[0]]]
        if not isinstance(node, bytes) and node[0] == differ:
            node[1][s[differ]] = s
            continue
        branch = (differ, {other: node, s[differ]: s})
        if parent is None:
            root = branch
        else:
            parent[1][s[parent[0]]] = branch
    return repeats


def repeated_suffixes(v: np.ndarray, offset: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Which rows of ``windows`` (bytes) equal an earlier row with the same anchor ``v`` and ``offset``."""
    n, length = windows.shape
    shallow = min(SHALLOW, length // 8 * 8)
    keys = [np.ascontiguousarray(windows[:, k : k + 8]).view(">u8")[:, 0].astype(np.uint64) for k in range(0, shallow, 8)]
    order = np.lexsort((np.arange(n), offset, v))
    group = np.concatenate([[0], np.cumsum((v[order][1:] != v[order][:-1]) | (offset[order][1:] != offset[order][:-1]))])
    for key in keys:  # multikey quicksort: only groups that still agree are ordered by the next key
        size = np.bincount(group)[group]
        order, group = order[size > 1], group[size > 1]
        if not len(order):
            return np.zeros(n, bool)
        by = np.lexsort((order, key[order], group))
        order, group = order[by], group[by]
        k = key[order]
        group = np.concatenate([[0], np.cumsum((group[1:] != group[:-1]) | (k[1:] != k[:-1]))])
    size = np.bincount(group)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])
    repeat = np.zeros(n, bool)
    two = start[size == 2]  # a trie of two strings is one comparison
    x, y = order[two], order[two + 1]
    repeat[y] = (windows[x] == windows[y]).all(axis=1)
    for s, m in zip(start[size > 2].tolist(), size[size > 2].tolist()):
        at = order[s : s + m]
        repeat[at[blind_trie_repeats([w.tobytes() for w in windows[at]])]] = True
    return repeat


def _settle(rows: list[tuple], length: int) -> pa.RecordBatch | None:
    """Repeats among the suffixes of stretches (v, id, h, x, lo, hi, bytes), in order of place."""
    counts = np.array([r[5] - r[4] + 1 for r in rows])
    owner = np.repeat(np.arange(len(rows)), counts)
    shift = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    base = np.concatenate([[0], np.cumsum([len(r[6]) for r in rows])[:-1]])
    buffer = np.frombuffer(b"".join(r[6] for r in rows), np.uint8)
    windows = np.lib.stride_tricks.sliding_window_view(buffer, length)[base[owner] + shift]
    v = np.array([r[0] for r in rows], np.int64)[owner]
    offset = np.array([r[3] - r[4] for r in rows])[owner] - shift
    repeat = repeated_suffixes(v, offset, windows)
    hit = np.flatnonzero(repeat)
    if not len(hit):
        return None
    begin = np.concatenate([[True], (hit[1:] != hit[:-1] + 1) | (owner[hit[1:]] != owner[hit[:-1]])])
    s, e = hit[begin], hit[np.concatenate([begin[1:], [True]])]
    lo = np.array([r[4] for r in rows])
    return pa.RecordBatch.from_arrays(
        [pa.array([rows[o][1] for o in owner[s].tolist()], pa.int64()), pa.array([rows[o][2] for o in owner[s].tolist()], pa.int64()),
         pa.array(lo[owner[s]] + shift[s]), pa.array(lo[owner[e]] + shift[e] + length)], ["id", "h", "start", "end"])


def _sort_suffixes(rows: DataFrame, length: int) -> DataFrame:
    """``rows``: stretches with their bytes, ``LARGE`` of an anchor at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= 4000 and held[-1][0] != row[0]:
                    found = _settle(held, length)
                    held = []
                    if found is not None:
                        yield found
                if not held or held[-1][:5] != row[:5]:  # a document that is listed twice sends its stretches twice
                    held.append(row)
        if held:
            found = _settle(held, length)
            if found is not None:
                yield found

    dealt = rows.repartition("v").sortWithinPartitions("v", "id", "h", "x", "lo")
    return dealt.select("v", "id", "h", "x", "lo", "hi", "bytes").mapInArrow(run, "id long, h long, start long, end long")


def _single_suffixes(rows: DataFrame, length: int) -> DataFrame:
    """A row (d, e, id, h, start) per suffix of stretches with their bytes; (d, e) is its digest.  Equal suffixes have
    equal anchors, which need not be told apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 2000):
                part = batch.slice(begin, 2000)
                digests = [xxhash.xxh3_128_digest(b[k : k + length]) for b in map(memoryview, part.column("bytes").to_pylist()) for k in range(len(b) - length + 1)]
                words = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                lo, counts = part.column("lo").to_numpy(), part.column("hi").to_numpy() - part.column("lo").to_numpy() + 1
                owner = np.repeat(np.arange(len(lo)), counts)
                start = lo[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
                at = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words[:, 0]), pa.array(words[:, 1]), part.column("id").take(at), part.column("h").take(at), pa.array(start)], ["d", "e", "id", "h", "start"])

    return rows.select("id", "h", "lo", "hi", "bytes").mapInArrow(run, "d long, e long, id long, h long, start long")


def _count_suffixes(rows: DataFrame, length: int) -> DataFrame:
    """Repeats among the suffixes of stretches with their bytes, however many an anchor has."""
    place = F.struct("id", "h", "start")
    single = stored(_single_suffixes(rows, length))
    # nulls come first in the order of structs
    several = single.groupBy("d", "e").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(~same(F.col("first"), F.col("last")))
    again = single.join(several.select("d", "e", "first"), ["d", "e"]).filter(~same(place, F.col("first")))
    return again.select("id", "h", "start", (F.col("start") + length).alias("end"))


def _repeats(source: DataFrame, different: DataFrame, length: int) -> DataFrame:
    """Spans of repeated suffixes in the stretches of ``different``."""
    counts = different.groupBy("v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LARGE)
    large = sized(counts.select("v"))
    if large.isEmpty():
        return _sort_suffixes(_with_bytes(source, different, length), length)
    small = _sort_suffixes(_with_bytes(source, different.join(large, "v", "left_anti"), length), length)
    return small.unionByName(_count_suffixes(_with_bytes(source, different.join(large, "v", "left_semi"), length), length))


def _with_bytes(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Stretches with their bytes: places are gathered per document and joined with its text."""
    places = wanted.groupBy("id", "h").agg(F.collect_list(F.struct("v", "x", "lo", "hi")).alias("at"))
    places = places.withColumnsRenamed({"id": "w_id", "h": "w_h"})  # grows with the texts: no broadcast at any size
    joined = docs.join(places, same(F.col("id"), F.col("w_id")) & (F.col("h") == F.col("w_h"))).select("id", "h", "text", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["v", "id", "h", "x", "lo", "hi", "bytes"]
        for batch in batches:
            for row in range(batch.num_rows):
                raw = memoryview(batch.column("text")[row].as_buffer())
                at = batch.column("at")[row].values
                v, x, lo, hi = (at.field(k) for k in range(4))
                n = len(at)
                cut = [bytes(raw[i : j + length]) for i, j in zip(lo.to_pylist(), hi.to_pylist())]
                keys = [pa.array([batch.column(c)[row].as_py()] * n, pa.int64()) for c in ("id", "h")]
                yield pa.RecordBatch.from_arrays([v, *keys, x, lo, hi, pa.array(cut, pa.binary())], names)

    return joined.mapInArrow(run, "v long, id long, h long, x long, lo long, hi long, bytes binary")


def dedup_bytes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """All columns of ``docs`` and ``n_bytes``, ``n_removed``, ``removed_spans`` (maximal ranges of bytes from 0, end
    exclusive) and ``kept`` (binary).  ``length`` must be at least twice ``GRAM``."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    extra = ("n_bytes", "n_removed", "removed_spans", "kept")
    full = F.coalesce(F.col(text), F.lit(""))
    ids = docs.select(F.col(doc_id).cast("long").alias("id"))
    # texts need telling apart by a hash only where an id occurs twice; eight bytes less for each stretch
    one_each = ids.groupBy("id").count().filter("count > 1").isEmpty()
    h = F.lit(0).cast("long") if one_each else F.xxhash64(full)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), h.alias("h"), full.alias("text"))
    sorted_rows = stored(_sort_stretches(_deal(source, length)))
    whole = sorted_rows.filter("again").select("id", "h", F.col("lo").alias("start"), (F.col("hi") + length).alias("end"))
    different = sorted_rows.filter("NOT again").select("v", "id", "h", "x", "lo", "hi")
    parts = _repeats(source, different, length)
    spans = whole.unionByName(parts).groupBy("id", "h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    spans = spans.withColumnsRenamed({"id": "s_id", "h": "s_h"})

    @F.pandas_udf("n_bytes long, n_removed long, removed_spans array<struct<start: long, end: long>>, kept binary")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        def of(text: str, spans) -> tuple:
            raw = text.encode()
            if spans is None:
                return len(raw), 0, [], raw
            merged: list[list[int]] = []
            for s, e in sorted((x["start"], x["end"]) for x in spans):
                if merged and s <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], e)
                else:
                    merged.append([s, e])
            kept, at = [], 0
            for s, e in merged:
                kept.append(raw[at:s])
                at = e
            return len(raw), sum(e - s for s, e in merged), [{"start": s, "end": e} for s, e in merged], b"".join([*kept, raw[at:]])

        for texts, found in batches:
            yield pd.DataFrame([of(t, s) for t, s in zip(texts, found)], columns=list(extra))

    own = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    here = same(F.col(f"row.`{doc_id}`").cast("long"), F.col("s_id")) & ((F.lit(0) if one_each else F.xxhash64(own)) == F.col("s_h"))
    joined = docs.select(F.struct("*").alias("row")).join(spans, here, "left").withColumn("cut", cut(own, F.col("spans")))
    return renewed(joined, docs.columns, {c: F.col(f"cut.{c}") for c in extra})
