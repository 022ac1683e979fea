"""Exact Jaccard join of documents by their word shingles, in metric space.

1. *Regions.*  In plain Jaccard space all unrelated documents are at distance 1 from each other and from
   every pivot, where the triangle inequality separates nothing.  So the first cut is by content:
   two sets of similarity s share one of their first (1 - s) n + 1 shingles in any common order, and
   a document goes to the region of each of these shingles.  The order puts the most frequent shingles
   last (a table of fixed size), so frequent passages open few regions.  Of a linked pair the smaller set has
   the first shared shingle so early that enough for 2s / (1 + s) of its own size follow; a member with fewer left
   only follows, and pairs only with smaller ones that lead.  Regions of one document or without a leader are
   dropped: pages that share less than 2s / (1 + s) of a passage never meet through it.
2. *Pivots.*  Each region has a leader as its pivot, another one each turn; every member is tested against one pivot of its
   regions.  Members linked to a pivot are in one component and need no tests among each other, so a group of
   n near copies costs n tests a turn and not n^2.
3. *Parts.*  Of regions with the same members one is kept.  Regions with members in different components and over
   ``PART`` members are cut by size, then into blocks; pairs of blocks are dealt over the tasks, those within the
   largest component left out, so a task holds two blocks of about ``PART`` members.
4. *Recursion.*  Parts are cut again in their tasks: in the metric of parity
   sketches (bit i is the parity of a set's members that hash to i; the number of bits that differ is at most
   the size of the symmetric difference) pivots open Voronoi cells, a member also joins the cells of
   pivots that are at most twice the allowed difference farther than its own, and cells are cut
   until they are small.  Pairs that the sketches allow are tested exactly.
5. Links are joined to components by ``components``.

Sets are told apart by a 128-bit digest; documents with the same set are one node, so exact copies
are grouped by an aggregation and never paired.  Sets are shipped only for pairs that pass
the sketches.  Shingles are compared by 64-bit hashes.

Defined cases.  Null texts and texts without words have the empty set and link with nothing, not even with
each other.  With fewer than ``words`` words the whole sequence is one shingle.  A component is named by the
smallest id in it (null if all its ids are null).  Rows with one id and different texts are nodes of their
own; repeated rows get the same result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import PART_ROWS, lean, same, sized, small_batches, stored
from tidegate.llm.components import components

WORDS = 5
#: Similarity in percent.
PERCENT = 80
#: Size of the table of frequent shingles that go last; it only sets the order.
FREQUENT = 200_000
#: A shingle found in so many documents of one batch is reported as frequent.
REPORTED = 8
#: Voronoi cells up to this size are compared member by member.
SMALL_CELL = 256
#: Members of a region that one task holds; of larger regions two blocks of about so many.
PART = 4096
#: Turns in which every member is tested against one pivot, before what is left is compared in full.
TURNS = 3
PIVOTS = 8

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Hashes of the distinct shingles, in order."""
    found = text.encode().translate(_LOWER).split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    n = max(1, len(h) - words + 1)
    total = np.zeros(n, np.uint64)
    for k in range(min(words, len(h))):
        total = total * _ODD + h[k : k + n]
    return np.unique(mixed(total + np.uint64(min(words, len(h)))))


def digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def key_of(d: bytes) -> int:
    return int.from_bytes(d[:8], "little", signed=True)


def sketch(s: np.ndarray) -> bytes:
    """Parities of the members by hash, one bit per member and 256 at least."""
    bits = max(256, 1 << int(len(s) - 1).bit_length()) if len(s) else 256
    ones = np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def fold(raw: np.ndarray, size: int) -> np.ndarray:
    """A sketch of fewer bytes: halves are xor-ed."""
    while len(raw) > size:
        raw = raw[: len(raw) // 2] ^ raw[len(raw) // 2 :]
    return raw


def allowed(a, b, percent: int):
    """The largest symmetric difference of linked sets of these sizes."""
    return (100 - percent) * (a + b) // (100 + percent)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _differences(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x[:, None, :] ^ y[None, :, :]).sum(axis=2, dtype=np.int64)


def voronoi_pairs(sketches: np.ndarray, sizes: np.ndarray, comps: np.ndarray, percent: int, leads: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Pairs (places in the arrays) in different components that sizes and sketches allow to be linked.  Members that do
    not lead (all do, if not given) are paired with smaller ones that lead."""
    leads = np.ones(len(sizes), bool) if leads is None else leads
    stack = [np.arange(len(sizes))]
    while stack:
        cell = stack.pop()
        # members of the largest component need no tests among each other
        names, places = np.unique(comps[cell], return_inverse=True)
        most = np.bincount(places).argmax()
        rest, main = cell[places != most], cell[places == most]
        if len(rest) > SMALL_CELL:
            reach = int(allowed(sizes[cell].max(), sizes[cell].max(), percent))
            pivots = cell[np.linspace(0, len(cell) - 1, PIVOTS).astype(int)]
            d = _differences(sketches[cell], sketches[pivots])
            near = d.min(axis=1)
            cells = [cell[d[:, k] <= near + 2 * reach] for k in range(PIVOTS)]
            if sum(len(c) ** 2 for c in cells) < len(cell) ** 2 // 2 and all(len(c) < len(cell) for c in cells):
                stack += cells
                continue
        other = np.concatenate([rest, main])
        for start in range(0, len(rest), SMALL_CELL):
            x = rest[start : start + SMALL_CELL]
            for part in range(start, len(other), 4 * SMALL_CELL):
                z = other[part : part + 4 * SMALL_CELL]
                a, b = sizes[x][:, None], sizes[z][None, :]
                fine = (comps[x][:, None] != comps[z][None, :]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
                fine &= (leads[x][:, None] | (b < a)) & (leads[z][None, :] | (a < b))
                if fine.any():
                    fine &= _differences(sketches[x], sketches[z]) <= allowed(a, b, percent)
                    i, j = np.nonzero(fine)
                    yield from zip(x[i].tolist(), z[j].tolist())


def _longs(values) -> pa.Array:
    return pa.array(np.asarray(values).astype(np.uint64).view(np.int64) if len(values) else [], pa.int64())


def _describe(docs: DataFrame, words: int) -> DataFrame:
    """For each row (id, key, digest, n, sketch); and, with a null digest, the shingles that are frequent in a
    batch (key) with their count (n)."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            digests = [digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([key_of(d) for d in digests], pa.int64()), pa.array(digests, pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary())], schema=schema)
            own = {d: s for d, s in zip(digests, sets)}
            token, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *own.values()]), return_counts=True)
            often = n >= REPORTED
            none = pa.nulls(int(often.sum()))
            yield pa.RecordBatch.from_arrays([none.cast(pa.int64()), _longs(token[often]), none.cast(pa.binary()), pa.array(n[often], pa.int64()), none.cast(pa.binary())], schema=schema)

    return docs.mapInArrow(lean(run), "id long, key long, digest binary, n long, sketch binary")


def _prefixes(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """(token, key, n): a row for each shingle of a set's prefix; n, the size, is negative where the set does not lead."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # FREQUENT numbers at most
    schema = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = shared.value
        for batch in batches:
            seen, tokens, keys, sizes = set(), [], [], []
            for text in batch.column("text").to_pylist():
                s = shingles(text, words)
                d = digest(s)
                if not len(s) or d in seen:
                    continue
                seen.add(d)
                n = len(s)
                length = n - -(-percent * n // 100) + 1
                if len(last):
                    at = np.minimum(np.searchsorted(last, s), len(last) - 1)
                    often = last[at] == s
                    rare = s[~often]
                    s = rare if len(rare) >= length else np.concatenate([rare, s[often]])
                tokens.append(s[:length])
                keys.append(np.full(length, key_of(d), np.int64))
                left = n - np.arange(length)
                sizes.append(np.where((100 + percent) * left >= 2 * percent * n, n, -n).astype(np.int32))
            if tokens:
                yield pa.RecordBatch.from_arrays([_longs(np.concatenate(tokens)), pa.array(np.concatenate(keys)), pa.array(np.concatenate(sizes))], schema=schema)

    return docs.select("text").mapInArrow(lean(run, PART_ROWS), "token long, key long, n int")


def _regions(rows: DataFrame) -> DataFrame:
    """Members of regions of two documents or more, each with the region's pivot, the smallest set that leads.  Rows come
    sorted by token, leaders and small sets first; what is held is a batch and the pivot of the open region."""
    schema = pa.schema([("token", pa.int64()), ("key", pa.int64()), ("n", pa.int32()), ("pivot", pa.int64()), ("pivot_n", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # last row, its region's pivot, and whether that pivot was given out
        for batch in batches:
            t, k, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("token", "key", "n"))
            if held is not None:
                t, k, n = np.r_[held[0], t], np.r_[held[1], k], np.r_[held[2], n].astype(np.int32)
            first = np.r_[True, t[1:] != t[:-1]]
            fresh = first | np.r_[True, k[1:] != k[:-1]]
            start = np.maximum.accumulate(np.where(first, np.arange(len(t)), 0))
            count = np.bincount(start[fresh], minlength=len(t))[start]
            keep = fresh & (count > 1) & (n[start] > 0)
            pk, pn = k[start].copy(), n[start].copy()
            given = False
            if held is not None:
                same_region = start == 0
                given = held[3]
                keep &= ~(same_region & (np.arange(len(t)) == 0) & given)
            rows = [t[keep], k[keep], n[keep], pk[keep], pn[keep]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], schema=schema)
            # the pivot of the open region leads the next batch
            s = int(start[-1])
            given = bool(count[-1] > 1) or (s == 0 and given)
            held = (t[s : s + 1], k[s : s + 1], n[s : s + 1], given)

    return rows.repartition("token").sortWithinPartitions("token", F.col("n") < 0, F.abs("n"), "key").mapInArrow(lean(run), "token long, key long, n int, pivot long, pivot_n int")


def _sketch_test(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""
    one = nodes.select(F.col("key").alias("a"), F.col("n").alias("an"), F.col("sketch").alias("s"))
    two = nodes.select(F.col("key").alias("b"), F.col("n").alias("bn"), F.col("sketch").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            an, bn = batch.column("an").to_numpy(), batch.column("bn").to_numpy()
            most = allowed(an, bn, percent)
            good = []
            for x, y, m in zip(batch.column("s").to_pylist(), batch.column("t").to_pylist(), most.tolist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                size = min(len(x), len(y))
                good.append(int(np.bitwise_count(fold(x, size) ^ fold(y, size)).sum()) <= m)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    sizes = (F.least("an", "bn") * 100 >= F.greatest("an", "bn") * percent)
    return pairs.join(one, "a").join(two, "b").filter(sizes).mapInArrow(lean(run, PART_ROWS), "a long, b long")


def _verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose sets are linked, by the sets themselves."""
    ids = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    wanted = sized(nodes.join(ids, "key", "left_semi").select(F.col("one_id").alias("wanted")).distinct())

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in batch.column("text").to_pylist()]
            keys = [key_of(digest(s)) for s in sets]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([s.tobytes() for s in sets], pa.large_binary())], ["key", "members"])

    texts = docs.join(wanted, same(F.col("id"), F.col("wanted")), "left_semi").select("text")
    sets = stored(texts.mapInArrow(lean(sets_of, PART_ROWS), "key long, members binary").dropDuplicates(["key"]))

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [
                linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())
            ]
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    one, two = sets.select(F.col("key").alias("a"), F.col("members").alias("x")), sets.select(F.col("key").alias("b"), F.col("members").alias("y"))
    return stored(pairs.join(one, "a").join(two, "b").mapInArrow(lean(test, PART_ROWS), "a long, b long"))


def _unsettled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members (token, key, n, comp) of the regions that still hold several components.  Of regions with the same
    members that with most leaders stays: shingles have one order, so its leaders are those of the others and more."""
    m = members.select("token", "key", "n").join(components(links), F.col("key") == F.col("node"), "left")
    m = stored(m.select("token", "key", "n", F.coalesce("comp", "key").alias("comp")))
    members = [F.count(F.lit(1)).alias("size"), F.bit_xor("key").alias("x"), F.bit_xor(F.xxhash64("key")).alias("y")]
    regions = m.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count_if(F.col("n") > 0).alias("leaders"), *members)
    mixed_regions = regions.filter("low <> high").groupBy("size", "x", "y").agg(F.max_by("token", F.struct("leaders", "token")).alias("token")).select("token")
    return stored(m.join(mixed_regions, "token", "left_semi"))


def _one_pivot_each(pairs: DataFrame, nodes: DataFrame, percent: int, turn: int) -> DataFrame:
    """Of the pivots (a) that a member (b) may be linked to, one."""
    tested = _sketch_test(pairs.distinct(), nodes, percent)
    return stored(tested.groupBy("b").agg(F.min_by("a", F.xxhash64("a", F.lit(turn))).alias("a")).select("a", "b"))


def _next_stars(m: DataFrame, percent: int, turn: int) -> DataFrame:
    """(a, b): each region's pivot of this turn, and the members outside its component."""
    pivot = m.groupBy("token").agg(F.min_by(F.struct("key", "n", "comp"), F.struct(F.col("n") < 0, F.xxhash64("key", F.lit(turn)))).alias("p"))
    far = m.join(pivot, "token").filter(F.col("comp") != F.col("p.comp"))
    sizes = F.least(F.abs("n"), "p.n") * 100 >= F.greatest(F.abs("n"), "p.n") * percent
    return far.filter(sizes).select(F.col("p.key").alias("a"), F.col("key").alias("b"))


def _parts(m: DataFrame, percent: int) -> DataFrame:
    """(token, grade, i, j, key, n, comp): unsettled members in the parts of their regions.  Any two of a region that are in
    different components, of sizes that can link and not both followers, share a part."""
    sizes = m.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    # sizes that can link are in one grade or the next: the larger set also visits the grade below its own
    grade = F.floor(F.log(F.abs("n").cast("double")) / max(1.01 * math.log(100 / percent), 0.01)).cast("int")
    grades = F.when(F.col("size") > PART, F.array(grade, grade - 1)).otherwise(F.array(F.lit(0)))
    rows = m.join(sizes, "token").select("token", "key", "n", "comp", F.explode(grades).alias("grade"))
    by_comp = rows.groupBy("token", "grade", "comp").agg(F.count(F.lit(1)).alias("own"), F.count_if(F.col("n") > 0).alias("leaders"))
    cells = by_comp.groupBy("token", "grade").agg(
        F.sum("own").alias("size"), F.max("own").alias("most"), F.max_by("comp", F.struct("own", "comp")).alias("main"), F.sum("leaders").alias("leaders"), F.count(F.lit(1)).alias("comps"))
    cells = cells.filter("comps > 1 AND leaders > 0").select(
        "token", "grade", "main", (F.col("size") <= PART).alias("whole"),
        F.ceil((F.col("size") - F.col("most")) / PART).cast("int").alias("k_rest"), F.ceil(F.col("most") / PART).cast("int").alias("k_main"))
    within = F.col("comp") == F.col("main")
    rows = rows.join(cells, ["token", "grade"])
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.when(within, F.col("k_main")).otherwise(F.col("k_rest")).cast("long")).cast("int"))
    pair = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    rest, main, block = F.sequence(F.lit(0), F.col("k_rest") - 1), F.sequence(F.lit(0), F.col("k_main") - 1), F.col("block")
    parts = (
        F.when(F.col("whole"), F.array(pair(F.lit(0), F.lit(0))))
        .when(within, F.transform(rest, lambda i: pair(i, F.col("k_rest") + block)))
        .otherwise(F.concat(F.transform(rest, lambda i: pair(F.least(i, block), F.greatest(i, block))), F.transform(main, lambda j: pair(block, F.col("k_rest") + j))))
    )
    return rows.select("token", "grade", "key", "n", "comp", F.explode(parts).alias("part")).select("token", "grade", "part.i", "part.j", "key", "n", "comp")


def _recursion(m: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs of unsettled members of one region that are in different components and that sketches allow."""
    rows = _parts(m, percent).join(nodes.select("key", "sketch"), "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], [], [], []]

        def pairs() -> pa.RecordBatch:
            keys, comps, sizes = (np.array(x, np.int64) for x in held[:3])
            leads, sizes = sizes > 0, np.abs(sizes)
            raw = [np.frombuffer(s, np.uint64) for s in held[3]]
            a, b = [], []
            # a sketch is as long as its set's size rounded up to a power of two; each member is compared at its own length with all
            # that are as long or longer, as far as sizes of linked sets may differ
            bits = np.array([len(r) for r in raw])
            for size in np.unique(bits).tolist():
                at = np.flatnonzero((bits >= size) & (bits * percent < size * 200))
                if len(at) > 1 and (bits[at] == size).any():
                    folded = np.stack([fold(raw[i], size) for i in at])
                    for i, j in voronoi_pairs(folded, sizes[at], comps[at], percent, leads[at]):
                        a.append(int(min(keys[at[i]], keys[at[j]])))
                        b.append(int(max(keys[at[i]], keys[at[j]])))
            found = sorted(set(zip(a, b)))
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

        part = None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("token", "grade", "i", "j", "key", "comp", "n", "sketch"))):
                if row[:4] != part:
                    if len(held[0]) > 1:
                        yield pairs()
                    part, held = row[:4], [[], [], [], []]
                for own, value in zip(held, row[4:]):
                    own.append(value)
        if len(held[0]) > 1:
            yield pairs()

    part = ["token", "grade", "i", "j"]
    dealt = rows.repartition(*part).sortWithinPartitions(*part, "key").select(*part, "key", "comp", "n", "sketch")
    return stored(dealt.mapInArrow(lean(run, PART_ROWS), "a long, b long").filter("a <> b").distinct())


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id), a row for each row: ``component_id`` is the smallest id reachable by
    links between documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more."""
    small_batches(docs.sparkSession)
    source = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    described = stored(_describe(source, words))
    rows = described.filter("digest IS NOT NULL")
    # copies meet in an aggregation; a node is a distinct set
    nodes = stored(rows.filter("n > 0").groupBy("key", "digest").agg(F.min("id").alias("one_id"), F.first("n").alias("n"), F.first("sketch").alias("sketch")))
    often = described.filter("digest IS NULL").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(FREQUENT).select("key").toPandas()
    frequent = np.sort(often["key"].to_numpy(np.int64).view(np.uint64))
    members = stored(_regions(_prefixes(source, words, percent, frequent)))
    stars = members.filter("key <> pivot AND least(abs(n), pivot_n) * 100 >= greatest(abs(n), pivot_n) * " + str(percent))
    stars = stars.select(F.col("pivot").alias("a"), F.col("key").alias("b"))
    links = _verify(_one_pivot_each(stars, nodes, percent, 0), source, nodes, words, percent)
    for turn in range(1, TURNS):
        unsettled = _unsettled(members, links)
        more = _verify(_one_pivot_each(_next_stars(unsettled, percent, turn), nodes, percent, turn), source, nodes, words, percent)
        links = links.unionByName(more)
    more = _verify(_recursion(_unsettled(members, links), nodes, percent), source, nodes, words, percent)
    comps = components(links.unionByName(more))
    named = nodes.join(comps, F.col("key") == F.col("node"), "left").select("digest", "key", "one_id", F.coalesce("comp", "key").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("one_id").alias("component_id"))
    by_set = sized(named.join(smallest, "comp").select("digest", "component_id"))
    return rows.join(by_set, "digest", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")
    )
