"""URL filters: rules by host and path, and for all other URLs a list of blocked hosts in a Bloom filter cascade.

A single Bloom filter takes some hosts for listed ones.  As all hosts of the corpus are known, a second filter can
encode exactly those false positives, a third one the listed hosts that the second takes for false positives, and so
on until none is left.  The levels together give exact membership for every host of the corpus (and for every listed
one), in a few bits per listed host, and rows need no join: a pure map tests them.

The distinct hosts are dealt by hash into shards of about ``SHARD_KEYS`` and each shard gets a cascade of its own in
one task, so building takes one shuffle of distinct hosts, whatever their number, and no task grows with the input.
Cascades of ``BROADCAST_BYTES`` together at most are broadcast.  Beyond that each shard's cascade travels to the rows
of its shard, ahead of them in the sort order; shards with very many rows are salted.

Null URLs and those without ``://`` have an empty host and an empty path; no rule fits them and no list holds them.
Repeated rows and ids are of no account: each row is judged by itself.  An empty list blocks nothing.  Columns named
like an output column (in any case) are replaced.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import renewed, stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Distinct keys of a shard, on average.
SHARD_KEYS = 100_000
#: Bytes of all cascades up to which they are broadcast.
BROADCAST_BYTES = 64 << 20
#: Rows of a shard per task where cascades travel.
TASK_ROWS = 2_000_000
#: Rules are tried one by one; longer lists belong into the cascade.
MOST_RULES = 1000
#: Levels halve what is left; so many mean that two keys have one digest.
MOST_LEVELS = 300


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``: the host up to ``/``, ``?``, ``#`` or the end, then the path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does.  Of equally long ones the longer host
    wins, of equal ones the one that blocks."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules; lists of hosts belong into the cascade")
    ordered = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != BLOCK))
    fits = [((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path) for r in ordered]
    found = [F.when(f, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))) for f, r in zip(fits, ordered)]
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


# ---- one shard: numpy over the digests of its keys


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    """Another 64-bit hash for each level."""
    with np.errstate(over="ignore"):
        h = h ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def _places(digests: np.ndarray, level: int, hashes: int, bits: int) -> Iterator[np.ndarray]:
    start, step = _mixed(digests[:, 0], level), _mixed(digests[:, 1], level) | np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(hashes):
            yield (start + np.uint64(k) * step) % np.uint64(bits)


def _passes(digests: np.ndarray, level: int, hashes: int, bits: int, field: np.ndarray) -> np.ndarray:
    found = np.ones(len(digests), bool)
    for at in _places(digests, level, hashes, bits):
        found &= (field[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def build_levels(listed: np.ndarray, others: np.ndarray) -> bytes:
    """Levels over two disjoint sets of digests (n x 2 words of 64 bits), packed.

    The first level's rate of false positives follows the share of listed keys, all further ones take a half: then
    every level but the first has about one bit and a half for each key that it encodes."""
    share = len(listed) * math.sqrt(0.5) / max(len(others), 1)
    inside, outside, out = listed, others, []
    while len(inside):
        if len(out) == MOST_LEVELS:
            raise ValueError("two different keys have the same digest")
        hashes = max(1, round(-math.log2(min(share, 0.5)))) if not out else 1
        bits = max(8, math.ceil(len(inside) * hashes / math.log(2)))
        field = np.zeros(bits // 8 + 1, np.uint8)
        for at in _places(inside, len(out), hashes, bits):
            np.bitwise_or.at(field, at >> np.uint64(3), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        inside, outside = outside[_passes(outside, len(out), hashes, bits, field)], inside
        out.append(struct.pack("<QQ", hashes, bits) + field.tobytes())
    return b"".join(out)


class Levels:
    """A shard's cascade, unpacked."""

    def __init__(self, packed: bytes):
        self.levels, at = [], 0
        while at < len(packed):
            hashes, bits = struct.unpack_from("<QQ", packed, at)
            size = bits // 8 + 1
            self.levels.append((hashes, bits, np.frombuffer(packed, np.uint8, size, at + 16)))
            at += 16 + size

    def holds(self, digests: np.ndarray) -> np.ndarray:
        """A key that stops at an even level is not listed, at an odd one it is."""
        found, left = np.zeros(len(digests), bool), np.arange(len(digests))
        for k, (hashes, bits, field) in enumerate(self.levels):
            on = _passes(digests[left], k, hashes, bits, field)
            found[left[~on]] = k % 2 == 1
            left = left[on]
        found[left] = len(self.levels) % 2 == 1
        return found


def _words(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)


# ---- all shards: Spark deals the keys


def _digest(key: Column) -> Column:
    return F.unhex(F.substring(F.sha2(key, 256), 1, 32))


class Cascade:
    """Exact membership for all keys it was built over: one packed cascade per shard, as a stored table."""

    def __init__(self, table: DataFrame, shards: int, n_bytes: int):
        self.table, self.shards, self.n_bytes = table, shards, n_bytes

    def shard(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.shards)).cast("int")

    def mark(self, df: DataFrame, key: Column, name: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Adds ``name``: whether the key is listed (null keys are not)."""
        rows = df.select(F.struct("*").alias("row"), _digest(F.coalesce(key, F.lit(""))).alias("digest"))
        rows = rows.withColumn("shard", self.shard(F.col("digest")))
        marked = self._broadcast(rows) if self.n_bytes <= broadcast_bytes else self._carried(rows)
        return renewed(marked, df.columns, {name: F.col("listed")})

    def _broadcast(self, rows: DataFrame) -> DataFrame:
        shared = rows.sparkSession.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in self.table.collect()})

        @F.pandas_udf("boolean")
        def listed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            cascades = {k: Levels(packed) for k, packed in shared.value.items()}
            for shard, digest in batches:
                words, found = _words(digest.tolist()), np.zeros(len(digest), bool)
                for k in shard.unique():
                    if k in cascades:
                        own = (shard == k).to_numpy()
                        found[own] = cascades[k].holds(words[own])
                yield pd.Series(found)

        return rows.withColumn("listed", listed("shard", "digest"))

    def _carried(self, rows: DataFrame) -> DataFrame:
        """Rows meet their shard's cascade, which is sorted ahead of them; both are dealt by shard and salt."""
        large = rows.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > TASK_ROWS)
        salts = {r["shard"]: r["n"] // TASK_ROWS + 1 for r in large.collect()}  # at most one for each TASK_ROWS rows
        known = F.create_map(*[F.lit(x) for kv in salts.items() for x in kv]) if salts else None
        n_salts = F.lit(1) if known is None else F.coalesce(known[F.col("shard")], F.lit(1))
        empty = F.lit(None).cast(rows.schema["row"].dataType).alias("row")
        ahead = self.table.select("shard", F.explode(F.sequence(F.lit(0), n_salts.cast("int") - 1)).alias("salt"), "cascade", empty, F.lit(None).cast("binary").alias("digest"))
        salt = F.when(n_salts > 1, F.pmod(F.xxhash64(F.to_json("row")), n_salts.cast("long"))).otherwise(0).cast("int")
        behind = rows.select("shard", salt.alias("salt"), F.lit(None).cast("binary").alias("cascade"), "row", "digest")
        both = ahead.unionByName(behind).repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.col("cascade").isNull())

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, levels = None, None
            for batch in batches:
                shards = batch.column("shard").to_numpy(zero_copy_only=False)
                packed = batch.column("cascade")
                digests = batch.column("digest").to_pylist()
                found = np.zeros(len(shards), bool)
                cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(shards)]
                for a, b in zip(cuts, cuts[1:]):
                    if a < b and shards[a] != of:
                        of, levels = shards[a], None
                    own = [k for k in range(a, b) if digests[k] is not None]
                    for k in range(a, b):
                        if digests[k] is None:
                            levels = Levels(packed[k].as_py())
                    if levels is not None and own:
                        found[own] = levels.holds(_words([digests[k] for k in own]))
                rows = pa.array([d is not None for d in digests])
                out = pa.RecordBatch.from_arrays([batch.column("row"), pa.array(found)], ["row", "listed"])
                yield out.filter(rows)

        schema = rows.select("row").schema.add("listed", "boolean")
        return both.mapInArrow(judged, schema)


def build_cascade(universe: DataFrame, listed: DataFrame, shard_keys: int = SHARD_KEYS) -> Cascade:
    """A cascade for the keys in the first column of ``listed``, exact over those in the first column of ``universe`` and over
    the listed ones.  Null keys count as empty ones; an empty key is never listed."""
    keys = universe.select(F.coalesce(universe[0].cast("string"), F.lit("")).alias("key"), F.lit(False).alias("listed"))
    keys = keys.unionByName(listed.select(F.coalesce(listed[0].cast("string"), F.lit("")).alias("key"), F.lit(True).alias("listed")))
    keys = keys.groupBy("key").agg((F.max("listed") & (F.col("key") != "")).alias("listed"))
    keys = stored(keys.select(_digest(F.col("key")).alias("digest"), "listed"))
    cascade = Cascade(keys, 1 << max(0, math.ceil(math.log2(max(1, keys.count()) / shard_keys))), 0)

    def built(rows: pd.DataFrame) -> pd.DataFrame:
        words, on = _words(rows["digest"].tolist()), rows["listed"].to_numpy(bool)
        return pd.DataFrame({"shard": [rows["shard"].iloc[0]], "cascade": [build_levels(words[on], words[~on])]})

    dealt = keys.withColumn("shard", cascade.shard(F.col("digest")))
    cascade.table = stored(dealt.groupBy("shard").applyInPandas(built, "shard int, cascade binary"))
    cascade.n_bytes = cascade.table.agg(F.sum(F.octet_length("cascade"))).first()[0] or 0
    return cascade


def filter_urls(df: DataFrame, rules: list[Rule], listed: DataFrame, url: str = "url", broadcast_bytes: int = BROADCAST_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (its host and path, or null) and ``verdict``: the rule's, else ``block`` if the host is
    in the first column of ``listed``, else ``allow``."""
    host, path = host_and_path(F.coalesce(F.col(url), F.lit("")))
    cascade = build_cascade(df.select(host.alias("host")), listed, shard_keys)
    inner = df.select(F.struct("*").alias("input"), host.alias("host"), path.alias("path"))
    marked = cascade.mark(inner, F.col("host"), "on_list", broadcast_bytes)
    found = marked.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)).withColumnRenamed("input", "row")
    verdict = F.coalesce("found.verdict", F.when(F.col("on_list"), BLOCK).otherwise(ALLOW))
    return renewed(found, df.columns, {"host": F.col("host"), "path": F.col("path"), "rule": F.col("found.rule"), "verdict": verdict})
