"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import suppress
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.session import shared_folder

#: ASCII white space; other white space counts as part of words.
SPACES = " \t\n\x0b\x0c\r"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once as Parquet below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: later jobs read files that all executors share, so a lost executor costs
    a re-read and values that hang on row order (row ids) are fixed from here on.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that a side may have to be broadcast: with the short keys it is used for, some tens of MB.
BROADCAST_ROWS = 500_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS, weight: Column | None = None) -> DataFrame:
    """The rows, stored and counted (by ``weight``, if rows hold arrays); hinted for broadcast only
    if they count ``most`` at most, so that beyond it the join shuffles (and AQE splits hot keys)."""
    df = stored(df)
    size = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if size <= most else df


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def hex_sha256(column: Column) -> Column:
    return F.sha2(column, 256)


def same(left: Column, right: Column) -> Column:
    """Null-safe equality."""
    return left.eqNullSafe(right)


def renewed(df: DataFrame, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """The input's ``columns`` out of the struct ``row``, and ``results``, which replace columns of their name in any case.

    An operator that packs its input into ``row`` first may name its own columns as it likes."""
    new = {name.lower() for name in results}
    rest = [F.col(f"row.`{c}`").alias(c) for c in columns if c.lower() not in new]
    return df.select(*rest, *[column.alias(name) for name, column in results.items()])


_kept: dict[Hashable, Any] = {}


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, kept by the worker process for its next task.  Only one thing is kept: workers serve
    all operators of a session in turn, and what each of them leaves behind would add up."""
    if key not in _kept:
        _kept.clear()
        _kept[key] = make()
    return _kept[key]


#: Bytes of rows that go to a Python worker at once (one longer row is a batch of its own), and Spark's own limit.
BATCH_BYTES = "4m"
SPARK_BATCH_BYTES = "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Has Arrow batches end at ``BATCH_BYTES`` in this session.

    At 64 MB each running task holds that much several times over: outside the JVM's heap, where the buffer doubles while it
    grows, and in its worker, as Arrow data and as strings.  A limit set by the user is left alone.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, SPARK_BATCH_BYTES) == SPARK_BATCH_BYTES:
        spark.conf.set(key, BATCH_BYTES)


#: Characters of texts that are worked on together in a Python worker, and rows.
PART_CHARS, PART_ROWS = 1_000_000, 500


def parts(texts: pd.Series) -> Iterator[list[str]]:
    """A batch of texts in pieces, so that results leave the worker before the whole batch is done (a single long text is a piece)."""
    part: list[str] = []
    chars = 0
    for text in texts:
        part.append(text)
        chars += len(text or "")
        if chars > PART_CHARS or len(part) == PART_ROWS:
            yield part
            part, chars = [], 0
    if part:
        yield part


def free() -> None:
    """Hands memory that the worker process no longer uses back to the machine; allocators keep it otherwise, and the workers of an
    executor hold what each of them needed at its worst."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def release() -> None:
    """Drops what ``kept`` holds: the operator that starts now has no use for it."""
    _kept.clear()
    free()


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int | None = None):
    """A function for ``mapInArrow`` in a worker without leftovers, before and after; with ``rows`` it gets batches of so many at most."""

    def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, rows or max(1, batch.num_rows)):
                yield batch.slice(k, rows) if rows else batch

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        yield from run(small(batches))
        free()

    return wrapped
