"""Progress of streaming queries as rows, kept in a table of the lake."""

from __future__ import annotations

import json
import threading
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tidegate.tables.lake import SCHEMAS, Lake

TABLE = "stream_progress"
NAMES = tuple(part.split()[0] for part in SCHEMAS[TABLE].split(","))


def _offset_sum(offset: Any) -> int | None:
    """All numbers of an offset added up: a number, or topics with partitions with numbers."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset.replace("'", '"'))
        except ValueError:
            return None
    if isinstance(offset, bool) or offset is None:
        return None
    if isinstance(offset, int):
        return offset
    if isinstance(offset, dict):
        parts = [_offset_sum(v) for v in offset.values()]
        return None if None in parts or not parts else sum(parts)
    return None


def lag_of(sources: Iterable[dict]) -> int | None:
    """How many offsets the sources hold beyond what the batch has read; null if none of them tells its newest offset."""
    behind = []
    for s in sources:
        newest, read = _offset_sum(s.get("latestOffset")), _offset_sum(s.get("endOffset"))
        if newest is not None and read is not None:
            behind.append(max(0, newest - read))
    return sum(behind) if behind else None


def _row(p: dict) -> tuple:
    # the progress JSON leaves rates out when they are not numbers
    rate, done = float(p.get("inputRowsPerSecond") or 0.0), float(p.get("processedRowsPerSecond") or 0.0)
    at = datetime.fromisoformat(p["timestamp"].replace("Z", "+00:00")).astimezone(timezone.utc)
    return (
        str(p["id"]), str(p["runId"]), p.get("name"), p["batchId"], at, p["numInputRows"], rate, done,
        p.get("durationMs", {}).get("triggerExecution"), rate > done > 0.0, lag_of(p.get("sources", ())), f"{at:%Y-%m-%d}",
    )


def as_row(p: dict) -> dict:
    """One progress report under the column names of the table."""
    return dict(zip(NAMES, _row(p)))


def progress_frame(spark: SparkSession, query) -> DataFrame:
    """The reports that the query itself still holds (Spark keeps the last 100)."""
    return spark.createDataFrame([_row(p) for p in query.recentProgress], SCHEMAS[TABLE])


class ProgressLog(StreamingQueryListener):
    """Writes the reports of all queries of a session to the lake, so that none is lost to the limits of the driver's memory.

    Reports are gathered and written ``every`` at a time, and when a query ends, by a thread of their own: the listener itself
    never waits for a write.  Use it as a context, or call ``stop``."""

    def __init__(self, lake: Lake, every: int = 50):
        self.lake, self.every = lake, every
        self._rows: list[tuple] = []
        self._running: set[str] = set()
        self._changed = threading.Condition()
        self._writer = ThreadPoolExecutor(1)
        self._writes: list = []

    # -- as a listener
    def onQueryStarted(self, event) -> None:
        with self._changed:
            self._running.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self._changed:
            self._rows.append(_row(json.loads(event.progress.json)))
            if len(self._rows) >= self.every:
                self._hand_over()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self._changed:
            self._hand_over()
            self._running.discard(str(event.runId))
            self._changed.notify_all()

    def _hand_over(self) -> None:
        if self._rows:
            self._writes.append(self._writer.submit(self._write, self._rows))
            self._rows = []

    def _write(self, rows: list[tuple]) -> None:
        self.lake.append(self.lake.spark.createDataFrame(rows, SCHEMAS[TABLE]).coalesce(1), TABLE)

    # -- by its user
    def start(self) -> ProgressLog:
        self.lake.spark.streams.addListener(self)
        return self

    def flush(self, timeout: float = 30.0) -> None:
        """Waits until the reports of all ended queries are written; an error of a write is raised here."""
        live = {str(q.runId) for q in self.lake.spark.streams.active}
        with self._changed:
            self._changed.wait_for(lambda: not self._running - live, timeout)
            self._hand_over()
            writes, self._writes = self._writes, []
        for done in writes:
            done.result()

    def stop(self) -> None:
        try:
            self.flush()
        finally:
            self.lake.spark.streams.removeListener(self)

    __enter__ = start

    def __exit__(self, *error) -> None:
        self.stop()


def totals(progress: DataFrame) -> DataFrame:
    """Per query: batches, rows read, the greatest lag and the last one, and the share of batches in which input outran processing."""
    last: Column = F.max_by("lag", F.struct("at", "batch_id"))
    return progress.dropDuplicates(["run_id", "batch_id", "at"]).groupBy("query_id").agg(
        F.first("query_name", ignorenulls=True).alias("query_name"),
        F.count_distinct("batch_id").alias("batches"),
        F.sum("input_rows").alias("input_rows"),
        F.max("lag").alias("max_lag"),
        last.alias("lag"),
        F.avg(F.col("backpressure").cast("int")).alias("backpressure"),
    )
