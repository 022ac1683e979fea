"""One streaming query from a source to the tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator
from datetime import datetime
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.values import quoted
from tidegate.operators import schema as S
from tidegate.plans.route import Settings, judge_all, merge_keys, observed_copy, settled, write_sinks
from tidegate.rules.model import Rule, check_rules
from tidegate.sources.files import parse_objects, with_corrupt_column
from tidegate.streaming.alerts import range_alerts
from tidegate.streaming.drift import watch_schema
from tidegate.streaming.progress import as_row
from tidegate.tables.control import SchemaRegistry
from tidegate.tables.days import fold_on_new_day
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, check_batch_id


#: Batches in the warehouse log after which a stream folds it, if it is not told how often to.
MOST_WAITING = 100


class StreamJob:
    """Judges each micro-batch once and writes all tables from it.

    Batch ids come from the query's own epoch numbers, and every write replaces the partitions
    of its batch: a batch replayed after a failure leaves nothing twice.
    """

    def __init__(
        self,
        lake: Lake,
        rules: Iterable[Rule | dict],
        source_id: str,
        checkpoint: str,
        *,
        settings: Settings = Settings(),
        schema_version_id: int | None = None,
        max_consecutive_failures: int = 10,
        retry_delay: float = 5.0,
        compact_every: int | None = None,
        alerts: bool = False,
        raw_column: str | None = None,
        schema: T.StructType | None = None,
    ):
        """With ``raw_column`` the stream brings JSON text in that column.

        Each batch is then compared with the stored schema before it is parsed with
        ``schema`` (the stored one by default).
        """
        self.lake = lake
        self.rules = check_rules(rules)
        self.source_id = check_batch_id(source_id)
        self.checkpoint = checkpoint
        self.settings = settings
        self.schema_version_id = schema_version_id
        self.max_failures = max_consecutive_failures
        self.retry_delay = retry_delay
        self.compact_every = compact_every
        self.alerts = alerts
        self.raw_column = raw_column
        self.schema = schema
        if raw_column and schema is None:
            self.schema = SchemaRegistry(lake).get(source_id)
            if self.schema is None:
                raise ValueError(f"No schema is stored for source '{source_id}'")
        self.query = None

    # -- one micro-batch ---------------------------------------------------------------
    def process(self, batch: DataFrame, epoch: int) -> None:
        failures = 0
        while True:
            started, clock = datetime.now(), time.monotonic()
            fields = {"batch_id": self._batch_id(epoch), "source_id": self.source_id, "mode": "stream", "started_at": started,
                      "component": "stream", "attempt": failures + 1}
            lake = Lake(batch.sparkSession, self.lake.root, self.lake.buckets)
            try:
                counts = self._write(lake, batch, epoch)
            except Exception as e:
                failures += 1
                lake.log_run(**fields, status="failure", error=str(e), seconds=time.monotonic() - clock)
                if failures >= self.max_failures:
                    raise
                time.sleep(min(self.retry_delay * 2 ** (failures - 1), 60.0))
                continue
            lake.log_run(**fields, status="success", total=counts.total, valid=counts.valid, invalid=counts.invalid,
                         duplicates=counts.duplicates, events=counts.events, seconds=time.monotonic() - clock)
            return

    def _batch_id(self, epoch: int) -> str:
        return f"{self.source_id}-{epoch:012d}"

    def _write(self, lake: Lake, batch: DataFrame, epoch: int):
        fold_on_new_day(lake)
        data = batch.drop("source_id")
        if not self.raw_column:
            return self._route(lake, data, epoch)
        with observed_copy(data, shape=S.shape_of(F.col(self.raw_column))) as (raw, seen):
            if watch_schema(lake, self.source_id, S.schema_of_shape(seen["shape"]), self._batch_id(epoch)):
                # parsing is per batch, so new fields count from the batch that brings them
                self.schema = SchemaRegistry(lake).get(self.source_id) or self.schema
            return self._route(lake, parse_objects(raw, self.raw_column, with_corrupt_column(self.schema)), epoch)

    def _route(self, lake: Lake, data: DataFrame, epoch: int):
        batch_id = self._batch_id(epoch)
        with settled(judge_all(data, self.rules, self.settings), merge_keys(data, self.settings), self.settings.latest_by) as rows:
            # A stream only appends; folding into the base is a separate, rarer step.
            counts = write_sinks(
                lake, rows, self.rules, self.source_id, batch_id, settings=self.settings,
                schema_version_id=self.schema_version_id, compact=False,
            )
            if self.alerts and counts.invalid:
                lake.replace_partitions(range_alerts(rows.bad, self.rules, self.source_id, batch_id), "alert")
        if (epoch + 1) % self.compact_every == 0 if self.compact_every else Warehouse(lake).batches_waiting() >= MOST_WAITING:
            Warehouse(lake).compact()
        return counts

    # -- the query ---------------------------------------------------------------------
    def start(self, stream: DataFrame, *, processing_time: str = "10 seconds", available_now: bool = False, name: str | None = None):
        if self.query is not None and self.query.isActive:
            raise RuntimeError(f"The stream for '{self.source_id}' is already running")
        writer = stream.writeStream.foreachBatch(self.process).option("checkpointLocation", self.checkpoint)
        if name:
            writer = writer.queryName(name)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
        self.query = writer.start()
        return self.query

    def status(self) -> dict[str, Any]:
        """Where the job stands; to stop or to wait, use ``query`` itself."""
        state = "not_started" if self.query is None else "active" if self.query.isActive else "stopped"
        last = self.query.lastProgress if self.query is not None else None
        return {"status": state, "source_id": self.source_id, "checkpoint": self.checkpoint, "last": as_row(last) if last else None}


def active_streams(spark: SparkSession) -> list[dict[str, Any]]:
    return [{"id": str(q.id), "name": q.name, "active": q.isActive, "message": q.status["message"]} for q in spark.streams.active]


def stop_stream(spark: SparkSession, id_or_name: str) -> bool:
    """Stop a running query by id or name; False if there is none."""
    for q in spark.streams.active:
        if id_or_name in (str(q.id), q.name):
            q.stop()
            return True
    return False


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: state larger than memory."""
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )


def first_of_batch(key: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the first row per key of each Arrow batch: a hot key sends few rows through the shuffle."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table({"k": batch.column(batch.schema.get_field_index(key)), "at": np.arange(batch.num_rows)})
            first = rows.group_by("k").aggregate([("at", "min")])["at_min"]
            yield batch.take(pa.array(np.sort(first.to_numpy())))

    return keep


def stream_dedup(stream: DataFrame, key: str, ts: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key within the watermark; rows without a key pass.

    Repeats within a batch of rows are dropped before the shuffle.  A key's state is its expiry, and it goes
    when the watermark passes ``delay`` after the row.  Rows without a key pass beside the state, by a second
    look at the source.
    """
    key = key if key in stream.columns else next(c for c in stream.columns if c.lower() == key.lower())
    has_key = quoted(key).isNotNull()
    keyed = stream.filter(has_key).mapInArrow(first_of_batch(key), stream.schema)
    return (
        keyed.withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark([key])
        .unionByName(stream.filter(~has_key).withWatermark(ts, delay))
    )
