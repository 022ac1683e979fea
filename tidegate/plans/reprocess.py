"""Trying quarantined rows again with the rules of today."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import lineage, quarantine
from tidegate.operators.schema import schema_from_json
from tidegate.plans.route import Counts, Settings, judge_all, settled
from tidegate.rules.model import Rule, check_rules
from tidegate.sources.files import parse_objects, with_corrupt_column
from tidegate.sources.streams import text_schema
from tidegate.tables.control import SchemaRegistry
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, order_key, warehouse_rows


def quarantined_records(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """Quarantined payloads as columns again, with the row key in ``_q_*`` columns."""
    keyed = rows.select(*[F.col(c).alias(f"_q_{c}") for c in quarantine.ROW_KEY], "raw_payload")
    return parse_objects(keyed, "raw_payload", with_corrupt_column(schema))


def revalidate(rows: DataFrame, schema: T.StructType, rules: Iterable[Rule], settings: Settings = Settings()) -> DataFrame:
    """Quarantined rows judged as a load judges them."""
    return judge_all(quarantined_records(rows, schema), rules, settings)


def view(lake: Lake, since: str | None = None) -> DataFrame:
    """The quarantine with its marks; of folded days only those from ``since`` (``yyyy-MM-dd``) on."""
    return quarantine.current_view(lake.read("quarantine_record", since), lake.read("quarantine_event", since))


def mark(lake: Lake, event: str, rows: DataFrame) -> int:
    """Record an event for rows of the view and return how many there were."""
    seen = Observation()
    targets = quarantine.event_rows(rows, event).withColumn("event_batch", F.lit(f"{event}-{time.time_ns() // 1000}"))
    lake.replace_partitions(targets.observe(seen, F.count(F.lit(1)).alias("n")), "quarantine_event")
    return seen.get["n"]


def reprocess(
    lake: Lake,
    rules: Iterable[Rule | dict],
    source_id: str,
    *,
    schema: T.StructType | None = None,
    record_ids: Iterable[str] | DataFrame | None = None,
    error_types: Iterable[str] | None = None,
    limit: int | None = None,
    batch_id: str | None = None,
    settings: Settings = Settings(),
) -> dict[str, Any]:
    """Validate open quarantine rows again: good ones go to the warehouse and are marked done."""
    checked, started, clock = check_rules(rules), datetime.now(), time.monotonic()
    stored = SchemaRegistry(lake).active(source_id)
    if schema is None:
        if stored is None:
            raise ValueError(f"No schema is stored for source '{source_id}'")
        schema = schema_from_json(stored.schema_definition)
    batch_id = batch_id or f"reprocess-{time.time_ns() // 1000}"
    rows = quarantine.fetch(view(lake), source_id, record_ids, error_types, limit)
    fields = {"batch_id": batch_id, "source_id": source_id, "mode": "reprocess", "started_at": started, "component": "reprocess", "attempt": 1}
    try:
        counts = _reprocess(lake, rows, schema, stored.schema_id if stored else None, checked, source_id, batch_id, settings)
    except Exception as e:
        lake.log_run(**fields, status="failure", error=str(e), seconds=time.monotonic() - clock)
        raise
    seconds = time.monotonic() - clock
    lake.log_run(**fields, status="success", total=counts.total, valid=counts.valid, invalid=counts.invalid, duplicates=counts.duplicates, seconds=seconds)
    return {
        "total_reprocessed": counts.total,
        "success_count": counts.valid + counts.duplicates,
        "failed_count": counts.invalid,
        "duplicate_count": counts.duplicates,
        "duration_seconds": seconds,
    }


def _reprocess(
    lake: Lake, rows: DataFrame, schema: T.StructType, version: int | None, rules: list[Rule], source_id: str, batch_id: str, settings: Settings
) -> Counts:
    """All rows that pass are done; of several with one id the newest is loaded, and only if the warehouse has none that is newer."""
    judged = revalidate(rows, text_schema(schema), rules, settings)
    by = [c for c in settings.latest_by if c in judged.columns]
    judged = judged.withColumn("_version", order_key(judged, by, schema))
    with settled(judged, [["_rid"]], ["_version"]) as batch:
        if batch.counts.valid:
            good, at = batch.good.drop("_corrupt_record"), F.current_timestamp()
            packed = warehouse_rows(
                good, source_id, version, record_id=F.col("_rid"), order=F.col("_version")
            )
            Warehouse(lake).append(packed, batch_id, unique=True, count=False)
            trail = lineage.write_events(good, version, record_id=F.col("_rid"), source_id=F.lit(source_id), created_at=at)
            lake.replace_partitions(lineage.stored_form(trail, batch_id), "audit_log")
            done = batch.valid.select(*[F.col(f"_q_{c}").alias(c) for c in quarantine.ROW_KEY])
            lake.replace_partitions(quarantine.event_rows(done, "reprocessed").withColumn("event_batch", F.lit(batch_id)), "quarantine_event")
            if Warehouse(lake).fold_is_due():
                Warehouse(lake).compact()
        return batch.counts
