"""Noticing that a stream's data no longer has the stored schema."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import types as T

from tidegate.operators import schema as S
from tidegate.tables.control import SchemaRegistry
from tidegate.tables.lake import Lake


def watch_schema(lake: Lake, source_id: str, observed: T.StructType | None, batch_id: str) -> dict[str, Any] | None:
    """Compare the shape that a batch of JSON text has with the active schema; None if nothing changed.

    Changes are noted in the run log.  Added fields become a new schema version, which the batch
    itself is parsed with.  Breaking changes are only noted, and rows that no longer fit are
    judged as usual.
    """
    registry = SchemaRegistry(lake)
    row = registry.active(source_id)
    if row is None or observed is None:
        return None
    stored = S.schema_from_json(row.schema_definition)
    diff = S.drift(stored, observed)
    if not (diff["added_fields"] or diff["type_changes"] or diff["removed_fields"]):
        return None
    # only what is new: a type that no longer fits is a matter of rows, not of the schema
    widened = T.StructType([*stored.fields, *[f for f in observed if f.name in diff["added_fields"]]])
    merged, evolved, _ = S.merge_stream_schemas(stored, widened)
    if evolved:
        registry.evolve(source_id, merged, row.confidence)
    kind = "breaking" if diff["has_breaking_changes"] else "compatible"
    fields = [*diff["added_fields"], *[t["field"] for t in diff["type_changes"]], *diff["removed_fields"]]
    lake.log_run(batch_id=batch_id, source_id=source_id, mode="stream", status="schema_change", started_at=datetime.now(),
                 error=f"{kind}: {', '.join(fields)}", component="schema", attempt=1)
    return diff
