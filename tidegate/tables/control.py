"""Registered sources, stored rules and schema versions.

These tables are as small as the configuration they hold.  They are append-only: a change
is a new revision and readers take the newest, so no file is ever rewritten.
"""

from __future__ import annotations

import json
from datetime import datetime
from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import schema as S
from tidegate.rules.loader import load_rule
from tidegate.rules.model import Rule, check_rules
from tidegate.tables.lake import SCHEMAS, Lake

# Source types and the connection fields each one starts with.
SOURCE_TYPES = {
    "csv_file": {"delimiter": ",", "header": "true", "encoding": "utf-8"},
    "kafka_topic": {"starting_offsets": "latest"},
    "json_stream": {"format": "json", "max_files_per_trigger": "10"},
    "api_endpoint": {},
}


class SourceRegistry:
    def __init__(self, lake: Lake):
        self.lake = lake

    def register(self, source_id: str, source_type: str, connection_info: dict[str, str] | None = None, enabled: bool = True) -> None:
        if source_type not in SOURCE_TYPES:
            raise ValueError(f"Unknown source type '{source_type}': one of {', '.join(SOURCE_TYPES)}")
        if not source_id or len(source_id) > 255:
            raise ValueError("source_id must have 1 to 255 characters")
        if self.all().filter(F.col("source_id") == source_id).limit(1).count():
            raise ValueError(f"Source '{source_id}' is already registered")
        info = {**SOURCE_TYPES[source_type], **(connection_info or {})}
        row = self.lake.spark.createDataFrame(
            [(source_id, source_type, None, info, enabled, None, None, None)], SCHEMAS["data_source"]
        )
        now = F.current_timestamp()
        self.lake.revise(row.withColumns({"created_at": now, "updated_at": now}), "data_source")

    def all(self) -> DataFrame:
        return self.lake.current("data_source").drop("_rev")

    def find(self, source_id: str) -> T.Row | None:
        """One source; None if it is not registered."""
        if not self.lake.has("data_source"):
            return None
        return self.all().filter(F.col("source_id") == source_id).first()

    def enabled(self) -> DataFrame:
        return self.all().filter("enabled")

    def unregistered(self, df: DataFrame) -> DataFrame:
        """Rows whose source is not registered (the foreign-key check)."""
        return df.join(self.all().select("source_id"), "source_id", "left_anti")


class RuleTable:
    def __init__(self, lake: Lake):
        self.lake = lake

    def all(self) -> DataFrame:
        return self.lake.current("validation_rule").drop("_rev")

    def add(self, rules: Iterable[Rule]) -> int:
        rules = list(rules)
        check_rules(rules)
        functions = [r.rule_name for r in rules if callable(r.parameters.get("validator_func"))]
        if functions:
            raise ValueError(f"A Python function cannot be stored in a table: {', '.join(functions)}")
        names = [r.rule_name for r in rules]
        clash = self.all().filter(F.col("rule_name").isin(names)).select("rule_name").limit(1).collect()
        if clash or len(set(names)) != len(names):
            raise ValueError(f"Rule name already in use: {clash[0][0] if clash else 'given twice'}")
        first = self.lake.next_id("validation_rule", "rule_id")
        rows = []
        for i, r in enumerate(rules):
            name, kind, field, params, severity, enabled = r.row()
            rows.append((first + i, name, kind, field, params, enabled, severity, None, None))
        frame = self.lake.spark.createDataFrame(rows, SCHEMAS["validation_rule"])
        self.lake.revise(frame.withColumn("created_at", F.current_timestamp()), "validation_rule")
        return len(rows)

    def add_from_file(self, path: str) -> int:
        return self.add([load_rule(path)])

    def update(self, rule_id: int, parameters: dict[str, Any] | None = None, enabled: bool | None = None) -> int:
        """Number of rules changed (0 if there is no such rule)."""
        if parameters is None and enabled is None:
            raise ValueError("give parameters or enabled")
        changed = self.lake.current("validation_rule").filter(F.col("rule_id") == rule_id)
        if parameters is not None:
            changed = changed.withColumn("parameters", F.lit(json.dumps(parameters, sort_keys=True)))
        if enabled is not None:
            changed = changed.withColumn("enabled", F.lit(enabled))
        stored = changed.limit(1).collect()
        if not stored:
            return 0
        check_rules([_to_rule(stored[0])])
        self.lake.revise(self.lake.spark.createDataFrame(stored, SCHEMAS["validation_rule"]), "validation_rule")
        return 1

    def disable(self, rule_id: int) -> int:
        return self.update(rule_id, enabled=False)

    def rules(self) -> list[Rule]:
        """The stored rules in the order they were added; a rule list is configuration-sized."""
        return [_to_rule(r) for r in self.all().orderBy("rule_id").collect()]


def _to_rule(row: T.Row) -> Rule:
    return Rule(row.rule_name, row.rule_type, row.field_name, json.loads(row.parameters or "{}"), row.severity, row.enabled)


class SchemaRegistry:
    def __init__(self, lake: Lake):
        self.lake = lake

    def versions(self) -> DataFrame:
        return self.lake.current("schema_version").drop("_rev")

    def create(self, source_id: str, schema: T.StructType, inferred: bool = True, confidence: float | None = None) -> int:
        """Store the next version for a source and return its id."""
        if confidence is not None and not 0.0 <= confidence <= 1.0:
            raise ValueError(f"Confidence must be between 0.0 and 1.0, got {confidence}")
        own = F.when(F.col("source_id") == source_id, F.col("version"))
        last = self.lake.read("schema_version").agg(*[F.coalesce(F.max(c), F.lit(0)).alias(n) for n, c in (("id", F.col("schema_id")), ("version", own), ("rev", F.col("_rev")))]).first()
        row = (last.id + 1, source_id, last.version + 1, schema.json(), inferred, confidence, datetime.now(), None, last.rev + 1)
        self.lake.append(self.lake.spark.createDataFrame([row], SCHEMAS["schema_version"]).coalesce(1), "schema_version")
        return row[0]

    def active(self, source_id: str) -> T.Row | None:
        """Newest version that is not deprecated."""
        if not self.lake.has("schema_version"):
            return None
        found = S.active_schemas(self.versions().filter(F.col("source_id") == source_id)).collect()
        return found[0] if found else None

    def get(self, source_id: str, version: int | None = None) -> T.StructType | None:
        """One stored schema; no version means the active one."""
        if version is None:
            row = self.active(source_id)
        else:
            wanted = (F.col("source_id") == source_id) & (F.col("version") == version)
            row = next(iter(self.versions().filter(wanted).collect()), None)
        return S.schema_from_json(row.schema_definition) if row else None

    def deprecate(self, source_id: str, version: int) -> None:
        live = (F.col("source_id") == source_id) & (F.col("version") == version) & F.col("deprecated_at").isNull()
        rows = self.lake.current("schema_version").filter(live).collect()
        if rows:
            frame = self.lake.spark.createDataFrame(rows, SCHEMAS["schema_version"])
            self.lake.revise(frame.withColumn("deprecated_at", F.current_timestamp()), "schema_version")

    def history(self, source_id: str, limit: int = 10) -> DataFrame:
        return S.schema_history(self.versions(), source_id, limit)

    def get_or_infer(
        self, source_id: str, sample: DataFrame | None = None, sample_path: str | None = None, fraction: float = 0.1
    ) -> tuple[T.StructType, int, float | None]:
        """The active schema, or one inferred from a sample and stored: schema, id, confidence."""
        row = self.active(source_id)
        if row:
            return S.schema_from_json(row.schema_definition), row.schema_id, row.confidence
        if sample_path:
            schema, confidence = S.infer_from_csv(self.lake.spark, sample_path)
        elif sample is not None:
            schema, confidence = S.infer_from_frame(sample, fraction)
        else:
            raise ValueError(f"No schema is stored for source '{source_id}' and there is no sample to infer one from")
        return schema, self.create(source_id, schema, True, confidence), confidence

    def evolve(self, source_id: str, new: T.StructType, confidence: float | None = None) -> int:
        """Store a changed schema; an incompatible change retires the old version."""
        row = self.active(source_id)
        if row:
            diff = S.compare_schemas(S.schema_from_json(row.schema_definition), new)
            if not (diff["added_fields"] or diff["removed_fields"] or diff["type_changes"]):
                return row.schema_id
            if not diff["compatible"]:
                self.deprecate(source_id, row.version)
        return self.create(source_id, new, True, confidence)
