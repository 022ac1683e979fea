"""Loading one file or folder: read, settle the schema, de-duplicate, validate, write."""

from __future__ import annotations

import time
from collections.abc import Iterable
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import schema as S
from tidegate.operators.clean import fit_columns
from tidegate.operators.validate import CORRUPT
from tidegate.plans.route import Settings, judge, judge_all, merge_keys, settled, write_sinks
from tidegate.rules.model import Rule, check_rules
from tidegate.sources.files import read
from tidegate.tables.control import SchemaRegistry, SourceRegistry
from tidegate.tables.days import fold_on_new_day
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import check_batch_id

# Types of a stored schema -> the rule type text is read as.
_RULE_TYPE = {
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "int",
    T.FloatType: "float",
    T.DoubleType: "float",
    T.BooleanType: "bool",
    T.TimestampType: "datetime",
    T.DateType: "date",
}


def schema_rules(schema: T.StructType, rules: Iterable[Rule]) -> list[Rule]:
    """Warnings that read columns as their schema types, where no rule settles the type."""
    settled = {r.field_name for r in rules if r.rule_type == "type_check"}
    out = []
    for f in schema:
        target = _RULE_TYPE.get(type(f.dataType))
        if target and f.name not in settled:
            out.append(Rule(f"{f.name}_schema_type", "type_check", f.name, {"expected_type": target}, "warning"))
    return out


def load(
    lake: Lake,
    rules: Iterable[Rule | dict],
    source_id: str,
    path: str | None = None,
    *,
    df: DataFrame | None = None,
    file_format: str = "csv",
    schema: T.StructType | None = None,
    apply_schema: bool | None = None,
    evolve: bool = True,
    schema_fraction: float = 1.0,
    dry_run: bool = False,
    batch_id: str | None = None,
    settings: Settings = Settings(),
    **read_options: Any,
) -> dict[str, Any]:
    """Run one batch and return its counts.

    Text columns stay text except where rules give a type.  A schema given by hand, or a
    stored one that was not inferred, also types columns (``apply_schema`` overrides this).
    """
    checked = check_rules(rules)
    spark = lake.spark
    started, clock = datetime.now(), time.monotonic()
    batch_id = check_batch_id(batch_id or f"{source_id}-{input_id(spark, path) if path is not None else time.time_ns() // 1000}")
    source = SourceRegistry(lake).find(source_id)
    if source is not None and not source.enabled:
        raise ValueError(f"The source '{source_id}' is disabled")
    if source is not None and source.source_type == "csv_file" and file_format.lower() == "csv":
        read_options = {k: v for k, v in (source.connection_info or {}).items() if k in ("delimiter", "header", "encoding")} | read_options
    if df is None:
        if path is None:
            raise ValueError("give a path or a frame")
        if file_format.lower() == "csv":
            read_options.setdefault("infer_schema", False)
        df = read(spark, path, file_format, **read_options)

    schema_id, score, notes, known = None, None, [], schema
    registry = SchemaRegistry(lake)
    row = registry.active(source_id)
    if not dry_run:
        df, known, schema_id, score, notes = _settle_schema(registry, row, source_id, df, schema, evolve, schema_fraction)
    elif row or schema is not None:
        known = S.schema_from_json(row.schema_definition) if row else schema
        df, known, notes = fit_columns(df, known, evolve)
    by_hand = not row.inferred if row else schema is not None
    if known is not None and (apply_schema if apply_schema is not None else by_hand):
        checked = checked + schema_rules(known, checked)

    if dry_run:
        return {"batch_id": batch_id, **dry_run_summary(judge(df, checked, settings), checked), "seconds": time.monotonic() - clock}
    log_decisions(lake, source_id, batch_id, notes, known)
    try:
        fold_on_new_day(lake)
        with settled(judge_all(df, checked, settings), merge_keys(df, settings), settings.latest_by) as batch:
            counts = write_sinks(
                lake, batch, checked, source_id, batch_id, settings=settings, schema_version_id=schema_id
            )
    except Exception as e:
        lake.log_run(batch_id=batch_id, source_id=source_id, mode="batch", status="failure", started_at=started,
                     seconds=time.monotonic() - clock, error=str(e), component="batch", attempt=1)
        raise
    seconds = time.monotonic() - clock
    lake.log_run(batch_id=batch_id, source_id=source_id, mode="batch", status="success", total=counts.total,
                 valid=counts.valid, invalid=counts.invalid, duplicates=counts.duplicates, seconds=seconds,
                 events=counts.events, started_at=started, component="batch", attempt=1)
    return {
        "batch_id": batch_id,
        "total_records": counts.total,
        "valid_records": counts.valid,
        "invalid_records": counts.invalid,
        "duplicate_records": counts.duplicates,
        "schema_id": schema_id,
        "schema_confidence": score,
        "schema_changes": notes,
        "seconds": seconds,
    }


def input_id(spark: SparkSession, path: str) -> str:
    """A name for the files at a path as they are now: loading the same files again replaces what they wrote before.

    Spark lists the files; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    whole = F.sum(F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)"))
    n, total = files.agg(F.count(F.lit(1)), F.coalesce(whole, F.lit(0))).first()
    return f"{n}-{int(total) % (1 << 64):016x}"


def log_decisions(lake: Lake, source_id: str, batch_id: str, notes: list[str], schema: T.StructType | None) -> None:
    """What was decided on columns that the schema does not know, in the run log; an alert for each column whose type is in doubt."""
    for note in notes:
        lake.log_run(batch_id=batch_id, source_id=source_id, mode="batch", status="schema_decision", error=note, started_at=datetime.now(), component="schema", attempt=1)
    doubtful = S.needs_review(schema) if schema is not None else []
    if doubtful:
        rows = [(None, source_id, "type_review", f"The type of '{c}' is in doubt: loaded as text", batch_id) for c in doubtful]
        alerts = lake.spark.createDataFrame(rows, "record_id STRING, source_id STRING, rule_name STRING, message STRING, batch_id STRING").coalesce(1)
        lake.replace_partitions(alerts.withColumn("raised_at", F.current_timestamp()), "alert")


def _settle_schema(
    registry: SchemaRegistry, row: T.Row | None, source_id: str, df: DataFrame, given: T.StructType | None, evolve: bool, fraction: float
):
    """The schema this batch goes by, stored if it is new (``row``: the active one)."""
    if row is None:
        data = df.drop(CORRUPT)
        if given is not None:
            schema, score, inferred = given, None, False
        else:
            sample = data if fraction >= 1.0 else data.sample(withReplacement=False, fraction=fraction)
            schema, score, inferred = S.typed_schema(sample), S.confidence(data, fraction), True
        schema_id = registry.create(source_id, schema, inferred, score)
    else:
        schema, schema_id, score = S.schema_from_json(row.schema_definition), row.schema_id, row.confidence
    fitted, merged, notes = fit_columns(df, schema, evolve)
    if evolve and merged != schema:
        schema_id = registry.evolve(source_id, merged, score)
    return fitted, merged, schema_id, score, notes


def dry_run_summary(validated: DataFrame, rules: Iterable[Rule]) -> dict[str, Any]:
    """Counts in total and per failed rule, in one pass and without writing anything."""
    names = [r.rule_name for r in rules if r.severity == "error"]
    names += ["malformed_record", "no_valid_data", "record_id_missing"]
    good = F.col("_v.status") == "valid"
    r = validated.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("total"),
        F.count_if(good).alias("valid"),
        F.count_if(~good).alias("invalid"),
        *[F.count_if(F.array_contains("_v.failed_rules", n)).alias(f"f{i}") for i, n in enumerate(names)],
    ).first()
    failures = [{"rule_name": n, "failure_count": r[f"f{i}"]} for i, n in enumerate(names) if r[f"f{i}"]]
    failures.sort(key=lambda f: (-f["failure_count"], f["rule_name"]))
    return {
        "total_records": r.total,
        "valid_records": r.valid,
        "invalid_records": r.invalid,
        "duplicate_records": r.total - r.valid - r.invalid,
        "validation_failures_by_rule": failures,
    }
