"""The audit trail: events built as projections, and the questions asked of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.values import TYPE_NAMES, python_text, python_type_name, quoted
from tidegate.rules.model import Rule, check_rules

# Kinds of events.
TRANSFORMATIONS = (
    "type_coercion",
    "date_normalization",
    "field_trimming",
    "warehouse_write",
    "quarantine",
    "deduplication",
)


def _null() -> Column:
    return F.lit(None).cast("string")


def events(
    df: DataFrame,
    kind: str,
    *,
    record_id: Column,
    source_id: Column,
    created_at: Column,
    field_name: Column | None = None,
    old_value: Column | None = None,
    new_value: Column | None = None,
    rule_applied: Column | None = None,
) -> DataFrame:
    """One event per row of ``df``."""
    if kind not in TRANSFORMATIONS:
        raise ValueError(f"Unknown transformation type: {kind}")
    return df.select(
        record_id.alias("record_id"),
        source_id.alias("source_id"),
        F.lit(kind).alias("transformation_type"),
        (field_name if field_name is not None else _null()).alias("field_name"),
        (old_value if old_value is not None else _null()).cast("string").alias("old_value"),
        (new_value if new_value is not None else _null()).cast("string").alias("new_value"),
        (rule_applied if rule_applied is not None else _null()).alias("rule_applied"),
        created_at.alias("created_at"),
    )


def _per_field(df: DataFrame, kind: str, changes: list[tuple[str, Column, Column, Column, str]], record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    """Explode (field, happened, old, new, rule) into events, one per change."""
    base = df.select(
        record_id.alias("_r"),
        source_id.alias("_s"),
        created_at.alias("_t"),
        F.explode(
            F.array(
                *[
                    F.when(
                        happened,
                        F.struct(F.lit(name).alias("f"), old.alias("o"), new.alias("n"), F.lit(rule).alias("r")),
                    )
                    for name, happened, old, new, rule in changes
                ]
            )
        ).alias("e"),
    ).filter(F.col("e").isNotNull())
    return events(
        base, kind, record_id=F.col("_r"), source_id=F.col("_s"), created_at=F.col("_t"), field_name=F.col("e.f"),
        old_value=F.col("e.o"), new_value=F.col("e.n"), rule_applied=F.col("e.r"),
    )


def coercion_events(coerced: DataFrame, rules: Iterable[Rule], *, record_id: Column, source_id: Column, created_at: Column) -> DataFrame | None:
    """A row per value that changed its type, with the text it had; None if no field can."""
    if "_raw" not in coerced.columns:
        return None
    raw = coerced.schema["_raw"].dataType
    targets = {r.field_name: r.parameters["expected_type"] for r in check_rules(rules) if r.rule_type == "type_check"}
    changes = []
    for f in raw:
        new = quoted(f.name)
        old = F.col("_raw").getField(f.name)
        target = targets.get(f.name) or python_type_name(coerced.schema[f.name].dataType)
        shown = target if isinstance(target, str) else target.__name__
        changes.append(
            (f.name, old.isNotNull() & new.isNotNull(), python_text(old, f.dataType),
             python_text(new, coerced.schema[f.name].dataType), f"TypeValidator(target={shown})")
        )
    return _per_field(coerced, "type_coercion", changes, record_id, source_id, created_at)


def _before_events(df: DataFrame, before: str, kind: str, rule: str, record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    changes = []
    for f in df.schema[before].dataType:
        old, new = F.col(before).getField(f.name), quoted(f.name)
        changes.append((f.name, ~old.eqNullSafe(new), old.cast("string"), new.cast("string"), rule))
    return _per_field(df, kind, changes, record_id, source_id, created_at)


def date_events(df: DataFrame, output: str, *, record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    rule = f"DateNormalizer(format={output})"
    return _before_events(df, "_before_dates", "date_normalization", rule, record_id, source_id, created_at)


def trim_events(df: DataFrame, *, record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    return _before_events(df, "_before_trim", "field_trimming", "StringTrimmer", record_id, source_id, created_at)


def write_events(rows: DataFrame, schema_version_id: int | None, *, record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    new = F.lit(f"schema_version={schema_version_id}") if schema_version_id else None
    return events(rows, "warehouse_write", record_id=record_id, source_id=source_id, created_at=created_at, new_value=new)


def quarantine_events(rows: DataFrame, *, record_id: Column, source_id: Column, created_at: Column) -> DataFrame:
    """The first failed rule and its message, from rows in the quarantine layout."""
    return events(
        rows, "quarantine", record_id=F.coalesce(record_id, F.lit("unknown")), source_id=source_id, created_at=created_at,
        new_value=F.get("error_messages", F.lit(0)), rule_applied=F.get("failed_rules", F.lit(0)),
    )


def dedup_events(counts: DataFrame, source_id: str, created_at: Column) -> DataFrame:
    """One row for a batch that had duplicates, none otherwise (input: ``duplicates_removed``)."""
    return events(
        counts.filter("duplicates > 0"), "deduplication", record_id=F.lit(f"batch_{source_id}"), source_id=F.lit(source_id),
        created_at=created_at, new_value=F.concat(F.lit("duplicates_removed="), F.col("duplicates").cast("string")),
    )


def stored_form(df: DataFrame, batch_id: str) -> DataFrame:
    """Events as they are stored: with an id, the month they are partitioned by, the batch."""
    content = [c for c in df.columns if c != "created_at"]
    log_id = F.xxhash64(F.lit(batch_id), *content, *[F.col(c).isNull() for c in content], F.col("_k")).bitwiseAND(F.lit(2**63 - 1))
    # equal events are counted and numbered, so that ids do not hang on the order of rows
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    numbered = counted.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return numbered.select(
        log_id.alias("log_id"), *df.columns, F.date_format("created_at", "yyyy-MM").alias("month"), F.lit(batch_id).alias("batch_id")
    )


def counted_types() -> list[Column]:
    """Aggregates that count the events of each type while they are written."""
    return [F.count_if(F.col("transformation_type") == k).alias(k) for k in TRANSFORMATIONS]


def summary_of_runs(run_log: DataFrame, source_id: str | None = None) -> DataFrame:
    """Events per type, and in all, from the counts that each batch left in the run log: the audit log itself is not read.

    Of a batch that ran more than once the last success counts, as it replaced what the others wrote."""
    runs = run_log.filter("status = 'success' AND events IS NOT NULL")
    if source_id is not None:
        runs = runs.filter(F.col("source_id") == source_id)
    last = runs.groupBy("source_id", "mode", "batch_id").agg(F.max_by("events", "started_at").alias("events"))
    each = last.select(F.explode("events").alias("transformation_type", "n"))
    # the total is a second row of each count, so that both come from one aggregate
    named = each.select(F.explode(F.array(F.col("transformation_type"), F.lit("ALL"))).alias("transformation_type"), "n")
    return named.groupBy("transformation_type").agg(F.sum("n").alias("events"))


# -- questions ----------------------------------------------------------------------



def _top(df: DataFrame, limit: int | None) -> DataFrame:
    from tidegate.operators.quarantine import check_limit

    if limit is None:
        return df
    return df.orderBy(F.desc("created_at"), "record_id", "transformation_type", "field_name", "new_value").limit(check_limit(limit))


def in_months(audit: DataFrame, first: str, last: str) -> DataFrame:
    """Events of a range of months (``yyyy-MM``); reads only those partitions."""
    return audit.filter(F.col("month").between(first, last))


def by_record(audit: DataFrame, record_id: str, limit: int | None = 100) -> DataFrame:
    return _top(audit.filter(F.col("record_id") == record_id), limit)


def by_source(audit: DataFrame, source_id: str, limit: int | None = 1000) -> DataFrame:
    return _top(audit.filter(F.col("source_id") == source_id), limit)


def by_type(audit: DataFrame, kind: str, limit: int | None = 1000) -> DataFrame:
    return _top(audit.filter(F.col("transformation_type") == kind), limit)


def summary(audit: DataFrame, source_id: str | None = None) -> DataFrame:
    """Events and distinct records, per type and in total (type ``ALL``).

    Two combining steps instead of a distinct per group: first per (record, type), then up.
    """
    rows = audit if source_id is None else audit.filter(F.col("source_id") == source_id)
    per_record = rows.groupBy("record_id", "transformation_type").agg(F.count(F.lit(1)).alias("n"))
    by_kind = per_record.groupBy("transformation_type").agg(
        F.sum("n").alias("events"), F.count("record_id").alias("unique_records")
    )
    total = per_record.groupBy("record_id").agg(F.sum("n").alias("n")).agg(
        F.lit("ALL").alias("transformation_type"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.count("record_id").alias("unique_records"),
    )
    return by_kind.unionByName(total)


def trace(audit: DataFrame, record_id: str, limit: int | None = None) -> DataFrame:
    """The whole life of one record (or its ``limit`` newest events), oldest event first, with readable details."""
    old, new, rule = (F.nullif(F.col(c), F.lit("")) for c in ("old_value", "new_value", "rule_applied"))
    details = F.concat_ws(
        " ",
        F.when(old.isNotNull(), F.concat(F.lit("'"), old, F.lit("'"))),
        F.when(new.isNotNull() & old.isNotNull(), F.lit("→")),
        F.when(new.isNotNull(), F.concat(F.lit("'"), new, F.lit("'"))),
        F.when(rule.isNotNull(), F.concat(F.lit("("), rule, F.lit(")"))),
    )
    return (
        by_record(audit, record_id, limit)
        .select(
            "created_at",
            "transformation_type",
            F.coalesce("field_name", F.lit("-")).alias("field_name"),
            F.when(details == "", "-").otherwise(details).alias("details"),
        )
        .orderBy("created_at", "transformation_type", "field_name")
    )


def report(audit: DataFrame, source_id: str | None = None, recent: int = 10) -> tuple[DataFrame, DataFrame]:
    """Counts by type, most frequent first, and the most recent events."""
    rows = audit if source_id is None else audit.filter(F.col("source_id") == source_id)
    return summary(rows).orderBy(F.desc("events"), "transformation_type"), _top(rows, recent)


def reconcile_judged(received: DataFrame, judged: DataFrame) -> DataFrame:
    """``reconcile`` for rows judged together: the source is counted, the judged rows are read once."""
    good = F.col("_v.status") == "valid"
    parts = judged.agg(
        F.count_if(good).alias("loaded"),
        F.count_if(~good).alias("quarantined"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicates"),
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("loaded", "quarantined", "duplicates")]
    total = received.agg(F.count(F.lit(1)).alias("received")).select("received", *zero)
    stacked = total.unionByName(parts.select(F.lit(0).cast("bigint").alias("received"), "loaded", "quarantined", "duplicates"))
    wide = stacked.agg(*[F.sum(c).alias(c) for c in stacked.columns])
    return wide.withColumn("unaccounted", F.expr("received - loaded - quarantined - duplicates"))


def lost_keys(received: DataFrame, loaded: DataFrame, quarantined: DataFrame, key: str) -> DataFrame:
    """Keys that arrived and are nowhere to be found."""
    found = loaded.select(key).unionByName(quarantined.select(key))
    return received.select(key).join(found, key, "left_anti").distinct()
