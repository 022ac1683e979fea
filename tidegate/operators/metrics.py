"""Quality and throughput numbers as ordinary queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Upper bounds of the histograms, smallest first.
BUCKETS = {
    "processing_duration_seconds": [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0, 120.0],
    "record_latency_seconds": [0.001, 0.005, 0.01, 0.05, 0.1, 0.5, 1.0, 2.0],
    "streaming_latency_seconds": [0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0],
    "streaming_batch_size": [1, 10, 50, 100, 500, 1000, 5000, 10000],
    "batch_size_records": [100, 500, 1000, 5000, 10000, 50000, 100000, 500000],
    "warehouse_write_seconds": [0.01, 0.05, 0.1, 0.5, 1.0, 5.0, 10.0],
}


def records_by_status(validated: DataFrame, source: Column, result: str = "_v") -> DataFrame:
    return validated.groupBy(source.alias("source_id"), F.col(f"{result}.status").alias("status")).count()


def failures_by_rule(validated: DataFrame, rules: DataFrame, result: str = "_v") -> DataFrame:
    """How often each error rule failed, with its type and field."""
    return _by_rule(validated, rules, f"{result}.failed_rules")


def warnings_by_rule(validated: DataFrame, rules: DataFrame, result: str = "_v") -> DataFrame:
    return _by_rule(validated, rules, f"{result}.warnings")


def _by_rule(validated: DataFrame, rules: DataFrame, names: str) -> DataFrame:
    # counted first, so the join sees one row per rule
    counted = validated.select(F.explode(names).alias("rule_name")).groupBy("rule_name").agg(F.count(F.lit(1)).alias("n"))
    described = rules.select("rule_name", "rule_type", "field_name")
    return counted.join(described, "rule_name", "left").select("rule_name", "rule_type", "field_name", "n")


def failures_by_type_and_field(validated: DataFrame, rules: DataFrame, source: Column, result: str = "_v") -> DataFrame:
    counted = (
        validated.select(source.alias("source_id"), F.explode(f"{result}.failed_rules").alias("rule_name"))
        .groupBy("source_id", "rule_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    described = rules.select("rule_name", "rule_type", "field_name")
    return counted.join(described, "rule_name", "left").groupBy("source_id", "rule_type", "field_name").agg(F.sum("n").alias("n"))


def warnings_by_source(validated: DataFrame, source: Column, result: str = "_v") -> DataFrame:
    return (
        validated.select(source.alias("source_id"), F.explode(f"{result}.warnings").alias("rule_name"))
        .groupBy("source_id", "rule_name")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def quarantine_size(view: DataFrame) -> DataFrame:
    return view.groupBy("source_id").agg(F.count(F.lit(1)).alias("size"))


def histogram(df: DataFrame, group: Iterable[str], value: Column, bounds: Iterable[float]) -> DataFrame:
    """Cumulative counts per upper bound ``le`` (and +Inf), with the sum of values.

    Each bound is one conditional count in a single aggregate; rows are not multiplied.
    """
    bounds, group = list(bounds), list(group)
    counted = df.groupBy(*group).agg(
        *[F.count_if(value <= b).alias(f"_b{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_all"),
        F.sum(value).alias("_sum"),
    )
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_b{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(float("inf")).alias("le"), F.col("_all").alias("n")))
    return counted.select(*group, F.col("_sum").alias("total"), F.inline(F.array(*rows)))


def throughput(run_log: DataFrame) -> DataFrame:
    return run_log.select(
        "batch_id", "source_id", "mode", F.try_divide(F.col("total"), F.col("seconds")).alias("records_per_second")
    )


def batches(run_log: DataFrame) -> DataFrame:
    """Batches by outcome, and how many of them held duplicates."""
    return run_log.groupBy("source_id", "status").agg(
        F.count(F.lit(1)).alias("batches"), F.count_if(F.col("duplicates") > 0).alias("with_duplicates")
    )


def batch_counters(run_log: DataFrame) -> DataFrame:
    """Batches and records handled, and errors, per source and mode."""
    return run_log.groupBy("source_id", "mode").agg(
        F.count_if(F.col("status") == "success").alias("batches"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("records"),
        F.count_if(F.col("status") == "failure").alias("errors"),
    )


def errors_and_retries(run_log: DataFrame) -> DataFrame:
    return run_log.groupBy("source_id", "component").agg(
        F.count_if(F.col("status") == "failure").alias("errors"), F.count_if(F.col("attempt") > 1).alias("retries")
    )


def upserts(changes: DataFrame) -> DataFrame:
    """Inserts, updates and unchanged rows (input: ``classify_changes``); updates are conflicts."""
    return changes.groupBy("source_id").agg(
        F.count_if(F.col("change") == "insert").alias("inserts"),
        F.count_if(F.col("change") == "update").alias("updates"),
        F.count_if(F.col("change") == "unchanged").alias("unchanged"),
    )


def schema_changes(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("n"))


def coercions(coerced: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Attempts per field and outcome; ``fields`` maps coerced columns to their rule type."""
    aggs, rows = [], []
    raw = coerced.schema["_raw"].dataType
    from tidegate.functions.values import python_type_name, quoted

    for i, (name, target) in enumerate(fields.items()):
        given = F.col("_raw").getField(name).isNotNull()
        aggs.append(F.count_if(given & quoted(name).isNotNull()).alias(f"_{i}_ok"))
        aggs.append(F.count_if(given & quoted(name).isNull()).alias(f"_{i}_no"))
        for suffix, outcome in (("ok", "success"), ("no", "failure")):
            rows.append(
                F.struct(
                    F.lit(name).alias("field_name"),
                    F.lit(python_type_name(raw[name].dataType)).alias("from_type"),
                    F.lit(target).alias("to_type"),
                    F.lit(outcome).alias("status"),
                    F.col(f"_{i}_{suffix}").alias("n"),
                )
            )
    return coerced.agg(*aggs).select(F.inline(F.array(*rows)))


def quality_trend(validated: DataFrame, ts: Column, source: Column, width: str = "1 hour", result: str = "_v") -> DataFrame:
    """Rows and pass rate per time window and source; on a stream, add a watermark first."""
    return (
        validated.groupBy(F.window(ts, width).alias("w"), source.alias("source_id"))
        .agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(f"{result}.status") == "valid").alias("valid"))
        .select(
            F.col("w.start").alias("window_start"),
            "source_id",
            "total",
            "valid",
            F.round(F.col("valid") / F.col("total"), 4).alias("pass_rate"),
        )
    )


def trend_of_runs(run_log: DataFrame, width: str = "1 day") -> DataFrame:
    """Rows and pass rate per time window and source, from the counts in the run log (of a batch that ran twice, the last success)."""
    runs = run_log.filter("status = 'success' AND mode <> 'reprocess'").groupBy("source_id", "mode", "batch_id")
    last = runs.agg(F.max("started_at").alias("at"), F.max_by(F.struct("total", "valid"), "started_at").alias("c"))
    return last.groupBy(F.window("at", width).alias("w"), "source_id").agg(F.sum("c.total").alias("total"), F.sum("c.valid").alias("valid")).select(
        F.col("w.start").alias("window_start"), "source_id", "total", "valid", F.round(F.col("valid") / F.col("total"), 4).alias("pass_rate")
    )


def batch_result(validated: DataFrame, copies: str | None = None, schema_id: int | None = None, confidence: float | None = None, result: str = "_v") -> DataFrame:
    """One row: total, valid, invalid, duplicates and the schema used."""
    good = F.col(f"{result}.status") == "valid"
    kept = F.count(F.lit(1))
    total = F.coalesce(F.sum(copies), F.lit(0)) if copies else kept
    return validated.agg(
        total.alias("total_records"),
        F.count_if(good).alias("valid_records"),
        F.count_if(~good).alias("invalid_records"),
        (total - kept).alias("duplicate_records"),
        F.lit(schema_id).cast("bigint").alias("schema_id"),
        F.lit(confidence).cast("double").alias("schema_confidence"),
    )
