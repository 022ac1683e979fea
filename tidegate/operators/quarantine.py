"""Rejected rows: how they are stored, searched and worked off.

Rows are never updated.  Review, reprocess requests and reprocessing are events; the current
view is the rows with their events summed up.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegate.functions.payload import raw_payload, record_id as record_id_of

# Texts used when a row arrives without any failure recorded.
UNKNOWN_RULE = "unknown_validation_failure"
UNKNOWN_TEXT = "Record failed validation but no specific rule was recorded"
UNKNOWN_ERROR = "unknown_error"
UNKNOWN_ERROR_TEXT = "Unknown validation error"
EVENTS = ("reviewed", "reprocess_requested", "reprocessed")

ROW_KEY = ("source_id", "batch_id", "quarantine_id")
_RECORD_TYPE = "raw_data STRING, failed_rules ARRAY<STRING>, error_messages ARRAY<STRING>, record_id STRING"


def _or_default(col: Column, default: str) -> Column:
    return F.when(F.coalesce(F.size(col), F.lit(0)) > 0, col).otherwise(F.array(F.lit(default)))


def quarantine_rows(
    invalid: DataFrame,
    source_id: str,
    batch_id: str,
    *,
    quarantined_at: Column | None = None,
    record_id: Column | None = None,
    ordinal: Column | None = None,
    result: str = "_v",
) -> DataFrame:
    """Validated rows in the quarantine layout, with the payload as it arrived."""
    at = quarantined_at if quarantined_at is not None else F.current_timestamp()
    rid = record_id if record_id is not None else record_id_of(invalid)
    base = invalid.select(
        rid.alias("record_id"),
        raw_payload(invalid).alias("raw_payload"),
        _or_default(F.col(f"{result}.failed_rules"), UNKNOWN_RULE).alias("failed_rules"),
        _or_default(F.col(f"{result}.error_messages"), UNKNOWN_TEXT).alias("error_messages"),
        F.col(f"{result}.status").alias("status"),
        at.alias("quarantined_at"),
        *([ordinal.alias("_ordinal")] if ordinal is not None else []),
    )
    return _with_identity(base if ordinal is not None else _numbered(base), source_id, batch_id)


def _numbered(base: DataFrame) -> DataFrame:
    """Rows with an ``_ordinal`` that tells equal rows apart and does not hang on the order of rows.

    Equal rows are counted, with map-side combining, and given out as often as they came; rows with
    one payload that differ otherwise get different ordinals by their content.
    """
    content = [c for c in base.columns if c not in ("raw_payload", "quarantined_at")]
    counted = base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))
    return rows.withColumn("_ordinal", F.struct("_k", F.xxhash64(*content))).drop("_n", "_k")


def _with_identity(base: DataFrame, source_id: str, batch_id: str) -> DataFrame:
    qid = F.xxhash64(F.lit(source_id), F.lit(batch_id), F.col("raw_payload"), F.col("_ordinal"))
    return base.select(
        qid.bitwiseAND(F.lit(2**63 - 1)).alias("quarantine_id"),
        "record_id",
        "raw_payload",
        "failed_rules",
        "error_messages",
        "status",
        "quarantined_at",
        F.lit(source_id).alias("source_id"),
        F.lit(batch_id).alias("batch_id"),
    )


def rows_from_records(spark: SparkSession, records: Iterable[dict[str, Any]], source_id: str, batch_id: str) -> DataFrame:
    """Hand-made quarantine rows: ``raw_data`` (JSON text or dict), lists and an optional id."""
    import json

    rows = []
    for r in records:
        raw = r.get("raw_data", {})
        rid = r.get("record_id")
        rows.append(
            (raw if isinstance(raw, str) else json.dumps(raw, default=str), r.get("failed_rules"), r.get("error_messages"),
             str(rid) if rid else None)
        )
    df = spark.createDataFrame(rows, _RECORD_TYPE)
    base = df.select(
        "record_id",
        F.col("raw_data").alias("raw_payload"),
        _or_default(F.col("failed_rules"), UNKNOWN_ERROR).alias("failed_rules"),
        _or_default(F.col("error_messages"), UNKNOWN_ERROR_TEXT).alias("error_messages"),
        F.lit("invalid").alias("status"),
        F.current_timestamp().alias("quarantined_at"),
    )
    return _with_identity(_numbered(base), source_id, batch_id)


# -- events and the current view ------------------------------------------------------


def event_rows(targets: DataFrame, event: str, at: Column | None = None) -> DataFrame:
    """The same event for every target row (a frame with the row key)."""
    if event not in EVENTS:
        raise ValueError(f"Unknown quarantine event: {event}")
    when = at if at is not None else F.current_timestamp()
    return targets.select("quarantine_id", "source_id", "batch_id", F.lit(event).alias("event"), when.alias("at"))


def current_view(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Quarantine rows with their flags.  Events are combined per row before the join."""
    marks = events.groupBy(*ROW_KEY).agg(
        F.min(F.when(F.col("event").isin("reviewed", "reprocessed"), F.col("at"))).alias("reviewed_at"),
        F.max(F.when(F.col("event") == "reprocess_requested", F.col("at"))).alias("_asked"),
        F.max(F.when(F.col("event") == "reprocessed", F.col("at"))).alias("reprocessed_at"),
    )
    return (
        rows.join(marks, list(ROW_KEY), "left")
        .withColumn("reviewed", F.col("reviewed_at").isNotNull())
        .withColumn("reprocess_requested", F.coalesce(F.col("_asked") > F.coalesce("reprocessed_at", F.lit(0).cast("timestamp")), F.lit(False)))
        .drop("_asked", "reviewed_at")
    )


# -- argument checks ------------------------------------------------------------------


def check_limit(limit: int, maximum: int = 10000) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= maximum:
        raise ValueError(f"limit must be a whole number from 1 to {maximum}, got {limit!r}")
    return limit


def check_offset(offset: int) -> int:
    if isinstance(offset, bool) or not isinstance(offset, int) or offset < 0:
        raise ValueError(f"offset must be a whole number of at least 0, got {offset!r}")
    return offset


def check_ids(ids: Iterable[int]) -> list[int]:
    out = list(ids)
    for i in out:
        if isinstance(i, bool) or not isinstance(i, int) or i <= 0:
            raise ValueError(f"quarantine ids must be positive whole numbers, got {i!r}")
    return out


# -- searches -------------------------------------------------------------------------


def select_ids(view: DataFrame, ids: Iterable[Any] | DataFrame, column: str) -> DataFrame:
    """Rows whose id is in a list or frame of ids of any length (a semi-join)."""
    if not isinstance(ids, DataFrame):
        dtype = view.schema[column].dataType.simpleString()
        ids = view.sparkSession.createDataFrame([(i,) for i in ids], f"`{column}` {dtype}")
    return view.join(ids.select(column), column, "left_semi")


def newest_first(view: DataFrame) -> list[Column]:
    return [F.desc("quarantined_at"), F.col("batch_id"), F.col("quarantine_id")]


def fetch(
    view: DataFrame,
    source_id: str | None = None,
    record_ids: Iterable[str] | DataFrame | None = None,
    error_types: Iterable[str] | None = None,
    limit: int | None = None,
    unreviewed_only: bool = True,
) -> DataFrame:
    """Rows to work on; with a limit, the newest ones."""
    out = view.filter(~F.col("reviewed")) if unreviewed_only else view
    if source_id is not None:
        out = out.filter(F.col("source_id") == source_id)
    if error_types:
        out = out.filter(F.arrays_overlap("failed_rules", F.array(*[F.lit(e) for e in error_types])))
    if record_ids is not None:
        out = select_ids(out, record_ids, "record_id")
    return out.orderBy(*newest_first(out)).limit(limit) if limit else out


def review_list(view: DataFrame, source_id: str | None = None, error_type: str | None = None, unreviewed_only: bool = False, limit: int = 50) -> DataFrame:
    return fetch(view, source_id, None, [error_type] if error_type else None, check_limit(limit), unreviewed_only)


def page(view: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    return view.orderBy(*newest_first(view)).offset(check_offset(offset)).limit(check_limit(limit))


def by_rule(view: DataFrame, rule_name: str) -> DataFrame:
    return view.filter(F.array_contains("failed_rules", rule_name))


def since(view: DataFrame, now: Column | None = None, interval: str = "24 HOURS") -> DataFrame:
    now = now if now is not None else F.current_timestamp()
    return view.filter(F.col("quarantined_at") >= now - F.expr(f"INTERVAL {interval}"))


def totals(view: DataFrame, source_id: str | None = None) -> DataFrame:
    """Total, not reviewed, and waiting to be reprocessed."""
    rows = view if source_id is None else view.filter(F.col("source_id") == source_id)
    return rows.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("reviewed")).alias("unreviewed"),
        F.count_if("reprocess_requested").alias("reprocess_pending"),
    )


def count_by_error(view: DataFrame) -> DataFrame:
    return view.select(F.explode("failed_rules").alias("error_type")).groupBy("error_type").count()


def count_by_source(view: DataFrame, top: int | None = None) -> DataFrame:
    counted = view.groupBy("source_id").count().orderBy(F.desc("count"), "source_id")
    return counted.limit(top) if top else counted


def statistics(view: DataFrame, source_id: str | None = None, top_sources: int = 10) -> DataFrame:
    """Total, reviewed, per error type and (without a source filter) the largest sources."""
    rows = view if source_id is None else view.filter(F.col("source_id") == source_id)
    # each row names every line it counts for, so the rows are read and grouped once
    line = lambda section, name: F.struct(F.lit(section).alias("section"), name.alias("name"))
    counted = F.array(line("total", F.lit("total_quarantined")), F.when(F.col("reviewed"), line("total", F.lit("reviewed_count"))))
    if source_id is None:
        counted = F.concat(counted, F.array(line("source", F.col("source_id"))))
    counted = F.concat(counted, F.transform("failed_rules", lambda r: line("error_type", r)))
    each = rows.select(F.explode(F.filter(counted, lambda x: x.isNotNull())).alias("line"), F.lit(1).cast("bigint").alias("n")).select("line.*", "n")
    none = F.array(line("total", F.lit("total_quarantined")), line("total", F.lit("reviewed_count")))
    zero = view.sparkSession.range(1).select(F.explode(none).alias("line"), F.lit(0).cast("bigint").alias("n")).select("line.*", "n")
    sums = each.unionByName(zero).groupBy("section", "name").agg(F.sum("n").alias("count"))
    place = F.row_number().over(Window.partitionBy("section").orderBy(F.desc("count"), "name"))
    return sums.withColumn("_place", place).filter((F.col("section") != "source") | (F.col("_place") <= top_sources)).drop("_place")


def grouped_by_error(view: DataFrame) -> DataFrame:
    """Each error with its count and the id of one example."""
    return (
        view.select(F.explode("failed_rules").alias("error_type"), "record_id")
        .groupBy("error_type")
        .agg(F.count(F.lit(1)).alias("count"), F.min("record_id").alias("sample_record"))
    )


def expired(view: DataFrame, now: Column | None = None, days: int = 90) -> DataFrame:
    now = now if now is not None else F.current_timestamp()
    return view.filter(F.col("quarantined_at") < now - F.make_dt_interval(F.lit(days)))
