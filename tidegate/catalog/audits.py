"""Queries on the audit trail, on reconciliation and on metrics over time."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog.cleaning import _ORDER_DATES
from tidegate.catalog.common import RULES, dirty, judged, judged_sql, query, table
from tidegate.operators import clean, dedup, lineage, metrics
from tidegate.operators.validate import coerce_types, validate
from tidegate.plans.route import Settings, judge
from tidegate.rules.model import Rule

J = judged_sql()


def _keys(source="src"):
    """Record id, source and a fixed time for events of the dirty view."""
    return {"record_id": F.coalesce("transaction_id", F.lit("unknown")), "source_id": F.concat(F.lit(source), (F.col("row_id") % 7).cast("string")), "created_at": F.col("ts")}


def trail(spark, d):
    """All events of the dirty view: coercions and writes of good rows, quarantine of the rest."""
    v = judged(spark, d)
    good, bad = v.filter("_v.status = 'valid'"), v.filter("_v.status <> 'valid'")
    bad = bad.withColumns({"failed_rules": F.col("_v.failed_rules"), "error_messages": F.col("_v.error_messages")})
    return (
        lineage.coercion_events(good, RULES, **_keys())
        .unionByName(lineage.write_events(good, 1, **_keys()))
        .unionByName(lineage.quarantine_events(bad, **_keys()))
    )


_KEYS = "coalesce(transaction_id, 'unknown') AS record_id, concat('src', CAST(row_id % 7 AS STRING)) AS source_id, ts AS created_at"
TRAIL = J + f""",
trail AS (
  SELECT {_KEYS}, 'type_coercion' AS transformation_type, 'amount' AS field_name, amount AS old_value, CAST(amount_value AS STRING) AS new_value, 'TypeValidator(target=float)' AS rule_applied FROM judged WHERE good AND amount IS NOT NULL
  UNION ALL SELECT {_KEYS}, 'warehouse_write', NULL, NULL, 'schema_version=1', NULL FROM judged WHERE good
  UNION ALL SELECT {_KEYS}, 'quarantine', NULL, NULL, string_split(error_messages, '|')[1], string_split(failed_rules, ',')[1] FROM judged WHERE NOT good AND NOT r6
  UNION ALL SELECT {_KEYS}, 'quarantine', NULL, NULL, CASE WHEN n_failed = 1 THEN error_messages ELSE string_split(error_messages, '|')[1] END, string_split(failed_rules, ',')[1] FROM judged WHERE NOT good AND r6)
"""


@query("audit_events", TRAIL + "SELECT * FROM trail")
def audit_events(spark, d):
    return trail(spark, d)


@query("audit_coercions", J + f"SELECT {_KEYS}, amount AS old_value, CAST(amount_value AS STRING) AS new_value FROM judged WHERE amount_value IS NOT NULL")
def audit_coercions(spark, d):
    """Every value that changed its type, with the text it had."""
    e = lineage.coercion_events(coerce_types(dirty(spark, d), RULES), RULES, **_keys())
    return e.select("record_id", "source_id", "created_at", "old_value", "new_value")


@query("audit_dates", """SELECT CAST(o_orderkey AS STRING) AS record_id, day_text AS old_value, strftime(strptime(day_text, '%m/%d/%Y'), '%Y-%m-%d') AS new_value, 'DateNormalizer(format=yyyy-MM-dd)' AS rule_applied
  FROM (""" + _ORDER_DATES.format(orders="orders") + ") WHERE day_text LIKE '%/%'")
def audit_dates(spark, d):
    df = clean.normalize_dates(spark.sql(_ORDER_DATES, orders=table(spark, d, "orders")), ["day_text"])
    e = lineage.date_events(df, clean.DATE_OUTPUT, record_id=F.col("o_orderkey").cast("string"), source_id=F.lit("s"), created_at=F.current_timestamp())
    return e.select("record_id", "old_value", "new_value", "rule_applied")


@query("audit_trims", r"""SELECT CAST(doc_id AS STRING) AS record_id, md5(padded) AS old_hash, md5(regexp_replace(regexp_replace(padded, '^\s+', ''), '\s+$', '')) AS new_hash, 'StringTrimmer' AS rule_applied
  FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN concat('  ', text) ELSE text END AS padded FROM documents) WHERE padded <> regexp_replace(regexp_replace(padded, '^\s+', ''), '\s+$', '')""")
def audit_trims(spark, d):
    padded = F.when(F.col("lang") == "en", F.concat(F.lit("  "), "text")).otherwise(F.col("text"))
    df = clean.trim_fields(table(spark, d, "documents").select("doc_id", padded.alias("text")))
    e = lineage.trim_events(df, record_id=F.col("doc_id").cast("string"), source_id=F.lit("s"), created_at=F.current_timestamp())
    return e.select("record_id", F.md5("old_value").alias("old_hash"), F.md5("new_value").alias("new_hash"), "rule_applied")


@query("audit_dedup", J + """SELECT 'batch_orders' AS record_id, 'deduplication' AS transformation_type,
  concat('duplicates_removed=', CAST(count(transaction_id) - count(DISTINCT transaction_id) AS STRING)) AS new_value FROM judged""")
def audit_dedup(spark, d):
    """One event per batch that had duplicates."""
    counts = dedup.duplicates_removed(dedup.dedup_any(dirty(spark, d)))
    return lineage.dedup_events(counts, "orders", F.current_timestamp()).select("record_id", "transformation_type", "new_value")


_TOP = " ORDER BY created_at DESC, record_id, transformation_type, field_name NULLS FIRST, new_value NULLS FIRST LIMIT "
_COLS = ("record_id", "created_at", "transformation_type", "field_name", "old_value", "new_value", "rule_applied")
_SHOWN = ", ".join(_COLS)


@query("audit_by_record", TRAIL + f"SELECT {_SHOWN} FROM trail WHERE record_id = 'INVALID_ID'" + _TOP + "100")
def audit_by_record(spark, d):
    return lineage.by_record(trail(spark, d), "INVALID_ID").select(*_COLS)


@query("audit_by_source", TRAIL + f"SELECT {_SHOWN} FROM trail WHERE source_id = 'src4'" + _TOP + "1000")
def audit_by_source(spark, d):
    return lineage.by_source(trail(spark, d), "src4").select(*_COLS)


@query("audit_by_type", TRAIL + f"SELECT {_SHOWN} FROM trail WHERE transformation_type = 'quarantine'" + _TOP + "1000")
def audit_by_type(spark, d):
    return lineage.by_type(trail(spark, d), "quarantine").select(*_COLS)


_SUMMARY = """SELECT transformation_type, count(*) AS events, count(DISTINCT record_id) AS unique_records FROM trail GROUP BY 1
  UNION ALL SELECT 'ALL', count(*), count(DISTINCT record_id) FROM trail"""


@query("audit_summary", TRAIL + _SUMMARY)
def audit_summary(spark, d):
    return lineage.summary(trail(spark, d))


@query("audit_summary_of_source", TRAIL + _SUMMARY.replace("FROM trail", "FROM trail WHERE source_id = 'src2'"))
def audit_summary_of_source(spark, d):
    return lineage.summary(trail(spark, d), "src2")


@query("audit_report_counts", TRAIL + _SUMMARY)
def audit_report_counts(spark, d):
    return lineage.report(trail(spark, d))[0]


@query("audit_report_recent", TRAIL + f"SELECT {_SHOWN} FROM trail" + _TOP + "10")
def audit_report_recent(spark, d):
    return lineage.report(trail(spark, d))[1].select(*_COLS)


@query("audit_trace", TRAIL + """, one AS (SELECT * FROM trail WHERE record_id = 'INVALID_ID')
SELECT created_at, transformation_type, coalesce(field_name, '-') AS field_name, concat_ws(' ', CASE WHEN old_value IS NOT NULL THEN concat('''', old_value, '''') END,
  CASE WHEN old_value IS NOT NULL AND new_value IS NOT NULL THEN '→' END, CASE WHEN new_value IS NOT NULL THEN concat('''', new_value, '''') END, CASE WHEN rule_applied IS NOT NULL THEN concat('(', rule_applied, ')') END) AS details FROM one""")
def audit_trace(spark, d):
    """The story of one id, oldest event first."""
    return lineage.trace(trail(spark, d), "INVALID_ID")


@query("audit_months", TRAIL + "SELECT strftime(created_at, '%Y-%m') AS month, transformation_type, count(*) AS n FROM trail WHERE strftime(created_at, '%Y-%m') BETWEEN '1996-01' AND '1996-06' GROUP BY ALL")
def audit_months(spark, d):
    """Stored events, read by month partition."""
    from tidegate.session import shared_folder
    from tidegate.tables.lake import Lake

    lake = Lake(spark, shared_folder(spark))
    lake.replace_partitions(lineage.stored_form(trail(spark, d), "b1"), "audit_log")
    return lineage.in_months(lake.read("audit_log"), "1996-01", "1996-06").groupBy("month", "transformation_type").agg(F.count(F.lit(1)).alias("n"))


@query("reconciliation", J + """SELECT count(*) AS received, count(DISTINCT transaction_id) FILTER (good) AS loaded, count(*) FILTER (NOT good) AS quarantined,
  count(*) FILTER (good) - count(DISTINCT transaction_id) FILTER (good) AS duplicates, CAST(0 AS BIGINT) AS unaccounted FROM judged""")
def reconciliation(spark, d):
    """Every row that arrived is loaded, quarantined or a duplicate."""
    df = dirty(spark, d)
    return lineage.reconcile_judged(df, judge(df, RULES, Settings(latest_by=("ts", "ver", "row_id"))))


@query("lost_keys", "SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def lost_keys(spark, d):
    """Keys that arrived and are in neither table."""
    items = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag")
    return lineage.lost_keys(table(spark, d, "orders"), items.filter("l_returnflag = 'R'"), items.filter("l_returnflag <> 'R'"), "o_orderkey")


@query("unregistered_sources", "SELECT event_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def unregistered_sources(spark, d):
    """Records whose source is not registered: an anti join on the source id."""
    from tidegate.session import shared_folder
    from tidegate.tables.control import SourceRegistry
    from tidegate.tables.lake import Lake

    known = table(spark, d, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").cast("string").alias("source_id"), F.lit("csv_file").alias("source_type"), F.lit(None).cast("bigint").alias("schema_version_id"),
        F.create_map(F.lit("header"), F.lit("true")).alias("connection_info"), F.lit(True).alias("enabled"), F.current_timestamp().alias("created_at"), F.current_timestamp().alias("updated_at"))
    lake = Lake(spark, shared_folder(spark))
    lake.revise(known, "data_source")
    rows = table(spark, d, "events").withColumn("source_id", F.col("user_id").cast("string"))
    return SourceRegistry(lake).unregistered(rows).select("event_id")


@query("value_histogram", """SELECT event_type, le, n FROM (SELECT event_type, count(*) FILTER (value <= 1) AS a, count(*) FILTER (value <= 10) AS b, count(*) FILTER (value <= 100) AS c, count(value) AS d FROM events GROUP BY 1) t,
  LATERAL (VALUES (CAST(1 AS DOUBLE), a), (CAST(10 AS DOUBLE), b), (CAST(100 AS DOUBLE), c), (CAST('Infinity' AS DOUBLE), d)) v(le, n)""")
def value_histogram(spark, d):
    """Cumulative bucket counts per group."""
    return metrics.histogram(table(spark, d, "events"), ["event_type"], F.col("value"), [1, 10, 100]).drop("total")


_RUNS = """WITH runs AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_id, event_type AS source_id, 'batch' AS mode, CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
  count(*) AS total, count(*) - count(DISTINCT user_id) AS duplicates, CAST(count(DISTINCT user_id) AS DOUBLE) AS seconds, 'batch' AS component, 1 + (count(*) % 2)::INT AS attempt FROM events GROUP BY 1, 2) """


def _runs(spark, d):
    """A run log made from the events: one run per day and type."""
    df = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("batch_id"), F.col("event_type").alias("source_id")).agg(
        F.count(F.lit(1)).alias("total"), F.countDistinct("user_id").alias("users"))
    return df.select("batch_id", "source_id", F.lit("batch").alias("mode"), F.when(F.col("source_id") == "error", "failure").otherwise("success").alias("status"), "total",
                     (F.col("total") - F.col("users")).alias("duplicates"), F.col("users").cast("double").alias("seconds"), F.lit("batch").alias("component"),
                     (1 + F.col("total") % 2).cast("int").alias("attempt"))


@query("run_throughput", _RUNS + "SELECT batch_id, source_id, mode, total / seconds AS records_per_second FROM runs")
def run_throughput(spark, d):
    return metrics.throughput(_runs(spark, d))


@query("run_outcomes", _RUNS + "SELECT source_id, status, count(*) AS batches, sum((duplicates > 0)::INT)::BIGINT AS with_duplicates FROM runs GROUP BY ALL")
def run_outcomes(spark, d):
    return metrics.batches(_runs(spark, d))


@query("run_counters", _RUNS + "SELECT source_id, mode, sum((status = 'success')::INT)::BIGINT AS batches, sum(total)::BIGINT AS records, sum((status = 'failure')::INT)::BIGINT AS errors FROM runs GROUP BY ALL")
def run_counters(spark, d):
    return metrics.batch_counters(_runs(spark, d))


@query("run_errors", _RUNS + "SELECT source_id, component, sum((status = 'failure')::INT)::BIGINT AS errors, sum((attempt > 1)::INT)::BIGINT AS retries FROM runs GROUP BY ALL")
def run_errors(spark, d):
    return metrics.errors_and_retries(_runs(spark, d))


@query("run_size_histogram", _RUNS + """SELECT source_id, le, n FROM (SELECT source_id, """ + ", ".join(f"count(*) FILTER (total <= {b}) AS b{b}" for b in metrics.BUCKETS["batch_size_records"]) + """, count(*) AS rest FROM runs GROUP BY 1) t,
  LATERAL (VALUES """ + ", ".join(f"(CAST({b} AS DOUBLE), b{b})" for b in metrics.BUCKETS["batch_size_records"]) + ", (CAST('Infinity' AS DOUBLE), rest)) v(le, n)")
def run_size_histogram(spark, d):
    return metrics.histogram(_runs(spark, d), ["source_id"], F.col("total"), metrics.BUCKETS["batch_size_records"]).drop("total")


@query("quality_trend", """SELECT date_trunc('hour', ts) AS window_start, event_type AS source_id, count(*) AS total, sum((value BETWEEN 5 AND 100)::INT)::BIGINT AS valid,
  round(sum((value BETWEEN 5 AND 100)::INT) / count(*), 4) AS pass_rate FROM events GROUP BY 1, 2""")
def quality_trend(spark, d):
    """Pass rate per hour and source."""
    v = validate(table(spark, d, "events"), [Rule("r", "range", "value", {"min": 5, "max": 100})])
    return metrics.quality_trend(v, F.col("ts"), F.col("event_type"))


@query("schema_change_counts", """SELECT 'new_field' AS change_type, count(DISTINCT event_type) AS n FROM events UNION ALL SELECT 'type_change', count(DISTINCT event_type) FROM events WHERE event_type <> 'click'""")
def schema_change_counts(spark, d):
    """Schema changes by kind, one source per event type."""
    e = table(spark, d, "events")
    new = e.select("event_type", F.lit("new_field").alias("change_type"))
    typed = e.filter("event_type <> 'click'").select("event_type", F.lit("type_change").alias("change_type"))
    return metrics.schema_changes(new.unionByName(typed).distinct())
