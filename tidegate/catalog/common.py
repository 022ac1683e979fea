"""Shared inputs of the catalog: the dirty view of orders, its rules, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators import quarantine
from tidegate.operators.validate import validate
from tidegate.rules.model import Rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# The text runs unchanged in Spark and in ANSI engines; only {orders} is filled in.
DIRTY_SQL = """
SELECT CASE WHEN k % 11 = 0 THEN NULL WHEN k % 13 = 0 THEN 'INVALID_ID'
            ELSE concat('TXN', lpad(CAST(k AS STRING), 10, '0')) END AS transaction_id,
       CASE WHEN k % 17 = 0 THEN NULL WHEN k % 19 = 0 THEN 'not_a_number' WHEN k % 23 = 0 THEN '-50.00'
            WHEN k % 29 = 0 THEN '   ' ELSE CAST(o_totalprice AS STRING) END AS amount,
       o_orderdate AS ts,
       CASE WHEN k % 7 = 0 THEN 'invalid_email' WHEN k % 10 = 0 THEN NULL
            ELSE concat('user', CAST(k AS STRING), '@example.com') END AS email,
       CASE WHEN k % 37 = 0 THEN 'invalid_status' WHEN o_orderstatus = 'F' THEN 'completed'
            WHEN o_orderstatus = 'P' THEN 'pending' ELSE 'failed' END AS status,
       k AS row_id, ver
FROM (SELECT o_orderkey AS k, o_totalprice, o_orderdate, o_orderstatus, 0 AS ver FROM {orders}
      UNION ALL SELECT o_orderkey, o_totalprice + 1.0, o_orderdate, o_orderstatus, 1 FROM {orders}
      WHERE o_orderkey % 31 = 0) x
"""

RULES = [
    Rule("transaction_id_required", "required_field", "transaction_id"),
    Rule("transaction_id_format", "regex", "transaction_id", {"pattern": "^TXN[0-9]{10}$"}),
    Rule("amount_required", "required_field", "amount"),
    Rule("amount_type", "type_check", "amount", {"expected_type": "float"}),
    Rule("amount_range", "range", "amount", {"min": 0.01, "max": 1000000.0}),
    Rule("status_values", "regex", "status", {"pattern": "^(pending|completed|failed|cancelled)$"}),
    Rule("email_format", "regex", "email", {"pattern": EMAIL}, "warning"),
]

_BAD_STATUS = "NOT regexp_matches(status, '^(pending|completed|failed|cancelled)$')"


def judged_sql(extra: str = "", max_amount: str = "1000000.0", min_amount: str = "0.01") -> str:
    """CTEs ``dirty``, ``flags`` and ``judged`` that restate RULES in SQL."""
    return f"""WITH dirty AS ({DIRTY_SQL.format(orders="orders")}),
flags AS (SELECT *, TRY_CAST(amount AS DOUBLE) AS amount_value,
  transaction_id IS NULL AS r1,
  coalesce(NOT regexp_matches(transaction_id, '^TXN[0-9]{{10}}$'), false) AS r2,
  amount IS NULL OR trim(amount) = '' AS r3,
  amount IS NOT NULL AND TRY_CAST(amount AS DOUBLE) IS NULL AS r4,
  coalesce(TRY_CAST(amount AS DOUBLE) < {min_amount} OR TRY_CAST(amount AS DOUBLE) > {max_amount}, false) AS r5,
  {_BAD_STATUS} AS r6,
  coalesce(NOT regexp_matches(email, '{EMAIL}'), false) AS w1
  FROM dirty),
judged AS (SELECT *,
  concat_ws(',', CASE WHEN r1 THEN 'transaction_id_required' END, CASE WHEN r2 THEN 'transaction_id_format' END,
    CASE WHEN r3 THEN 'amount_required' END, CASE WHEN r4 THEN 'amount_type' END,
    CASE WHEN r5 THEN 'amount_range' END, CASE WHEN r6 THEN 'status_values' END) AS failed_rules,
  concat_ws('|', CASE WHEN r1 THEN 'Field value is null' END,
    CASE WHEN r2 THEN concat('Value ''', transaction_id, ''' does not match pattern ''^TXN[0-9]{{10}}$''') END,
    CASE WHEN r3 THEN CASE WHEN amount IS NULL THEN 'Field value is null' ELSE 'Field value is empty string' END END,
    CASE WHEN r4 THEN 'Cannot coerce str to float: not a number' END,
    CASE WHEN r5 THEN concat('Value ', CAST(amount_value AS STRING), CASE WHEN amount_value < {min_amount}
      THEN ' is less than minimum {min_amount}' ELSE ' exceeds maximum {max_amount}' END) END,
    CASE WHEN r6 THEN concat('Value ''', status, ''' does not match pattern ''^(pending|completed|failed|cancelled)$''') END
    ) AS error_messages,
  CASE WHEN w1 THEN 'email_format' ELSE '' END AS warnings,
  r1::INT + r2::INT + r3::INT + r4::INT + r5::INT + r6::INT AS n_failed,
  NOT (r1 OR r2 OR r3 OR r4 OR r5 OR r6) AS good
  FROM flags){extra}
"""


# One row per failed error rule, for SQL twins that count by rule.
FAILURES_SQL = """,
failures AS (
  SELECT *, 'transaction_id_required' AS rule_name, 'required_field' AS rule_type, 'transaction_id' AS field_name FROM judged WHERE r1
  UNION ALL SELECT *, 'transaction_id_format', 'regex', 'transaction_id' FROM judged WHERE r2
  UNION ALL SELECT *, 'amount_required', 'required_field', 'amount' FROM judged WHERE r3
  UNION ALL SELECT *, 'amount_type', 'type_check', 'amount' FROM judged WHERE r4
  UNION ALL SELECT *, 'amount_range', 'range', 'amount' FROM judged WHERE r5
  UNION ALL SELECT *, 'status_values', 'regex', 'status' FROM judged WHERE r6)"""


def query(name: str, sql: str | None = None):
    """Register a query; its docstring says what it shows."""

    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dirty(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(DIRTY_SQL.format(orders="{orders}"), orders=table(spark, folder, "orders"))


def judged(spark: SparkSession, folder: str, rules: list[Rule] | None = None, **options) -> DataFrame:
    return validate(dirty(spark, folder), RULES if rules is None else rules, **options)


def rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Quarantine rows of the dirty view, from seven sources, dated by the order."""
    bad = judged(spark, folder).filter("_v.status <> 'valid'")
    rows = quarantine.quarantine_rows(
        bad, "src", "b1", quarantined_at=F.col("ts"), record_id=F.col("transaction_id"), ordinal=F.struct("row_id", "ver")
    )
    row_id = F.get_json_object("raw_payload", "$.row_id").cast("bigint")
    ver = F.get_json_object("raw_payload", "$.ver").cast("int")
    return rows.withColumns({"row_id": row_id, "ver": ver, "source_id": F.concat(F.lit("src"), (row_id % 7).cast("string"))})


REJECTED_SQL = """,
rejected AS (SELECT *, transaction_id AS record_id, concat('src', CAST(row_id % 7 AS STRING)) AS source_id,
  ts AS quarantined_at FROM judged WHERE NOT good)"""


def with_events(spark: SparkSession, folder: str) -> DataFrame:
    """The quarantine view after review: cheap orders were reviewed, failed ones sent back."""
    rows = rejected(spark, folder)
    day = F.expr("INTERVAL 1 DAY")
    reviewed = quarantine.event_rows(rows.filter(F.array_contains("failed_rules", "amount_range")), "reviewed", F.col("quarantined_at") + day)
    asked = quarantine.event_rows(
        rows.filter(F.array_contains("failed_rules", "status_values")), "reprocess_requested", F.col("quarantined_at") + day
    )
    return quarantine.current_view(rows, reviewed.unionByName(asked))


VIEW_SQL = """,
viewed AS (SELECT *, r5 AS reviewed, r6 AS reprocess_requested FROM rejected)"""
