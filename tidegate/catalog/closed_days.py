"""Folded days: what they hold, what a repeated batch leaves, and what expires."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import functions as F

from tidegate.catalog.common import query, table
from tidegate.operators import quarantine
from tidegate.plans.retention import expire_quarantine
from tidegate.session import shared_folder
from tidegate.tables.days import fold
from tidegate.tables.lake import Lake

_MONTH = "date_trunc('month', o_orderdate)"
#: Rows that one task sorts by batch when it writes them: some 130 MB.
_TASK_ROWS = 1_000_000


def _dealt(rows):
    """The rows dealt evenly by their ids.  A task sorts what it writes by batch, and a split grows with the table."""
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(rows.count() / _TASK_ROWS))
    return rows.repartition(tasks, "record_id")


def _orders(spark, d):
    """Orders as rows of a batch per year, each dated by the first of its month."""
    return _dealt(table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("record_id"), F.lit("orders").alias("source_id"), F.lit("late").alias("rule_name"),
        F.col("o_orderstatus").alias("message"), F.date_trunc("month", "o_orderdate").alias("raised_at"),
        F.date_format("o_orderdate", "yyyy").alias("batch_id"),
    ))


@query("folded_days", f"""SELECT strftime({_MONTH}, '%Y') AS batch_id, strftime({_MONTH}, '%Y-%m-%d') AS day, o_orderstatus AS message, count(*) AS n, sum(o_orderkey)::BIGINT AS keys
  FROM orders WHERE strftime({_MONTH}, '%Y') <> '1996' OR o_orderstatus = 'F' AND o_orderkey % 2 = 1 GROUP BY 1, 2, 3""")
def folded_days(spark, d):
    """Alerts of closed and open batches; one batch was repeated with fewer rows after its days were folded, and folded again."""
    lake, rows = Lake(spark, shared_folder(spark)), _orders(spark, d)
    lake.replace_partitions(rows, "alert")
    fold(lake, "alert", "1998-01-01")
    again = rows.filter((F.col("batch_id") == "1996") & (F.col("message") == "F") & (F.col("record_id").cast("bigint") % 2 == 1))
    lake.replace_partitions(again, "alert")
    fold(lake, "alert", "1997-06-01")
    day = F.date_format("raised_at", "yyyy-MM-dd").alias("day")
    counted = F.count(F.lit(1)).alias("n"), F.sum(F.col("record_id").cast("bigint")).alias("keys")
    return lake.read("alert").groupBy("batch_id", day, "message").agg(*counted)


@query("folded_day_rows", f"""SELECT strftime({_MONTH}, '%Y-%m-%d') AS day, count(*) AS n FROM orders WHERE o_orderdate < DATE '1998-01-01' GROUP BY 1""")
def folded_day_rows(spark, d):
    """Only batches whose last day is over are folded, each row under its own day."""
    lake = Lake(spark, shared_folder(spark))
    lake.replace_partitions(_orders(spark, d), "alert")
    fold(lake, "alert", "1998-06-01")
    return lake.closed("alert").groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("quarantine_expired_days", f"""SELECT strftime({_MONTH}, '%Y-%m-%d') AS day, count(*) AS n, (SELECT count(DISTINCT {_MONTH}) FROM orders WHERE {_MONTH} < DATE '1998-01-02') AS dropped
  FROM orders WHERE {_MONTH} >= DATE '1998-01-02' GROUP BY 1""")
def quarantine_expired_days(spark, d):
    """What is left of the quarantine after old days were dropped, a batch being a month of orders."""
    lake = Lake(spark, shared_folder(spark))
    failed = F.struct(F.array(F.lit("late")).alias("failed_rules"), F.array(F.lit("Order is late")).alias("error_messages"), F.lit("invalid").alias("status"))
    orders = table(spark, d, "orders").withColumn("_v", failed)
    at = F.date_trunc("month", "o_orderdate")
    rows = quarantine.quarantine_rows(orders, "orders", "m", quarantined_at=at, record_id=F.col("o_orderkey").cast("string"))
    lake.replace_partitions(_dealt(rows).withColumn("batch_id", F.date_format("quarantined_at", "yyyy-MM")), "quarantine_record")
    dropped = expire_quarantine(lake, datetime.datetime(1998, 1, 12), days=10)
    left = lake.read("quarantine_record").groupBy(F.date_format("quarantined_at", "yyyy-MM-dd").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return left.withColumn("dropped", F.lit(dropped).cast("bigint"))
