"""Dropping what is older than it may be: quarantine after 90 days, audit after a year.

Past days are folded into a folder each (``tables.days``); what is too old is dropped by deleting folders.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tidegate.session import delete_path, folders_of
from tidegate.tables.days import drop_days, fold, recover
from tidegate.tables.lake import Lake

# Days kept.
QUARANTINE_DAYS = 90
AUDIT_DAYS = 365


def expire_audit(lake: Lake, now: datetime, days: int = AUDIT_DAYS) -> list[str]:
    """Drop whole months that ended before the limit; no row is read and no file rewritten."""
    limit = (now - timedelta(days=days)).strftime("%Y-%m")
    recover(lake, "audit_log")
    months = {f.partition("=")[2] for f in folders_of(lake.spark, lake.path("audit_log")) if f.startswith("month=")}
    old = {m for m in months if m < limit}
    for month in old:
        delete_path(lake.spark, f"{lake.path('audit_log')}/month={month}")
    return sorted(old | {d[:7] for d in drop_days(lake, "audit_log", limit)})


def expire_quarantine(lake: Lake, now: datetime, days: int = QUARANTINE_DAYS) -> int:
    """Drop days that ended before the limit, with the review events of as long ago; returns the number of batches that had rows there.

    Batches that were not folded yet are folded first, so only those are read.  A repeated batch counts from its last run.
    """
    limit = f"{now - timedelta(days=days):%Y-%m-%d}"
    for name in ("quarantine_record", "quarantine_event"):
        fold(lake, name, limit)
    dropped = drop_days(lake, "quarantine_record", limit)
    drop_days(lake, "quarantine_event", limit)  # an event is never older than its row
    gone = lake.read("fold_log").filter((F.col("name") == "quarantine_record") & F.col("day").isin(dropped))
    return gone.select("batch").distinct().count() if dropped else 0
