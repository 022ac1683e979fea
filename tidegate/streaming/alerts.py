"""Alerts on values outside their range."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.rules.model import Rule, check_rules


def range_alerts(validated: DataFrame, rules: Iterable[Rule], source_id: str, batch_id: str, result: str = "_v") -> DataFrame:
    """One row per failed range rule, in the alert layout."""
    names = [r.rule_name for r in check_rules(rules) if r.rule_type == "range" and r.severity == "error"]
    failed = validated.select(
        F.col("_rid").alias("record_id"),
        F.explode(F.arrays_zip(F.col(f"{result}.failed_rules").alias("rule"), F.col(f"{result}.error_messages").alias("text"))).alias("f"),
    )
    return failed.filter(F.col("f.rule").isin(names)).select(
        "record_id",
        F.lit(source_id).alias("source_id"),
        F.col("f.rule").alias("rule_name"),
        F.col("f.text").alias("message"),
        F.current_timestamp().alias("raised_at"),
        F.lit(batch_id).alias("batch_id"),
    )
