"""Times the headline queries: one warm-up, then the median of three runs, as one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# rule evaluation, the lists it yields, de-duplication, uniqueness, whole loads, upserts,
# quarantine and audit questions, reprocessing, a drained stream
HEADLINE = """validate_status_counts failed_rule_list error_messages failures_by_rule is_unique conditional_rule custom_expression
custom_python dedup_latest duplicate_report coerce_values checksum type_consistency csv_scan json_scan change_detection upsert_merge
upsert_table load_counts quarantine_stats quarantine_reviewed_view reprocess_counts audit_summary reconciliation quality_trend
value_histogram stream_validate stream_window_counts""".split()


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from tidegate.catalog import QUERIES

    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in ("orders", "events")}

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)

    feed = rows["orders"] + spark.read.parquet(f"{SF_DIR}/orders.parquet").filter("o_orderkey % 31 = 0").count()
    rates = {
        "validate_rows_per_sec": round(feed / seconds["validate_status_counts"]),
        "load_rows_per_sec": round(feed / seconds["load_counts"]),
        "stream_rows_per_sec": round(rows["events"] / seconds["stream_validate"]),
    }
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, total of medians", "value": total, "unit": "sec", "queries": seconds,
                      "rates": rates, "cpus": int(CPUS), "sf": SF_DIR.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
