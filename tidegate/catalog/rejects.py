"""Queries on the quarantine: searches, counts, review state, reprocessing."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.catalog.common import FAILURES_SQL, REJECTED_SQL, RULES, VIEW_SQL, dirty, judged, judged_sql, query, rejected, table, with_events
from tidegate.operators import metrics, quarantine
from tidegate.operators.validate import validate
from tidegate.plans.batch import load
from tidegate.plans.reprocess import mark, reprocess, revalidate, view
from tidegate.plans.route import Settings
from tidegate.rules.model import Rule
from tidegate.session import shared_folder
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse

R = judged_sql() + REJECTED_SQL
V = R + VIEW_SQL
_ERRORS = FAILURES_SQL.replace("FROM judged", "FROM rejected")


@query("quarantine_rows", R + "SELECT row_id, ver, record_id, source_id, quarantined_at, failed_rules, error_messages, CASE WHEN n_failed >= 3 THEN 'manual_review' ELSE 'invalid' END AS status FROM rejected")
def quarantine_layout(spark, d):
    rows = rejected(spark, d)
    return rows.select("row_id", "ver", "record_id", "source_id", "quarantined_at", F.array_join("failed_rules", ",").alias("failed_rules"),
                       F.array_join("error_messages", "|").alias("error_messages"), "status")


@query("quarantine_ids", R + "SELECT count(*) AS n, count(*) AS distinct_ids, true AS all_positive FROM rejected")
def quarantine_ids(spark, d):
    """Ids are positive and no two rows share one."""
    ids = rejected(spark, d).groupBy("quarantine_id").agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct_ids"), F.every(F.col("quarantine_id") > 0).alias("all_positive"))


@query("quarantine_defaults", judged_sql() + "SELECT row_id, ver, 'unknown_validation_failure' AS failed, 'Record failed validation but no specific rule was recorded' AS text FROM judged WHERE good")
def quarantine_defaults(spark, d):
    """Rows set aside without a failed rule get a stand-in."""
    good = judged(spark, d).filter("_v.status = 'valid'")
    rows = quarantine.quarantine_rows(good, "s", "b", record_id=F.col("transaction_id"), ordinal=F.struct("row_id", "ver"))
    row_id, ver = F.get_json_object("raw_payload", "$.row_id").cast("bigint"), F.get_json_object("raw_payload", "$.ver").cast("int")
    return rows.select(row_id.alias("row_id"), ver.alias("ver"), F.col("failed_rules")[0].alias("failed"), F.col("error_messages")[0].alias("text"))


@query("quarantine_totals", V + "SELECT count(*) AS total, sum((NOT reviewed)::INT)::BIGINT AS unreviewed, sum(reprocess_requested::INT)::BIGINT AS reprocess_pending FROM viewed")
def quarantine_totals(spark, d):
    return quarantine.totals(with_events(spark, d))


@query("quarantine_totals_of_source", V + "SELECT count(*) AS total, sum((NOT reviewed)::INT)::BIGINT AS unreviewed, sum(reprocess_requested::INT)::BIGINT AS reprocess_pending FROM viewed WHERE source_id = 'src3'")
def quarantine_totals_of_source(spark, d):
    return quarantine.totals(with_events(spark, d), "src3")


@query("quarantine_stats", V + _ERRORS + """SELECT 'total' AS section, 'total_quarantined' AS name, count(*) AS count FROM viewed UNION ALL SELECT 'total', 'reviewed_count', sum(reviewed::INT)::BIGINT FROM viewed
  UNION ALL SELECT 'error_type', rule_name, count(*) FROM failures GROUP BY rule_name UNION ALL SELECT 'source', source_id, count(*) FROM viewed GROUP BY source_id""")
def quarantine_stats(spark, d):
    return quarantine.statistics(with_events(spark, d))


@query("quarantine_by_error", R + _ERRORS + "SELECT rule_name AS error_type, count(*) AS count, min(record_id) AS sample_record FROM failures GROUP BY 1")
def quarantine_by_error(spark, d):
    return quarantine.grouped_by_error(rejected(spark, d))


@query("quarantine_by_source_top", R + "SELECT source_id, count(*) AS count FROM rejected GROUP BY 1 ORDER BY count DESC, source_id LIMIT 5")
def quarantine_by_source_top(spark, d):
    return quarantine.count_by_source(rejected(spark, d), 5)


@query("quarantine_by_source", R + "SELECT source_id, count(*) AS size FROM rejected GROUP BY 1")
def quarantine_by_source(spark, d):
    return metrics.quarantine_size(rejected(spark, d))


@query("quarantine_by_rule", R + "SELECT row_id, ver FROM rejected WHERE r4")
def quarantine_by_rule(spark, d):
    return quarantine.by_rule(rejected(spark, d), "amount_type").select("row_id", "ver")


@query("quarantine_date_range", R + "SELECT row_id, ver FROM rejected WHERE quarantined_at >= TIMESTAMP '1998-06-01' - INTERVAL 365 DAY")
def quarantine_date_range(spark, d):
    now = F.lit(datetime.datetime(1998, 6, 1)).cast("timestamp_ntz")
    return quarantine.since(rejected(spark, d), now, "365 DAYS").select("row_id", "ver")


@query("quarantine_review_list", V + """SELECT row_id, ver, quarantined_at FROM viewed WHERE r2 AND NOT reviewed AND source_id = 'src2' ORDER BY quarantined_at DESC, row_id, ver LIMIT 50""")
def quarantine_review_list(spark, d):
    """The newest open rows of a source with one error."""
    v = with_events(spark, d).withColumn("quarantine_id", F.col("row_id") * 10 + F.col("ver"))  # ties by row, as in SQL
    return quarantine.review_list(v, "src2", "transaction_id_format", True).select("row_id", "ver", "quarantined_at")


@query("quarantine_page", V + "SELECT row_id, ver FROM viewed ORDER BY quarantined_at DESC, row_id, ver LIMIT 100 OFFSET 200")
def quarantine_page(spark, d):
    v = with_events(spark, d).withColumn("quarantine_id", F.col("row_id") * 10 + F.col("ver"))
    return quarantine.page(v, 100, 200).select("row_id", "ver")


@query("quarantine_fetch_open", V + "SELECT row_id, ver FROM viewed WHERE NOT reviewed AND source_id = 'src1' AND (r2 OR r6)")
def quarantine_fetch_open(spark, d):
    v = quarantine.fetch(with_events(spark, d), "src1", error_types=["transaction_id_format", "status_values"])
    return v.select("row_id", "ver")


@query("quarantine_by_id_list", R + "SELECT row_id, ver FROM rejected WHERE record_id IN (SELECT concat('TXN', lpad(CAST(l_orderkey AS STRING), 10, '0')) FROM lineitem WHERE l_returnflag = 'R')")
def quarantine_by_id_list(spark, d):
    """Rows of an id list as long as a table."""
    ids = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.concat(F.lit("TXN"), F.lpad(F.col("l_orderkey").cast("string"), 10, "0")).alias("record_id"))
    return quarantine.select_ids(rejected(spark, d), ids, "record_id").select("row_id", "ver")


@query("quarantine_reviewed_view", V + "SELECT row_id, ver, reviewed, reprocess_requested FROM viewed")
def quarantine_reviewed_view(spark, d):
    return with_events(spark, d).select("row_id", "ver", "reviewed", "reprocess_requested")


@query("quarantine_expired", R + "SELECT row_id, ver FROM rejected WHERE quarantined_at < TIMESTAMP '1998-06-01' - INTERVAL 90 DAY")
def quarantine_expired(spark, d):
    now = F.lit(datetime.datetime(1998, 6, 1)).cast("timestamp_ntz")
    return quarantine.expired(rejected(spark, d), now).select("row_id", "ver")


_RELAXED = [r for r in RULES if r.rule_name not in ("amount_range", "status_values")] + [Rule("amount_range", "range", "amount", {"min": -100, "max": 1e6})]


@query("reprocess_relaxed_rule", R + "SELECT row_id, ver, NOT (r1 OR r2 OR r3 OR r4) AS ok FROM rejected")
def reprocess_relaxed_rule(spark, d):
    """Rejected payloads read back and judged by looser rules."""
    schema = T.StructType.fromDDL("transaction_id STRING, amount STRING, ts STRING, email STRING, status STRING, row_id BIGINT, ver INT")
    again = revalidate(rejected(spark, d).drop("row_id", "ver"), schema, _RELAXED, Settings(id_columns=("transaction_id",)))
    return again.select("row_id", "ver", (F.col("_v.status") == "valid").alias("ok"))


def _reviewed_lake(spark, d):
    """The dirty view loaded, then reprocessed with looser rules."""
    lake = Lake(spark, shared_folder(spark), buckets=16)
    settings = Settings(deduplicate=False)
    load(lake, RULES, "orders", df=dirty(spark, d), settings=settings, schema_fraction=1.0, batch_id="b1")
    return lake, settings


@query("reprocess_counts", R + """SELECT count(*) AS total, sum((NOT (r1 OR r2 OR r3 OR r4))::INT)::BIGINT AS success, sum((r1 OR r2 OR r3 OR r4)::INT)::BIGINT AS failed,
  sum((r1 OR r2 OR r3 OR r4)::INT)::BIGINT AS still_open FROM rejected""")
def reprocess_counts(spark, d):
    """A reprocessing run over the tables: passes leave the quarantine, failures stay."""
    lake, settings = _reviewed_lake(spark, d)
    r = reprocess(lake, _RELAXED, "orders", settings=settings)
    counts = (r["total_reprocessed"], r["success_count"], r["failed_count"])
    open_rows = quarantine.totals(view(lake))
    return open_rows.select(*[F.lit(n).cast("bigint").alias(k) for k, n in zip(("total", "success", "failed"), counts)], F.col("unreviewed").alias("still_open"))


@query("reprocess_warehouse", R + "SELECT count(DISTINCT transaction_id) AS n FROM judged WHERE NOT (r1 OR r2 OR r3 OR r4)")
def reprocess_warehouse(spark, d):
    lake, settings = _reviewed_lake(spark, d)
    reprocess(lake, _RELAXED, "orders", settings=settings)
    return Warehouse(lake).current().agg(F.count(F.lit(1)).alias("n"))


@query("review_marks", R + "SELECT count(*) AS total, sum((NOT r4)::INT)::BIGINT AS unreviewed, sum(r6::INT)::BIGINT AS reprocess_pending FROM rejected")
def review_marks(spark, d):
    """Rows marked in the stored quarantine."""
    lake, _ = _reviewed_lake(spark, d)
    mark(lake, "reviewed", quarantine.by_rule(view(lake), "amount_type"))
    mark(lake, "reprocess_requested", quarantine.by_rule(view(lake), "status_values"))
    return quarantine.totals(view(lake))


@query("rule_changes", judged_sql() + "SELECT sum((NOT (r1 OR r2 OR r3 OR r4))::INT)::BIGINT AS valid FROM judged")
def rule_changes(spark, d):
    """Rules kept in the rule table: added, one changed, one disabled, then used."""
    from tidegate.tables.control import RuleTable

    rules = RuleTable(Lake(spark, shared_folder(spark)))
    rules.add(RULES)
    rules.update(5, {"min": -100, "max": 1000000.0})
    rules.disable(6)
    v = validate(dirty(spark, d), rules.rules())
    return v.agg(F.count_if(F.col("_v.status") == "valid").alias("valid"))


@query("quarantine_ids_after_replay", judged_sql() + "SELECT count(*) AS rows_seen, count(*) AS same_ids, count(*) AS distinct_ids FROM judged WHERE NOT good")
def quarantine_ids_after_replay(spark, d):
    """The same batch, partitioned otherwise and in another order, gets the same quarantine ids."""
    bad = judged(spark, d).filter("_v.status <> 'valid'")
    at = F.to_timestamp(F.lit("2025-01-01 00:00:00"))
    first = quarantine.quarantine_rows(bad.repartition(3), "src", "b1", quarantined_at=at, record_id=F.col("transaction_id"))
    again = quarantine.quarantine_rows(bad.repartition(7, "row_id"), "src", "b1", quarantined_at=at, record_id=F.col("transaction_id"))
    both = first.select("quarantine_id", "raw_payload").join(again.select("quarantine_id", F.col("raw_payload").alias("p")), "quarantine_id", "left")
    return both.agg(F.count(F.lit(1)).alias("rows_seen"), F.count_if(F.col("raw_payload") == F.col("p")).alias("same_ids"), F.count_distinct("quarantine_id").alias("distinct_ids"))
