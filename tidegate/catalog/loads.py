"""Loads with cleaning, duplicate logs and schema decisions; late rows; reprocessing without loss."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog.common import RULES, dirty, judged_sql, query, table
from tidegate.operators import dedup, lineage, metrics
from tidegate.plans.batch import load
from tidegate.plans.reprocess import reprocess
from tidegate.plans.route import Settings
from tidegate.rules.model import Rule
from tidegate.session import shared_folder
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, order_key, warehouse_rows


def _lake(spark) -> Lake:
    return Lake(spark, shared_folder(spark), buckets=16)


def _field(column: str, name: str):
    return F.get_json_object(column, f"$.{name}")


_ORDER = ("ts", "ver", "row_id")
_GOOD = judged_sql(""",
good_rows AS (SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY ts DESC, ver DESC, row_id DESC) AS place FROM judged WHERE good),
keys AS (SELECT transaction_id, count(*) AS copies, count(DISTINCT row(amount, ts, email, status, row_id, ver)) AS distinct_values FROM good_rows GROUP BY 1)""")


def _loaded(spark, d):
    lake = _lake(spark)
    load(lake, RULES, "orders", df=dirty(spark, d), settings=Settings(latest_by=_ORDER), batch_id="b1")
    return lake


@query("load_duplicate_report", _GOOD + "SELECT transaction_id AS record_id, copies, distinct_values FROM keys WHERE copies > 1")
def load_duplicate_report(spark, d):
    """The report a load leaves of records that came more than once."""
    return dedup.report_of(_loaded(spark, d).read("duplicate_log")).select("record_id", "copies", "distinct_values")


@query("load_conflicts", _GOOD + """SELECT l.transaction_id AS record_id, concat(l.row_id, ':', l.ver) AS lost, concat(k.row_id, ':', k.ver) AS kept
  FROM good_rows l JOIN good_rows k ON k.transaction_id = l.transaction_id AND k.place = 1 WHERE l.place > 1""")
def load_conflicts(spark, d):
    """Valid rows of one record with different values: what was lost, beside what was kept."""
    log = _loaded(spark, d).read("duplicate_log").filter("differs")
    name = lambda c: F.concat_ws(":", _field(c, "row_id"), _field(c, "ver"))
    return log.select("record_id", name("lost_data").alias("lost"), name("kept_data").alias("kept"))


@query("load_accounts", judged_sql() + """SELECT count(*) AS received, count(DISTINCT transaction_id) FILTER (good) AS loaded, count(*) FILTER (NOT good) AS quarantined,
  count(*) FILTER (good) - count(DISTINCT transaction_id) FILTER (good) AS logged FROM judged""")
def load_accounts(spark, d):
    """Every row received is loaded, quarantined or in the duplicate log."""
    lake = _loaded(spark, d)
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    logged = lake.read("duplicate_log").agg(F.sum("copies").alias("logged"))
    parts = [count(dirty(spark, d), "received"), count(Warehouse(lake).current(), "loaded"), count(lake.read("quarantine_record"), "quarantined"), logged]
    one = parts[0].withColumn("k", F.lit(1))
    for p in parts[1:]:
        one = one.join(p.withColumn("k", F.lit(1)), "k")
    return one.drop("k")


def _cleaned(spark, d):
    """Orders with padded texts and dates in two spellings."""
    odd = F.col("o_orderkey") % 2 == 1
    df = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("transaction_id"), F.when(odd, F.concat(F.lit("  "), "o_orderstatus", F.lit("\t"))).otherwise(F.col("o_orderstatus")).alias("status"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("day"), F.when(odd, " x").alias("note"),
    )
    df = df.withColumn("day", F.when(F.col("transaction_id").cast("long") % 3 == 0, F.date_format(F.to_date("day", "MM/dd/yyyy"), "yyyy-MM-dd")).otherwise(F.col("day")))
    lake = _lake(spark)
    rules = [Rule("status_known", "regex", "status", {"pattern": "^[FO]$"}), Rule("day_form", "regex", "day", {"pattern": r"^\d{4}-\d\d-\d\d$"})]
    load(lake, rules, "orders", df=df, settings=Settings(trim=("status", "note"), date_columns=("day",)), batch_id="b1")
    return lake


_CLEANED = """WITH c AS (SELECT CAST(o_orderkey AS STRING) AS record_id, o_orderkey, o_orderstatus AS status, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) """


@query("load_cleaned", _CLEANED + "SELECT record_id, status, day, CASE WHEN o_orderkey % 2 = 1 THEN 'x' END AS note FROM c WHERE status IN ('F', 'O')")
def load_cleaned(spark, d):
    """Texts stripped and dates brought into one spelling before the rules see them."""
    return Warehouse(_cleaned(spark, d)).current().select("record_id", *[_field("data", c).alias(c) for c in ("status", "day", "note")])


@query("load_cleaning_audit", _CLEANED + """SELECT 'field_trimming' AS transformation_type, 2 * count(*) AS n FROM c WHERE status IN ('F', 'O') AND o_orderkey % 2 = 1
  UNION ALL SELECT 'date_normalization', count(*) FROM c WHERE status IN ('F', 'O') AND o_orderkey % 3 <> 0""")
def load_cleaning_audit(spark, d):
    log = _cleaned(spark, d).read("audit_log").filter("transformation_type IN ('field_trimming', 'date_normalization')")
    return log.groupBy("transformation_type").agg(F.count(F.lit(1)).alias("n"))


@query("load_cleaned_quarantine", _CLEANED + "SELECT record_id, CASE WHEN o_orderkey % 2 = 1 THEN concat('  ', status, chr(9)) ELSE status END AS status FROM c WHERE status NOT IN ('F', 'O')")
def load_cleaned_quarantine(spark, d):
    """Rejected rows keep their texts as they arrived, before cleaning."""
    return _cleaned(spark, d).read("quarantine_record").select("record_id", _field("raw_payload", "status").alias("status"))


@query("load_schema_decisions", """SELECT 'added' AS run, 'Added field: clerk (StringType())' AS decision, count(*) AS n FROM orders
  UNION ALL SELECT 'dropped', 'Dropped field: extra (StringType())', count(*) FROM orders""")
def load_schema_decisions(spark, d):
    """Columns that the stored schema does not know: added in one load, dropped in the next, both on record."""
    lake, orders = _lake(spark), table(spark, d, "orders")
    base = orders.select(F.col("o_orderkey").cast("string").alias("transaction_id"))
    load(lake, [], "orders", df=base, batch_id="first")
    load(lake, [], "orders", df=base.withColumn("clerk", F.lit("c")), batch_id="added")
    load(lake, [], "orders", df=base.withColumn("extra", F.lit("e")), evolve=False, batch_id="dropped")
    log = lake.read("run_log").filter("batch_id <> 'first'").groupBy(F.col("batch_id").alias("run"))
    return log.agg(F.max(F.when(F.col("status") == "schema_decision", F.col("error"))).alias("decision"), F.max("valid").alias("n"))


@query("upsert_late_row", "SELECT CAST(l_orderkey AS STRING) AS record_id, strftime(max(l_shipdate), '%Y-%m-%d') AS shipped FROM lineitem GROUP BY 1")
def upsert_late_row(spark, d):
    """Older versions that arrive after newer ones do not win, before the fold and after it."""
    warehouse = Warehouse(_lake(spark))
    for seq, pick in enumerate((F.max, F.min)):
        df = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.date_format(pick("l_shipdate"), "yyyy-MM-dd").alias("shipped"))
        rows = warehouse_rows(df, "items", record_id=F.col("l_orderkey").cast("string"), columns=["shipped"], order=order_key(df, ["shipped"]))
        warehouse.upsert(rows, f"b{seq}", seq, fold=seq == 0)
    read = warehouse.current().select("record_id", _field("data", "shipped").alias("before"))
    kept = shared_folder(spark)
    read.write.parquet(kept)
    warehouse.compact()
    after = warehouse.current().select("record_id", _field("data", "shipped").alias("after"))
    both = spark.read.parquet(kept).join(after, "record_id", "full_outer")
    return both.select("record_id", F.when(F.col("before") == F.col("after"), F.col("after")).alias("shipped"))


_AMOUNT = [Rule("amount_type", "type_check", "amount", {"expected_type": "float"}), Rule("amount_range", "range", "amount", {"min": 0})]
_LATE = Settings(latest_by=("ts",))


def _with_late_rows(spark, d):
    """Orders with odd keys are rejected for their amount; for every third key a newer, valid row is loaded; then the limit is lifted."""
    lake, orders = _lake(spark), table(spark, d, "orders")
    amount = F.when(F.col("o_orderkey") % 2 == 1, "-5").otherwise("6")
    rows = orders.select(F.col("o_orderkey").cast("string").alias("transaction_id"), amount.alias("amount"), F.col("o_orderdate").cast("timestamp").alias("ts"))
    newer = rows.filter(F.col("transaction_id").cast("long") % 3 == 0).withColumns({"amount": F.lit("7"), "ts": F.col("ts") + F.expr("INTERVAL 1 DAY")})
    load(lake, _AMOUNT, "orders", df=rows, settings=_LATE, batch_id="b1")
    load(lake, _AMOUNT, "orders", df=newer, settings=_LATE, batch_id="b2")
    return lake


@query("reprocess_late_row", """SELECT CAST(o_orderkey AS STRING) AS record_id, CASE WHEN o_orderkey % 3 = 0 THEN '7.0' WHEN o_orderkey % 2 = 1 THEN '-5.0' ELSE '6.0' END AS amount FROM orders""")
def reprocess_late_row(spark, d):
    """Reprocessed rows are loaded, but not over newer ones."""
    lake = _with_late_rows(spark, d)
    reprocess(lake, _AMOUNT[:1], "orders", settings=_LATE, batch_id="r1")
    return Warehouse(lake).current().select("record_id", _field("data", "amount").alias("amount"))


@query("reprocess_twice", """SELECT count(*) AS events, count(*) AS done, CAST(0 AS BIGINT) AS again, 2 AS runs FROM orders WHERE o_orderkey % 2 = 1""")
def reprocess_twice(spark, d):
    """A run repeated under its id finds nothing open and leaves each event once."""
    lake = _with_late_rows(spark, d)
    runs = [reprocess(lake, _AMOUNT[:1], "orders", settings=_LATE, batch_id="r1") for _ in range(2)]
    events = lake.read("quarantine_event").agg(F.count(F.lit(1)).alias("events"))
    done, again = (F.lit(r["success_count"]).cast("bigint") for r in runs)
    return events.select("events", done.alias("done"), again.alias("again"), F.lit(lake.read("run_log").filter("mode = 'reprocess'").count()).cast("int").alias("runs"))


@query("reprocess_number_out_of_range", """SELECT count(*) FILTER (o_orderkey % 5 = 0) AS still_open, count(*) FILTER (o_orderkey % 5 <> 0) AS loaded, CAST(0 AS BIGINT) AS nulls,
  'number_out_of_range' AS reason FROM orders""")
def reprocess_number_out_of_range(spark, d):
    """A whole number beyond BIGINT is rejected by a load and, under the same rules, by a reprocessing run."""
    lake = _lake(spark)
    n = F.when(F.col("o_orderkey") % 5 == 0, "99999999999999999999").otherwise("12")
    df = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("transaction_id"), n.alias("n"))
    rules = [Rule("n_type", "type_check", "n", {"expected_type": "int"})]
    load(lake, rules, "orders", df=df, batch_id="b1")
    failed = reprocess(lake, rules, "orders", batch_id="r1")["failed_count"]
    stored = Warehouse(lake).current().agg(F.count(F.lit(1)).alias("loaded"), F.count_if(_field("data", "n").isNull()).alias("nulls"))
    reason = lake.read("quarantine_record").select(F.get("failed_rules", F.lit(0)).alias("r")).distinct().first()["r"]
    return stored.select(F.lit(failed).cast("bigint").alias("still_open"), "loaded", "nulls", F.lit(reason).alias("reason"))


_AUDITED = _GOOD + """, counts AS (SELECT 'type_coercion' AS transformation_type, count(*) FILTER (place = 1 AND amount IS NOT NULL) AS events FROM good_rows
  UNION ALL SELECT 'warehouse_write', count(*) FILTER (place = 1) FROM good_rows UNION ALL SELECT 'quarantine', count(*) FILTER (NOT good) FROM judged UNION ALL SELECT 'deduplication', 1)
SELECT transformation_type, CAST(events AS BIGINT) AS events FROM counts UNION ALL SELECT 'ALL', CAST(sum(events) AS BIGINT) FROM counts"""


@query("audit_summary_of_runs", _AUDITED)
def audit_summary_of_runs(spark, d):
    """Events by type from the counts that each batch left, after the batch has run twice."""
    lake = _loaded(spark, d)
    load(lake, RULES, "orders", df=dirty(spark, d), settings=Settings(latest_by=_ORDER), batch_id="b1")
    return lineage.summary_of_runs(lake.read("run_log"), "orders")


@query("quality_trend_of_runs", judged_sql() + """SELECT 'orders' AS source_id, count(*) AS total, count(DISTINCT transaction_id) FILTER (good) AS valid,
  round(count(DISTINCT transaction_id) FILTER (good) / count(*), 4) AS pass_rate FROM judged""")
def quality_trend_of_runs(spark, d):
    """Rows and pass rate of a source from the run log alone."""
    return metrics.trend_of_runs(_loaded(spark, d).read("run_log"), "3650 days").drop("window_start")
