"""Streaming queries: the events cut into files, read as a stream until it is drained."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.catalog.common import query, table
from tidegate.operators import metrics
from tidegate.operators.validate import validate
from tidegate.plans.route import Settings
from tidegate.rules.model import Rule
from tidegate.session import shared_folder
from tidegate.sources.streams import file_stream, text_stream
from tidegate.streaming.job import StreamJob, stream_dedup
from tidegate.streaming.progress import ProgressLog, totals
from tidegate.tables.control import SchemaRegistry
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse

RULES = [
    Rule("event_id_required", "required_field", "event_id"),
    Rule("value_type", "type_check", "value", {"expected_type": "float"}),
    Rule("value_range", "range", "value", {"min": 5, "max": 100}),
    Rule("type_known", "custom", "event_type", {"expression": "value IN ('click', 'view', 'purchase', 'signup')"}),
]
COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in COLUMNS])  # all as text, so nothing is lost
_SETTINGS = Settings(id_columns=("event_id",), dedup_key="event_id", latest_by=("ts",))

_JUDGED = """WITH judged AS (SELECT *, value BETWEEN 5 AND 100 AS in_range, event_type <> 'error' AS known FROM events) """


def _event_files(spark, d, broken: bool = False) -> str:
    """The events as JSON lines in a fresh folder; with ``broken``, error events are cut off."""
    folder = shared_folder(spark)
    line = F.to_json(F.struct("event_id", F.col("ts").cast("string").alias("ts"), "user_id", "event_type", "value"))
    if broken:
        line = F.when(F.col("event_type") == "error", F.substring(line, 1, 20)).otherwise(line)
    table(spark, d, "events").select(line).write.text(folder)
    return folder


def _job(spark, alerts: bool = False, rules=RULES) -> StreamJob:
    lake = Lake(spark, shared_folder(spark), buckets=16)
    return StreamJob(lake, rules, "events", shared_folder(spark), settings=_SETTINGS, alerts=alerts, max_consecutive_failures=1)


def _drain(job: StreamJob, spark, folder: str) -> StreamJob:
    job.start(file_stream(spark, folder, "events", SCHEMA, max_files_per_trigger=1000), available_now=True)
    job.query.awaitTermination()
    return job


@query("stream_validate", _JUDGED + """SELECT count(*) AS total, sum((in_range AND known)::INT)::BIGINT AS valid, sum((NOT (in_range AND known))::INT)::BIGINT AS invalid FROM judged""")
def stream_validate(spark, d):
    """A stream drained into the tables, counted from its run log."""
    job = _drain(_job(spark), spark, _event_files(spark, d))
    runs = job.lake.read("run_log").filter("status = 'success'")
    return runs.agg(F.sum("total").alias("total"), F.sum("valid").alias("valid"), F.sum("invalid").alias("invalid"))


@query("stream_warehouse", _JUDGED + "SELECT CAST(event_id AS STRING) AS record_id, event_type, CAST(user_id AS STRING) AS user_id FROM judged WHERE in_range AND known")
def stream_warehouse(spark, d):
    job = _drain(_job(spark), spark, _event_files(spark, d))
    kind, user = (F.get_json_object("data", f"$.{c}").alias(c) for c in ("event_type", "user_id"))
    return Warehouse(job.lake).current().select("record_id", kind, user)


@query("stream_quarantine", _JUDGED + """SELECT CAST(event_id AS STRING) AS record_id, concat_ws(',', CASE WHEN NOT in_range THEN 'value_range' END, CASE WHEN NOT known THEN 'type_known' END) AS failed_rules
  FROM judged WHERE NOT (in_range AND known)""")
def stream_quarantine(spark, d):
    job = _drain(_job(spark), spark, _event_files(spark, d))
    return job.lake.read("quarantine_record").select("record_id", F.array_join("failed_rules", ",").alias("failed_rules"))


@query("stream_restart", _JUDGED + "SELECT sum((in_range AND known)::INT)::BIGINT AS loaded, sum((NOT (in_range AND known))::INT)::BIGINT AS rejected FROM judged")
def stream_restart(spark, d):
    """Started again on its checkpoint, a drained stream adds nothing."""
    folder, job = _event_files(spark, d), _job(spark)
    _drain(_drain(job, spark, folder), spark, folder)
    both = Warehouse(job.lake).log().select(F.lit(1).alias("good")).unionAll(job.lake.read("quarantine_record").select(F.lit(0)))
    return both.agg(F.count_if(F.col("good") == 1).alias("loaded"), F.count_if(F.col("good") == 0).alias("rejected"))


@query("stream_malformed", _JUDGED + "SELECT CASE WHEN known THEN 'value_range' ELSE 'malformed_record' END AS reason, count(*) AS n FROM judged WHERE NOT known OR NOT in_range GROUP BY 1")
def stream_malformed(spark, d):
    """Lines that are no JSON are set aside with their text, and the stream goes on."""
    rules = [RULES[1], RULES[2]]
    job = _drain(_job(spark, rules=rules), spark, _event_files(spark, d, broken=True))
    return job.lake.read("quarantine_record").groupBy(F.col("failed_rules")[0].alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("stream_alerts", _JUDGED + "SELECT 'value_range' AS rule_name, count(*) AS n FROM judged WHERE NOT in_range")
def stream_alerts(spark, d):
    """One alert per value out of its range."""
    job = _drain(_job(spark, alerts=True), spark, _event_files(spark, d))
    return job.lake.read("alert").groupBy("rule_name").agg(F.count(F.lit(1)).alias("n"))


def _typed_stream(spark, d):
    schema = T.StructType.fromDDL("event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE")
    return file_stream(spark, _event_files(spark, d), "events", schema, max_files_per_trigger=1000)


def first_rows(spark, d, key) -> str:
    """The folder of the first event per key within the watermark."""
    out = shared_folder(spark)
    _to_files(spark, stream_dedup(_typed_stream(spark, d).select("*", key.alias("key")), "key", "ts", "60 days"), out)
    return out


def _to_files(spark, stream, out=None):
    """Drain a stream into a folder and read the folder."""
    out = out or shared_folder(spark)
    q = stream.writeStream.format("parquet").option("checkpointLocation", shared_folder(spark)).option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out), q


@query("stream_dedup", """WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN concat(user_id, '/', event_type) END AS key, user_id FROM events)
SELECT user_id, count(DISTINCT key) AS keys, count(DISTINCT key) + count(*) FILTER (key IS NULL) AS n FROM e GROUP BY 1""")
def stream_first_rows(spark, d):
    """The first row per user and kind of event within the watermark; errors have no key and all pass."""
    key = F.when(F.col("event_type") != "error", F.concat_ws("/", "user_id", "event_type"))
    rows = spark.read.parquet(first_rows(spark, d, key))
    return rows.groupBy("user_id").agg(F.count("key").alias("keys"), F.count(F.lit(1)).alias("n"))


@query("stream_window_counts", """SELECT date_trunc('hour', ts) AS window_start, event_type AS source_id, count(*) AS total, sum((value BETWEEN 5 AND 100)::INT)::BIGINT AS valid,
  round(sum((value BETWEEN 5 AND 100)::INT) / count(*), 4) AS pass_rate FROM events GROUP BY 1, 2 HAVING date_trunc('hour', min(ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_window_counts(spark, d):
    """Pass rates of the windows the watermark has closed."""
    stream = validate(_typed_stream(spark, d).withWatermark("ts", "10 minutes"), [RULES[2]])
    rows, _ = _to_files(spark, metrics.quality_trend(stream, F.col("ts"), F.col("event_type")))
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("stream_progress", "SELECT count(*) AS input_rows, true AS beyond_recent, true AS every_batch FROM events")
def stream_progress(spark, d):
    """Progress of a query of more batches than Spark keeps reports of, from the table of reports."""
    folder = shared_folder(spark)
    table(spark, d, "events").select("event_id", "value").repartition(110, "event_id").write.parquet(folder)
    lake = Lake(spark, shared_folder(spark))
    with ProgressLog(lake):
        stream = file_stream(spark, folder, "events", T.StructType.fromDDL("event_id BIGINT, value DOUBLE"), "parquet", max_files_per_trigger=1)
        q = stream.writeStream.format("noop").option("checkpointLocation", shared_folder(spark)).trigger(availableNow=True).start()
        q.awaitTermination()
    seen = totals(lake.read("stream_progress"))
    return seen.select("input_rows", (F.col("batches") > 100).alias("beyond_recent"), (F.col("batches") == q.lastProgress["batchId"] + 1).alias("every_batch"))


@query("stream_new_field", """SELECT event_type, count(*) AS n, count(CASE WHEN event_id % 2 = 0 THEN 1 END) AS with_field, 2 AS versions FROM events GROUP BY 1""")
def stream_new_field(spark, d):
    """Raw JSON in which every second event has a field that the stored schema does not know: it is taken from the batch that brings it on."""
    folder, lake = shared_folder(spark), Lake(spark, shared_folder(spark), buckets=16)
    registry = SchemaRegistry(lake)
    registry.create("events", T.StructType.fromDDL("event_id BIGINT, event_type STRING, value DOUBLE"), inferred=False)
    extra = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("x"), F.col("user_id").cast("string"))).alias("extra")
    table(spark, d, "events").select(F.to_json(F.struct("event_id", "event_type", "value", extra))).write.text(folder)
    job = StreamJob(lake, RULES[:1], "events", shared_folder(spark), settings=_SETTINGS, max_consecutive_failures=1, raw_column="value")
    job.start(text_stream(spark, folder, "events", 1000), available_now=True)
    job.query.awaitTermination()
    kind, field = (F.get_json_object("data", f"$.{c}") for c in ("event_type", "extra"))
    rows = Warehouse(lake).current().groupBy(kind.alias("event_type")).agg(F.count(F.lit(1)).alias("n"), F.count(field).alias("with_field"))
    return rows.withColumn("versions", F.lit(registry.active("events").version))
