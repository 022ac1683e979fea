"""Queries on loading: packing, checksums, upserts, whole loads and file formats."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidegate.catalog.common import RULES, dirty, judged_sql, query, table
from tidegate.functions.payload import checksum
from tidegate.operators import dedup, metrics
from tidegate.operators.validate import validate
from tidegate.plans.batch import load
from tidegate.plans.route import Settings
from tidegate.session import folder_bytes, shared_folder
from tidegate.sources import files, streams
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, bucket_of, merge_rows, warehouse_rows

J = judged_sql()

# The stored table is the orders that are open or finished; the incoming batch is what the
# line items say about every order.
_JSON = """concat('{{"key":', CAST({key} AS STRING), ',"status":"', {status}, '"}}')"""
_STORED_JSON, _NEW_JSON = _JSON.format(key="o_orderkey", status="o_orderstatus"), _JSON.format(key="l_orderkey", status="max(l_linestatus)")
MERGE = f"""WITH stored AS (SELECT CAST(o_orderkey AS STRING) AS record_id, 'orders' AS source_id, {_STORED_JSON} AS data FROM orders WHERE o_orderstatus <> 'P'),
incoming AS (SELECT CAST(l_orderkey AS STRING) AS record_id, 'items' AS source_id, {_NEW_JSON} AS data FROM lineitem GROUP BY l_orderkey),
merged AS (SELECT coalesce(s.record_id, i.record_id) AS record_id, coalesce(s.source_id, i.source_id) AS source_id, coalesce(i.data, s.data) AS data
  FROM stored s FULL JOIN incoming i ON s.record_id = i.record_id)
"""


def _stored(spark, d):
    df = table(spark, d, "orders").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"))
    return warehouse_rows(df, "orders", 1, record_id=F.col("key").cast("string"))


def _incoming(spark, d):
    df = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.max("l_linestatus").alias("status"))
    return warehouse_rows(df, "items", 2, record_id=F.col("key").cast("string"))


@query("checksum", """SELECT o_orderkey, md5(concat('{"o_custkey":', CAST(o_custkey AS STRING), ',"o_orderkey":', CAST(o_orderkey AS STRING), ',"o_orderpriority":"', o_orderpriority, '","o_orderstatus":"', o_orderstatus, '"}')) AS checksum FROM orders""")
def checksum_of_records(spark, d):
    """MD5 of the key-sorted JSON, whatever order the columns come in."""
    df = table(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_orderpriority", "o_custkey")
    return df.select("o_orderkey", checksum(df).alias("checksum"))


@query("warehouse_rows", MERGE + "SELECT record_id, source_id, data, md5(data) AS checksum, CAST(2 AS BIGINT) AS schema_version_id FROM incoming")
def warehouse_layout(spark, d):
    return _incoming(spark, d).drop("processed_at", "order_key")


@query("change_detection", MERGE + """SELECT i.record_id, CASE WHEN s.record_id IS NULL THEN 'insert' WHEN s.data = i.data THEN 'unchanged' ELSE 'update' END AS change
  FROM incoming i LEFT JOIN stored s ON s.record_id = i.record_id""")
def change_detection(spark, d):
    return dedup.classify_changes(_stored(spark, d), _incoming(spark, d)).select("record_id", "change")


@query("upsert_counts", MERGE + """SELECT 'items' AS source_id, sum((s.record_id IS NULL)::INT)::BIGINT AS inserts, sum((s.data <> i.data)::INT)::BIGINT AS updates, sum((s.data = i.data)::INT)::BIGINT AS unchanged
  FROM incoming i LEFT JOIN stored s ON s.record_id = i.record_id""")
def upsert_counts(spark, d):
    return metrics.upserts(dedup.classify_changes(_stored(spark, d), _incoming(spark, d)))


@query("conflict_log", MERGE + "SELECT i.record_id, s.data AS stored_data, i.data AS incoming_data FROM incoming i JOIN stored s ON s.record_id = i.record_id WHERE s.data <> i.data")
def conflict_log(spark, d):
    return dedup.conflicts(_stored(spark, d), _incoming(spark, d))


_MERGED = MERGE + "SELECT record_id, source_id, data FROM merged"
_SHOWN = ("record_id", "source_id", "data")


@query("upsert_merge", _MERGED)
def upsert_merge(spark, d):
    """The upsert as one frame: new values win, the first source stays."""
    return merge_rows(_stored(spark, d), _incoming(spark, d)).select(*_SHOWN)


def _lake(spark) -> Lake:
    return Lake(spark, shared_folder(spark), buckets=16)


@query("upsert_table", _MERGED)
def upsert_table(spark, d):
    """Two batches written to a warehouse table, then read."""
    warehouse = Warehouse(_lake(spark))
    warehouse.upsert(_stored(spark, d), "b1", 1)
    warehouse.upsert(_incoming(spark, d), "b2", 2)
    return warehouse.current().select(*_SHOWN)


@query("upsert_twice", _MERGED)
def upsert_twice(spark, d):
    """Writing the same batch again changes nothing."""
    warehouse = Warehouse(_lake(spark))
    warehouse.upsert(_stored(spark, d), "b1", 1)
    for _ in range(2):
        warehouse.upsert(_incoming(spark, d), "b2", 2)
    return warehouse.current().select(*_SHOWN)


@query("upsert_log", _MERGED)
def upsert_log(spark, d):
    """Batches appended and not yet folded read the same."""
    warehouse = Warehouse(_lake(spark))
    warehouse.append(_stored(spark, d), "b1", 1)
    warehouse.append(_incoming(spark, d), "b2", 2)
    return warehouse.current().select(*_SHOWN)


@query("upsert_duplicates_in_batch", """SELECT CAST(l_orderkey AS STRING) AS record_id, max_by(l_shipdate, l_shipdate) AS shipped FROM lineitem GROUP BY 1""")
def upsert_duplicates_in_batch(spark, d):
    """A batch with many rows per record keeps the newest of each."""
    df = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate")
    rows = warehouse_rows(df, "items", record_id=F.col("l_orderkey").cast("string"), processed_at=F.col("l_shipdate"))
    warehouse = Warehouse(_lake(spark))
    warehouse.append(rows, "b1", 1)
    return warehouse.current().select("record_id", F.col("processed_at").cast("timestamp_ntz").alias("shipped"))


@query("upsert_buckets", MERGE + """SELECT state, records, records AS distinct_records, CAST(0 AS BIGINT) AS misplaced, true AS even, true AS grown FROM
  (SELECT 'before' AS state, count(*) AS records FROM stored UNION ALL SELECT 'after', count(*) FROM merged)""")
def upsert_buckets(spark, d):
    """Buckets before and after the table outgrows them: every record is in the bucket its hash names, none holds over twice its share
    (and 200), and the second fold has split some."""
    lake = Lake(spark, shared_folder(spark), buckets=3, bucket_bytes=1 << 30)
    warehouse, out, counts = Warehouse(lake), [], []
    for seq, (state, rows) in enumerate((("before", _stored(spark, d)), ("after", _incoming(spark, d)))):
        warehouse.upsert(rows, f"b{seq}", seq, fold=True)
        n = lake.bucket_count()
        counts.append(n)
        own = warehouse.base().groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct("record_id").alias("d"), F.count_if(bucket_of(F.col("record_id"), n) != F.col("bucket")).alias("off"))
        whole = own.agg(F.sum("n").alias("records"), F.sum("d").alias("distinct_records"), F.sum("off").alias("misplaced"), F.max("n").alias("most"))
        # a bucket that has not been split yet holds twice as much as one that has
        even = (F.col("most") <= 4 * F.col("records") / n + 200).alias("even")
        kept = shared_folder(spark)  # as the table is at this point
        whole.select(F.lit(state).alias("state"), "records", "distinct_records", "misplaced", even).write.parquet(kept)
        out.append(spark.read.parquet(kept))
        lake.bucket_bytes = max(1, folder_bytes(spark, lake.path("warehouse_data")) // 6)
    return out[0].unionByName(out[1]).withColumn("grown", F.lit(counts[0] == 3 and counts[1] > 5))


def _load_dirty(spark, d, **options):
    lake = _lake(spark)
    settings = Settings(deduplicate=True, latest_by=("ts", "ver", "row_id"))
    result = load(lake, RULES, "orders", df=dirty(spark, d), settings=settings, schema_fraction=1.0, batch_id="b1", **options)
    return lake, result


# every row is loaded, quarantined, or an older valid row of a loaded record
_LOADED = judged_sql(""",
newest AS (SELECT transaction_id, max(row(ts, ver, row_id)) AS last FROM judged WHERE good GROUP BY transaction_id),
kept AS (SELECT j.* FROM judged j JOIN newest n ON j.transaction_id = n.transaction_id AND row(j.ts, j.ver, j.row_id) = n.last WHERE good
  UNION ALL SELECT * FROM judged WHERE NOT good)""")


@query("load_counts", judged_sql() + """SELECT count(*) AS total, count(DISTINCT transaction_id) FILTER (good) AS valid, count(*) FILTER (NOT good) AS invalid,
  count(*) FILTER (good) - count(DISTINCT transaction_id) FILTER (good) AS duplicates FROM judged""")
def load_counts(spark, d):
    """A whole load of the dirty view: read, validate, keep the newest valid rows, write, count."""
    lake, _ = _load_dirty(spark, d)
    return lake.read("run_log").select("total", "valid", "invalid", "duplicates")


@query("load_warehouse", _LOADED + "SELECT transaction_id AS record_id, status, CAST(row_id AS STRING) AS row_id FROM kept WHERE good")
def load_warehouse(spark, d):
    lake, _ = _load_dirty(spark, d)
    status, row_id = (F.get_json_object("data", f"$.{c}").alias(c) for c in ("status", "row_id"))
    return Warehouse(lake).current().select("record_id", status, row_id)


@query("load_quarantine", _LOADED + "SELECT transaction_id AS record_id, CAST(row_id AS STRING) AS row_id, amount, failed_rules FROM kept WHERE NOT good")
def load_quarantine(spark, d):
    """Rejected rows keep their payload as it arrived."""
    lake, _ = _load_dirty(spark, d)
    row_id, amount = (F.get_json_object("raw_payload", f"$.{c}").alias(c) for c in ("row_id", "amount"))
    return lake.read("quarantine_record").select("record_id", row_id, amount, F.array_join("failed_rules", ",").alias("failed_rules"))


@query("load_audit", _LOADED + """SELECT 'type_coercion' AS transformation_type, sum((good AND amount IS NOT NULL)::INT)::BIGINT AS n FROM kept UNION ALL SELECT 'warehouse_write', sum(good::INT)::BIGINT FROM kept
  UNION ALL SELECT 'quarantine', sum((NOT good)::INT)::BIGINT FROM kept UNION ALL SELECT 'deduplication', 1""")
def load_audit(spark, d):
    lake, _ = _load_dirty(spark, d)
    return lake.read("audit_log").groupBy("transformation_type").agg(F.count(F.lit(1)).alias("n"))


@query("load_dry_run", J + """SELECT 'transaction_id_required' AS rule_name, sum(r1::INT)::BIGINT AS failure_count FROM judged UNION ALL SELECT 'transaction_id_format', sum(r2::INT)::BIGINT FROM judged
  UNION ALL SELECT 'amount_required', sum(r3::INT)::BIGINT FROM judged UNION ALL SELECT 'amount_type', sum(r4::INT)::BIGINT FROM judged UNION ALL SELECT 'amount_range', sum(r5::INT)::BIGINT FROM judged
  UNION ALL SELECT 'status_values', sum(r6::INT)::BIGINT FROM judged""")
def load_dry_run(spark, d):
    """Failures per rule without writing a table."""
    _, result = _load_dirty(spark, d, dry_run=True)
    rows = [(f["rule_name"], f["failure_count"]) for f in result["validation_failures_by_rule"]]
    return spark.createDataFrame(rows, "rule_name STRING, failure_count BIGINT")


_COUNTS = J + "SELECT count(*) AS total, sum(good::INT)::BIGINT AS valid FROM judged"


def _counts(df):
    v = validate(df, RULES)
    return v.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("_v.status") == "valid").alias("valid"))


@query("csv_scan", _COUNTS)
def csv_scan(spark, d):
    """The dirty view as CSV files, read as text and validated."""
    folder = shared_folder(spark)
    dirty(spark, d).write.option("header", True).csv(folder)
    return _counts(files.read(spark, folder, "CSV", infer_schema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False))


@query("csv_mixed_headers", """SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars, count(CASE WHEN lang <> 'en' THEN source END) AS with_source,
  0::BIGINT AS malformed FROM documents WHERE lang IS NOT NULL GROUP BY 1""")
def csv_mixed_headers(spark, d):
    """A folder whose files name their columns differently: other orders, and a column that some lack."""
    folder = shared_folder(spark)
    docs = table(spark, d, "documents").filter("lang IS NOT NULL")
    docs.filter("lang = 'en'").select("doc_id", "lang", "n_chars").write.option("header", True).csv(f"{folder}/en")
    docs.filter("lang <> 'en' AND doc_id % 2 = 0").select("source", "n_chars", "doc_id", "lang").write.option("header", True).csv(f"{folder}/even")
    docs.filter("lang <> 'en' AND doc_id % 2 <> 0").select("lang", "n_chars", "doc_id", "source").write.option("header", True).csv(f"{folder}/odd")
    rows = files.read(spark, folder, "csv", infer_schema=False, mixed_headers=True, recursiveFileLookup=True)
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("n_chars").cast("bigint")).alias("chars"), F.count("source").alias("with_source"), F.count("_corrupt_record").alias("malformed")
    )


@query("csv_corrupt_lines", "SELECT sum((lang = 'en')::INT)::BIGINT AS malformed, sum((lang <> 'en')::INT)::BIGINT AS good, count(*) AS lines FROM documents")
def csv_corrupt_lines(spark, d):
    """Lines with too few columns survive as rejected rows with their text."""
    folder = shared_folder(spark)
    line = F.when(F.col("lang") == "en", F.concat_ws(",", "doc_id", "lang")).otherwise(F.concat_ws(",", "doc_id", "lang", "n_chars", "source"))
    table(spark, d, "documents").select(line).write.text(folder)
    schema = streams.T.StructType.fromDDL("doc_id STRING, lang STRING, n_chars STRING, source STRING, _corrupt_record STRING")
    v = validate(files.read(spark, folder, "csv", schema, header=False), [])
    bad = F.array_contains("_v.failed_rules", "malformed_record") & F.col("_corrupt_record").isNotNull()
    return v.agg(F.count_if(bad).alias("malformed"), F.count_if(F.col("_v.status") == "valid").alias("good"), F.count("doc_id").alias("lines"))


@query("json_scan", _COUNTS)
def json_scan(spark, d):
    folder = shared_folder(spark)
    df = dirty(spark, d)
    df.write.option("ignoreNullFields", False).json(folder)
    return _counts(files.read(spark, folder, "json", streams.text_schema(df.schema)))


@query("json_array_scan", "SELECT lang, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1 UNION ALL SELECT 'not an object', count(DISTINCT source), NULL FROM documents")
def json_array_scan(spark, d):
    """JSON arrays, one per file and part of a source, and files with elements that are no objects."""
    folder = shared_folder(spark)
    docs = table(spark, d, "documents").withColumn("part", F.floor(F.col("doc_id") / 20_000))
    # every line opens or goes on with the array, the last one closes it: rows stream through the sort, none are gathered
    order = Window.partitionBy("source", "part").orderBy("doc_id")
    start = F.when(F.row_number().over(order) == 1, "[").otherwise(",")
    end = F.when(F.lead(F.lit(1)).over(order).isNull(), "]").otherwise("")
    item = F.to_json(F.struct("doc_id", "lang", "n_chars"))
    docs.select(F.concat(start, item, end).alias("value"), "source", "part").write.partitionBy("source", "part").text(f"{folder}/objects")
    docs.select("source").distinct().select(F.lit('["not an object"]').alias("value"), "source").write.partitionBy("source").text(f"{folder}/others")
    schema = streams.T.StructType.fromDDL("doc_id BIGINT, lang STRING, n_chars BIGINT, _corrupt_record STRING")
    df = files.read_json_elements(spark, folder, schema, recursiveFileLookup=True)
    name = F.when(F.col("_corrupt_record").isNotNull(), "not an object").otherwise(F.col("lang"))
    return df.groupBy(name.alias("lang")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("parquet_scan", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def parquet_scan(spark, d):
    df = files.read(spark, f"{d}/orders.parquet", "parquet")
    return df.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("kafka_values", "SELECT event_id, event_type, value, 'events' AS topic FROM events WHERE event_type <> 'error' UNION ALL SELECT NULL, NULL, NULL, 'events' FROM events WHERE event_type = 'error'")
def kafka_values(spark, d):
    """Binary message values parsed to columns; broken ones keep their text."""
    df = table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.lit("{broken")).otherwise(F.to_json(F.struct("event_id", "event_type", "value")))
    raw = df.select(F.lit("k").alias("key"), text.cast("binary").alias("value"), F.lit("events").alias("topic"))
    schema = streams.T.StructType.fromDDL("event_id BIGINT, event_type STRING, value DOUBLE")
    return streams.parse_kafka_values(raw, schema).select("event_id", "event_type", "value", "topic")
