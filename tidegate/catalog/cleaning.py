"""Queries on values and schemas: coercion, normalising, duplicates, ids, inference, versions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog.common import RULES, dirty, judged_sql, query, table
from tidegate.functions.payload import payload, payload_field, record_id
from tidegate.operators import clean, dedup, metrics, schema as S
from tidegate.operators.validate import coerce_types

J = judged_sql()


@query("coerce_values", J + "SELECT row_id, ver, amount AS raw_amount, amount_value AS amount FROM judged")
def coerce_values(spark, d):
    """Text becomes a number where it can; the original stays beside it."""
    return coerce_types(dirty(spark, d), RULES).select("row_id", "ver", F.col("_raw.amount").alias("raw_amount"), "amount")


@query("coercion_outcomes", J + """SELECT 'amount' AS field_name, 'str' AS from_type, 'float' AS to_type, 'success' AS status, count(amount_value) AS n FROM judged
  UNION ALL SELECT 'amount', 'str', 'float', 'failure', sum(r4::INT)::BIGINT FROM judged""")
def coercion_outcomes(spark, d):
    return metrics.coercions(coerce_types(dirty(spark, d), RULES), {"amount": "float"})


_MIXED_DATES = """CASE WHEN o_orderstatus = 'F' THEN concat(substr(t, 6, 2), '/', substr(t, 9, 2), '/', substr(t, 1, 4))
  WHEN o_orderstatus = 'P' THEN concat('on ', t) ELSE t END"""
_ORDER_DATES = f"SELECT o_orderkey, {_MIXED_DATES} AS day_text FROM (SELECT *, substr(CAST(o_orderdate AS STRING), 1, 10) AS t FROM {{orders}}) q"


@query("normalize_dates", """SELECT o_orderkey, day_text AS before, CASE WHEN day_text LIKE '%/%' THEN strftime(strptime(day_text, '%m/%d/%Y'), '%Y-%m-%d') ELSE day_text END AS day_text
  FROM (""" + _ORDER_DATES.format(orders="orders") + ")")
def normalize_dates(spark, d):
    """Two date spellings become one; other text is left as it is."""
    df = spark.sql(_ORDER_DATES, orders=table(spark, d, "orders"))
    return clean.normalize_dates(df, ["day_text"]).select("o_orderkey", F.col("_before_dates.day_text").alias("before"), "day_text")


@query("trim_fields", r"""SELECT doc_id, regexp_replace(regexp_replace(padded, '^\s+', ''), '\s+$', '') AS text, padded <> regexp_replace(regexp_replace(padded, '^\s+', ''), '\s+$', '') AS changed
  FROM (SELECT doc_id, CASE WHEN lang = 'en' THEN concat('  ', text, chr(9)) ELSE text END AS padded FROM documents)""")
def trim_fields(spark, d):
    padded = F.when(F.col("lang") == "en", F.concat(F.lit("  "), "text", F.lit("\t"))).otherwise(F.col("text"))
    df = clean.trim_fields(table(spark, d, "documents").select("doc_id", padded.alias("text")))
    return df.select("doc_id", "text", (F.col("text") != F.col("_before_trim.text")).alias("changed"))


@query("dedup_latest", J + """SELECT transaction_id, row_id, ver, copies FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY transaction_id) AS copies
    FROM judged WHERE transaction_id IS NOT NULL WINDOW w AS (PARTITION BY transaction_id ORDER BY ts DESC, ver DESC, row_id DESC)) WHERE rn = 1
  UNION ALL SELECT transaction_id, row_id, ver, 1 FROM judged WHERE transaction_id IS NULL""")
def dedup_latest(spark, d):
    """The newest row per transaction; rows without an id all stay."""
    out = dedup.dedup_latest(dirty(spark, d), "transaction_id", ["ts", "ver", "row_id"])
    return out.select("transaction_id", "row_id", "ver", F.col("_copies").alias("copies"))


@query("dedup_any_count", J + """SELECT count(*) AS total, count(DISTINCT transaction_id) + sum((transaction_id IS NULL)::INT)::BIGINT AS kept,
  count(*) - count(DISTINCT transaction_id) - sum((transaction_id IS NULL)::INT)::BIGINT AS duplicates FROM judged""")
def dedup_any_count(spark, d):
    return dedup.duplicates_removed(dedup.dedup_any(dirty(spark, d)))


@query("duplicate_report", J + """SELECT transaction_id, count(*) AS copies, count(DISTINCT coalesce(amount, '-')) AS distinct_values,
  max_by(coalesce(amount, '-'), ver * 1000000000000 + row_id) AS kept_value FROM judged WHERE transaction_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def duplicate_report(spark, d):
    """Ids that occur more than once, with how many different amounts and which one stays."""
    return dedup.duplicate_report(dirty(spark, d), "transaction_id", ["ver", "row_id"], F.coalesce("amount", F.lit("-")))


@query("duplicate_values", J + """SELECT transaction_id, status AS value, count(*) AS copies FROM judged
  WHERE transaction_id IN (SELECT transaction_id FROM judged GROUP BY 1 HAVING count(*) > 1) GROUP BY ALL""")
def duplicate_values(spark, d):
    return dedup.duplicate_values(dirty(spark, d), "transaction_id", F.col("status"))


@query("record_id_choice", J + """SELECT row_id, ver, coalesce(nullif(transaction_id, ''), nullif(CAST(row_id AS STRING), '')) AS chosen FROM judged""")
def record_id_choice(spark, d):
    df = dirty(spark, d).withColumn("record_id", F.col("row_id"))
    return df.select("row_id", "ver", record_id(df).alias("chosen"))


@query("payload_fields", """SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority, CAST(o_custkey AS STRING) AS customer FROM orders""")
def payload_fields(spark, d):
    """Records packed as JSON and single fields read back."""
    df = table(spark, d, "orders")
    packed = df.select("o_orderkey", payload(df).alias("data"))
    names = {"status": "o_orderstatus", "priority": "o_orderpriority", "customer": "o_custkey"}
    return packed.select("o_orderkey", *[payload_field(F.col("data"), p).alias(n) for n, p in names.items()])


@query("json_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_field(spark, d):
    return table(spark, d, "events").select("event_id", payload_field(F.col("props"), "k").alias("k"))


@query("extra_columns_kept", "SELECT c_custkey, c_name, CAST(NULL AS STRING) AS c_phone, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def extra_columns_kept(spark, d):
    """Columns the schema does not know join it; known but absent ones are null."""
    df = table(spark, d, "customer")
    known = S.T.StructType.fromDDL("c_custkey BIGINT, c_name STRING, c_phone STRING")
    return clean.fit_columns(df, known, evolve=True)[0]


@query("extra_columns_dropped", "SELECT c_custkey, c_name FROM customer")
def extra_columns_dropped(spark, d):
    known = S.T.StructType.fromDDL("c_custkey BIGINT, c_name STRING")
    return clean.fit_columns(table(spark, d, "customer"), known, evolve=False)[0]


@query("cast_to_schema", J + "SELECT row_id, ver, amount_value AS amount, amount AS raw_amount FROM judged")
def cast_to_schema(spark, d):
    """Text read as the types of a stored schema."""
    df = clean.cast_to_schema(dirty(spark, d), S.T.StructType.fromDDL("amount DOUBLE, email STRING"))
    return df.select("row_id", "ver", "amount", F.col("_raw.amount").alias("raw_amount"))


@query("sample_rows")
def sample_rows(spark, d):
    """A random tenth of a table (a sampling operator has no SQL twin)."""
    return clean.sample_rows(table(spark, d, "lineitem"), 0.1, seed=7).select("l_orderkey", "l_linenumber")


@query("sample_by_key", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE substr(md5(concat(l_orderkey, '-', l_linenumber)), 1, 8) < '1999999a'")
def sample_by_key(spark, d):
    """A tenth of a table by the hash of its key: repeatable anywhere."""
    return clean.sample_by_key(table(spark, d, "lineitem"), 0.1, "l_orderkey", "l_linenumber").select("l_orderkey", "l_linenumber")


@query("schema_confidence", J + """SELECT round((7.0 + (count(transaction_id) + count(amount) + count(ts) + count(email) + count(status) + count(row_id) + count(ver)) / count(*)) / 14, 2) AS confidence FROM judged""")
def schema_confidence(spark, d):
    """How far the names and the filled share of columns speak for a schema."""
    return S.confidence_of(S.confidence_parts(dirty(spark, d), 1.0))


@query("schema_confidence_parts", J + """SELECT 'transaction_id' AS field, CAST(1.0 AS DOUBLE) AS name_score, count(transaction_id) / count(*) AS filled FROM judged
  UNION ALL SELECT 'field1', 0.5, count(amount) / count(*) FROM judged UNION ALL SELECT '_c2', 0.5, count(email) / count(*) FROM judged""")
def schema_confidence_parts(spark, d):
    df = dirty(spark, d).select("transaction_id", F.col("amount").alias("field1"), F.col("email").alias("_c2"))
    return S.confidence_parts(df, 1.0)


@query("type_consistency", J + """SELECT 'amount' AS field, sum((NOT r3)::INT)::BIGINT AS filled, round(CAST(0.0 AS DOUBLE) + sum((NOT r3 AND regexp_matches(amount, '^-?[0-9]+$'))::INT) / sum((NOT r3)::INT), 4) AS share_int,
    round(sum((amount_value IS NOT NULL)::INT) / sum((NOT r3)::INT), 4) AS share_float, CAST(0.0 AS DOUBLE) AS share_bool, CAST(0.0 AS DOUBLE) AS share_timestamp FROM judged
  UNION ALL SELECT 'status', count(status), 0.0, 0.0, 0.0, 0.0 FROM judged""")
def type_consistency(spark, d):
    """Which share of each text column reads as a number, a boolean or a timestamp."""
    return S.type_consistency(dirty(spark, d), ["amount", "status"])


@query("typed_schema", """SELECT 'digits' AS field, 'bigint' AS type, false AS review FROM orders HAVING count(*) > 0 UNION ALL SELECT 'price', 'double', false FROM orders HAVING count(*) > 0
  UNION ALL SELECT 'status', 'string', false FROM orders HAVING count(*) > 0 UNION ALL SELECT 'mostly', 'string', true FROM orders HAVING count(*) > 0""")
def typed_schema(spark, d):
    """Types drawn from whole columns; doubtful ones stay text and are marked."""
    df = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("digits"), F.col("o_totalprice").cast("string").alias("price"), F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") == "5-LOW", "low").otherwise(F.col("o_custkey").cast("string")).alias("mostly"))
    found = S.typed_schema(df)
    rows = [(f.name, f.dataType.simpleString(), bool(f.metadata.get("needs_type_review"))) for f in found]
    return spark.createDataFrame(rows, "field STRING, type STRING, review BOOLEAN")


@query("observed_json_schema", """SELECT 'k' AS field, 'bigint' AS type FROM events HAVING count(*) > 0""")
def observed_json_schema(spark, d):
    """The schema raw JSON really has, merged over all events."""
    found = S.observed_schema(table(spark, d, "events"), "props")
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found], "field STRING, type STRING")


@query("schema_drift", """SELECT 'new_field' AS change_type, 'k' AS field, false AS breaking FROM events HAVING count(*) > 0
  UNION ALL SELECT 'type_change', 'event_type', true FROM events HAVING count(*) > 0""")
def schema_drift(spark, d):
    """Changes of the data against a baseline schema, from the events themselves."""
    df = table(spark, d, "events")
    texts = df.select(F.concat(F.lit('{"event_type":"'), "event_type", F.lit('","k":'), F.get_json_object("props", "$.k"), F.lit("}")).alias("t"))
    baseline = S.T.StructType.fromDDL("event_type BOOLEAN, note STRING")
    diff = S.drift(baseline, S.observed_schema(texts, "t"))
    rows = [("new_field", n, False) for n in diff["added_fields"]] + [("type_change", t["field"], not t["compatible"]) for t in diff["type_changes"]]
    return spark.createDataFrame(rows, "change_type STRING, field STRING, breaking BOOLEAN")


def _versions(spark, d):
    """Schema versions as many as orders: one source per customer, retired when finished."""
    return table(spark, d, "orders").select(
        F.concat(F.lit("src"), F.col("o_custkey").cast("string")).alias("source_id"), F.col("o_orderkey").cast("int").alias("version"),
        F.col("o_orderpriority").alias("schema_definition"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")).alias("deprecated_at"))


_VERSIONS = """WITH v AS (SELECT concat('src', CAST(o_custkey AS STRING)) AS source_id, CAST(o_orderkey AS INT) AS version, o_orderpriority AS schema_definition,
  CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS deprecated_at FROM orders) """


@query("active_schema", _VERSIONS + "SELECT source_id, max(version) AS version, max_by(schema_definition, version) AS schema_definition FROM v WHERE deprecated_at IS NULL GROUP BY 1")
def active_schema(spark, d):
    """Per source the newest version that is not retired."""
    return S.active_schemas(_versions(spark, d)).drop("deprecated_at")


@query("schema_history", _VERSIONS + "SELECT source_id, version, deprecated_at FROM v WHERE source_id = 'src10' ORDER BY version DESC LIMIT 10")
def schema_history(spark, d):
    return S.schema_history(_versions(spark, d), "src10").select("source_id", "version", "deprecated_at")


@query("schema_by_version", _VERSIONS + "SELECT v.source_id, v.version, v.schema_definition FROM v JOIN (SELECT source_id, max(version) AS version FROM v GROUP BY 1) m ON v.source_id = m.source_id AND v.version = m.version")
def schema_by_version(spark, d):
    """Exact lookup of one version per source."""
    v = _versions(spark, d)
    wanted = v.groupBy("source_id").agg(F.max("version").alias("version"))
    return v.join(wanted, ["source_id", "version"]).select("source_id", "version", "schema_definition")


@query("next_schema_version", _VERSIONS + "SELECT coalesce(max(version), 0) + 1 AS next_version FROM v WHERE source_id = 'src10'")
def next_schema_version(spark, d):
    return S.next_version(_versions(spark, d), "src10")


@query("files_with_different_columns", """SELECT doc_id AS id, text, lang, CAST(NULL AS STRING) AS url FROM documents UNION ALL SELECT page_id, NULL, NULL, url FROM pages""")
def files_with_different_columns(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "lang")
    pages = table(spark, d, "pages").select(F.col("page_id").alias("id"), "url")
    return S.union_by_name([docs, pages])
