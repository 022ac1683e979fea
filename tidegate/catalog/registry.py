"""Queries on stored schemas and stored rules, applied to the data they describe."""

from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.catalog.common import EMAIL, dirty, judged_sql, query, table
from tidegate.catalog.streams import first_rows
from tidegate.operators import clean, schema as S
from tidegate.operators.validate import validate
from tidegate.rules.loader import parse_rules
from tidegate.rules.model import RuleBuilder, check_rules, rule_summary, rules_frame
from tidegate.session import shared_folder
from tidegate.streaming.job import use_rocksdb_state
from tidegate.tables.control import SchemaRegistry
from tidegate.tables.lake import Lake

J = judged_sql()

#: As a rule file holds it: fields with their rules.
RULE_FILE = {
    "rules": {
        "transaction_id": [{"type": "required", "name": "id_there"}, {"type": "regex", "params": {"pattern": "^TXN[0-9]{10}$"}}],
        "amount": [{"type": "type_check", "params": {"expected_type": "float"}}, {"type": "range", "params": {"min": 0.01, "max": 1000000.0}}],
        "email": [{"type": "regex", "name": "email_form", "severity": "warning", "params": {"pattern": EMAIL}}],
        "status": [{"type": "required", "name": "status_there", "enabled": False}],
    }
}


def _failures(spark, d, rules):
    """Rows per failed rule."""
    v = validate(dirty(spark, d), rules)
    return v.select(F.explode("_v.failed_rules").alias("rule_name")).groupBy("rule_name").agg(F.count(F.lit(1)).alias("failures"))


@query("rules_of_a_file", J + """SELECT 'id_there' AS rule_name, 'required_field' AS rule_type, count(*) FILTER (r1) AS failures FROM judged
  UNION ALL SELECT 'transaction_id_regex_1', 'regex', count(*) FILTER (r2) FROM judged
  UNION ALL SELECT 'amount_type_check_0', 'type_check', count(*) FILTER (r4) FROM judged
  UNION ALL SELECT 'amount_range_1', 'range', count(*) FILTER (r5) FROM judged""")
def rules_of_a_file(spark, d):
    """Rules as a file states them, stored as text and checked, with what fails each error rule."""
    rules = check_rules(parse_rules(json.loads(json.dumps(RULE_FILE))))
    found = _failures(spark, d, rules)
    return rules_frame(spark, rules).filter("enabled").join(found, "rule_name").select("rule_name", "rule_type", "failures")


@query("rules_of_a_builder", J + """SELECT 'all' AS name, 'total' AS kind, 4::BIGINT AS rules, count(*) FILTER (r1) + count(*) FILTER (r4) + count(*) FILTER (r5) AS failures FROM judged
  UNION ALL SELECT 'error', 'severity', 3, count(*) FILTER (r1) + count(*) FILTER (r4) + count(*) FILTER (r5) FROM judged
  UNION ALL SELECT 'warning', 'severity', 1, 0 FROM judged HAVING count(*) > 0
  UNION ALL SELECT 'required_field', 'type', 1, count(*) FILTER (r1) FROM judged
  UNION ALL SELECT 'type_check', 'type', 1, count(*) FILTER (r4) FROM judged
  UNION ALL SELECT 'range', 'type', 1, count(*) FILTER (r5) FROM judged
  UNION ALL SELECT 'regex', 'type', 1, 0 FROM judged HAVING count(*) > 0""")
def rules_of_a_builder(spark, d):
    """The summary of a rule set built in code, with the failures behind each count."""
    builder = RuleBuilder().add_required_field("transaction_id").add_type_check("amount", "float").add_range("amount", 0.01, 1000000.0)
    rules = builder.add_regex("email", EMAIL, severity="warning").build()
    frame = rules_frame(spark, rules)
    failed = frame.join(_failures(spark, d, rules), "rule_name", "left").fillna(0, ["failures"])
    sums = failed.groupingSets([["rule_type"], ["severity"], []], "rule_type", "severity").agg(F.sum("failures").alias("failures"))
    sums = sums.select(F.coalesce("rule_type", "severity", F.lit("all")).alias("name"), "failures")
    return rule_summary(frame).join(sums, "name").select("name", "kind", "rules", "failures")


@query("schema_merge", """SELECT 'event_id' AS field, 'bigint' AS type, count(*) AS filled, 'Type changed: event_id (IntegerType() -> LongType())' AS change FROM events
  UNION ALL SELECT 'value', 'double', count(value), 'Type changed: value (FloatType() -> DoubleType())' FROM events
  UNION ALL SELECT 'event_type', 'string', count(event_type), NULL FROM events
  UNION ALL SELECT 'user_id', 'bigint', count(user_id) FILTER (event_id % 2 = 1), 'Added field: user_id (LongType())' FROM events""")
def schema_merge(spark, d):
    """Two deliveries with different columns and types, read under their merged schema."""
    events, folder = table(spark, d, "events"), shared_folder(spark)
    narrow = events.filter("event_id % 2 = 0").select(F.col("event_id").cast("int"), F.col("value").cast("float"), "event_type")
    wide = events.filter("event_id % 2 = 1").select("event_id", "value", "event_type", "user_id")
    narrow.write.parquet(f"{folder}/first")
    wide.write.parquet(f"{folder}/second")
    parts = [spark.read.parquet(f"{folder}/{name}") for name in ("first", "second")]
    merged, texts = S.merge_schemas(parts[0].schema, parts[1].schema, allow_type_changes=True)
    both = [p.select(*[(F.col(f.name) if f.name in p.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in merged]) for p in parts]
    counts = both[0].unionByName(both[1]).agg(*[F.count(n).alias(n) for n in merged.names])
    change = {n: next((t for t in texts if f" {n} (" in t), None) for n in merged.names}
    rows = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("filled"), F.lit(change[f.name]).cast("string").alias("change")) for f in merged]
    return counts.select(F.inline(F.array(*rows)))


def _evolved(spark, d) -> SchemaRegistry:
    """A source whose schema was inferred, then grew by a field, then lost one."""
    registry = SchemaRegistry(Lake(spark, shared_folder(spark)))
    orders = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("col1"), "o_totalprice")
    registry.get_or_infer("orders", orders, fraction=1.0)
    grown = T.StructType([*orders.schema.fields, T.StructField("o_orderstatus", T.StringType())])
    registry.evolve("orders", grown)
    registry.evolve("orders", grown)  # no change, no version
    registry.evolve("orders", T.StructType([f for f in grown if f.name != "col1"]))
    return registry


@query("schema_registry", """SELECT 1 AS version, 3 AS fields, false AS deprecated, true AS compatible,
    round((2.5 + 2 + count(CASE WHEN o_orderkey % 3 > 0 THEN 1 END) / count(*)) / 6, 2) AS confidence FROM orders
  UNION ALL SELECT 2, 4, true, true, NULL FROM orders HAVING count(*) > 0 UNION ALL SELECT 3, 3, false, false, NULL FROM orders HAVING count(*) > 0""")
def schema_registry(spark, d):
    """Versions of a source: inferred with the confidence of its data, evolved, and retired where the next one does not fit."""
    registry = _evolved(spark, d)
    fields = {v: registry.get("orders", v) for v in (1, 2, 3)}
    fits = {1: True, **{v: S.compare_schemas(fields[v - 1], fields[v])["compatible"] for v in (2, 3)}}
    pick = lambda of: F.create_map(*[F.lit(x) for v in fields for x in (v, of(v))])[F.col("version")]
    return registry.history("orders").select(
        F.col("version").cast("int").alias("version"), pick(lambda v: len(fields[v])).alias("fields"), F.col("deprecated_at").isNotNull().alias("deprecated"),
        pick(fits.get).alias("compatible"), "confidence")


@query("schema_version_read", """SELECT 1 AS version, count(*) AS n, count(o_totalprice) AS prices, 0::BIGINT AS statuses FROM orders
  UNION ALL SELECT 3, count(*), count(o_totalprice), count(o_orderstatus) FROM orders""")
def schema_version_read(spark, d):
    """Text data read by an exact version of its schema, and by the active one."""
    registry, folder = _evolved(spark, d), shared_folder(spark)
    names = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    table(spark, d, "orders").select(*[F.col(c).cast("string") for c in names]).write.parquet(folder)
    text, out = spark.read.parquet(folder), []
    for version, schema in ((1, registry.get("orders", 1)), (3, registry.get("orders"))):
        typed = clean.cast_to_schema(text.select(*[c for c in names if c in schema.names]), schema)
        status = F.count("o_orderstatus") if "o_orderstatus" in schema.names else F.lit(0).cast("bigint")
        out.append(typed.agg(F.count(F.lit(1)).alias("n"), F.count("o_totalprice").alias("prices"), status.alias("statuses")).select(F.lit(version).alias("version"), "*"))
    return out[0].unionByName(out[1])


@query("schema_from_csv", """SELECT 'id' AS field, 'int' AS type, 1.0::DOUBLE AS confidence FROM events HAVING count(*) > 0
  UNION ALL SELECT 'kind', 'string', 1.0 FROM events HAVING count(*) > 0 UNION ALL SELECT 'number', 'double', 1.0 FROM events HAVING count(*) > 0""")
def schema_from_csv(spark, d):
    """Names, types and confidence read from CSV files."""
    folder = shared_folder(spark)
    events = table(spark, d, "events").filter("value IS NOT NULL AND event_type IS NOT NULL")
    events.select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.col("value").alias("number")).write.option("header", True).csv(folder)
    schema, confidence = S.infer_from_csv(spark, folder)
    rows = [F.struct(F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(float(confidence)).alias("confidence")) for f in schema]
    return spark.read.csv(folder, header=True).agg(F.count(F.lit(1)).alias("n")).filter("n > 0").select(F.inline(F.array(*rows)))


@query("stream_rocksdb", """SELECT user_id, count(DISTINCT event_type) AS n FROM events GROUP BY 1""")
def stream_rocksdb(spark, d):
    """Stream de-duplication with its state in RocksDB, in a session of its own."""
    own = spark.newSession()
    use_rocksdb_state(own)
    rows = first_rows(own, d, F.concat_ws("/", "user_id", "event_type"))
    return table(spark, d, "events").join(spark.read.parquet(rows).select("event_id"), "event_id", "left_semi").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
