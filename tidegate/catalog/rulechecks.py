"""Queries on rules: each kind of rule, the engine's lists, the counts drawn from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidegate.catalog.common import FAILURES_SQL, RULES, dirty, judged, judged_sql, query, table
from tidegate.functions.payload import valid_identifier
from tidegate.operators import metrics
from tidegate.operators.validate import split, validate
from tidegate.rules.model import Rule, rules_frame

J = judged_sql()


def _verdict(df, rule: Rule, *keys: str):
    """Keys, pass flag and message of one rule."""
    v = validate(df, [rule])
    return v.select(
        *keys, (F.size("_v.failed_rules") == 0).alias("ok"), F.array_join("_v.error_messages", "|").alias("message")
    )


@query("validate_status_counts", J + "SELECT CASE WHEN good THEN 'valid' ELSE 'invalid' END AS status, count(*) AS n FROM judged GROUP BY 1")
def validate_status_counts(spark, d):
    """Valid and invalid rows of the dirty view."""
    good = F.when(F.col("_v.status") == "valid", "valid").otherwise("invalid")
    return judged(spark, d).groupBy(good.alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("required_field", J + """SELECT row_id, ver, NOT r1 AS ok, CASE WHEN r1 THEN 'Field value is null' ELSE '' END AS message FROM judged""")
def required_field(spark, d):
    return _verdict(dirty(spark, d), RULES[0], "row_id", "ver")


@query("required_field_blank", J + """SELECT row_id, ver, NOT r3 AS ok,
  CASE WHEN amount IS NULL THEN 'Field value is null' WHEN r3 THEN 'Field value is empty string' ELSE '' END AS message FROM judged""")
def required_field_blank(spark, d):
    return _verdict(dirty(spark, d), RULES[2], "row_id", "ver")


@query("required_field_missing", "SELECT l_returnflag, count(*) AS n, 'Field is missing from record' AS message FROM lineitem GROUP BY 1")
def required_field_missing(spark, d):
    """A required column that the data does not have fails every row."""
    v = validate(table(spark, d, "lineitem"), [Rule("r", "required_field", "l_comment")])
    return v.groupBy("l_returnflag", F.element_at("_v.error_messages", 1).alias("message")).agg(F.count(F.lit(1)).alias("n"))


@query("type_check_int", J + """SELECT row_id, ver, ok, CASE WHEN ok THEN '' ELSE 'Cannot coerce str to int: not a whole number' END AS message
  FROM (SELECT *, amount IS NULL OR regexp_matches(trim(amount), '^[+-]?[0-9]+$') AS ok FROM judged)""")
def type_check_int(spark, d):
    return _verdict(dirty(spark, d), Rule("t", "type_check", "amount", {"expected_type": "int"}), "row_id", "ver")


@query("type_check_float", J + """SELECT row_id, ver, NOT r4 AS ok,
  CASE WHEN r4 THEN 'Cannot coerce str to float: not a number' ELSE '' END AS message FROM judged""")
def type_check_float(spark, d):
    return _verdict(dirty(spark, d), RULES[3], "row_id", "ver")


_WORDS = "CASE WHEN o_orderstatus = 'F' THEN 'YES' WHEN o_orderpriority = '1-URGENT' THEN '0' WHEN o_orderpriority = '5-LOW' THEN 't' ELSE 'False' END"


@query("type_check_bool", f"""SELECT o_orderkey, flag <> 't' AS ok, CASE WHEN flag = 't' THEN 'Cannot coerce str to bool: not a boolean word' ELSE '' END AS message,
  CASE WHEN flag = 'YES' THEN true WHEN flag <> 't' THEN false END AS value FROM (SELECT o_orderkey, {_WORDS} AS flag FROM orders)""")
def type_check_bool(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.expr(_WORDS).alias("flag"))
    v = validate(df, [Rule("t", "type_check", "flag", {"expected_type": "bool"})])
    return v.select("o_orderkey", (F.size("_v.failed_rules") == 0).alias("ok"), F.array_join("_v.error_messages", "|").alias("message"), F.col("flag").alias("value"))


@query("type_check_strict", """SELECT l_returnflag, 'Expected int, got float|Expected float, got str' AS messages, count(*) AS n FROM lineitem GROUP BY 1""")
def type_check_strict(spark, d):
    """Without coercion the column type decides: a float is no int, text is no float, an int is one."""
    rules = [
        Rule("a", "type_check", "l_quantity", {"expected_type": "int", "coerce": False}),
        Rule("b", "type_check", "l_linestatus", {"expected_type": "float", "coerce": False}),
        Rule("c", "type_check", "l_linenumber", {"expected_type": "int", "coerce": False}),
    ]
    v = validate(table(spark, d, "lineitem"), rules)
    return v.groupBy("l_returnflag", F.array_join("_v.error_messages", "|").alias("messages")).agg(F.count(F.lit(1)).alias("n"))


_DATE_TEXT = """CASE WHEN o_orderstatus = 'F' THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), 'T10:00:00Z')
  WHEN o_orderstatus = 'P' THEN 'not a date' ELSE concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 10:00') END"""


@query("type_check_datetime", f"""SELECT o_orderkey, value IS NOT NULL AS ok, value FROM (SELECT o_orderkey,
  try_strptime({_DATE_TEXT}, '%Y-%m-%dT%H:%M:%SZ') AS value FROM orders)""")
def type_check_datetime(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.expr(_DATE_TEXT).alias("at"))
    rule = Rule("t", "type_check", "at", {"expected_type": "datetime", "date_format": "%Y-%m-%dT%H:%M:%SZ"})
    v = validate(df, [rule])
    return v.select("o_orderkey", (F.size("_v.failed_rules") == 0).alias("ok"), F.col("at").cast("timestamp_ntz").alias("value"))


@query("type_check_date", """SELECT o_orderkey, value IS NOT NULL AS ok, value FROM (SELECT o_orderkey,
  CAST(try_strptime(CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y/%m/%d') ELSE strftime(o_orderdate, '%m/%d/%Y') END, '%m/%d/%Y') AS DATE) AS value FROM orders)""")
def type_check_date(spark, d):
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(F.date_format("o_orderdate", "MM/dd/yyyy"))
    df = table(spark, d, "orders").select("o_orderkey", text.alias("at"))
    v = validate(df, [Rule("t", "type_check", "at", {"expected_type": "date", "date_format": "%m/%d/%Y"})])
    return v.select("o_orderkey", (F.size("_v.failed_rules") == 0).alias("ok"), F.col("at").alias("value"))


@query("range_inclusive", """SELECT c_custkey, ok, CASE WHEN ok THEN '' WHEN c_acctbal < 0 THEN concat('Value ', CAST(c_acctbal AS STRING), ' is less than minimum 0')
  ELSE concat('Value ', CAST(c_acctbal AS STRING), ' exceeds maximum 9000') END AS message FROM (SELECT *, c_acctbal BETWEEN 0 AND 9000 AS ok FROM customer)""")
def range_inclusive(spark, d):
    return _verdict(table(spark, d, "customer"), Rule("r", "range", "c_acctbal", {"min": 0, "max": 9000}), "c_custkey")


@query("range_exclusive", """SELECT p_partkey, ok, CASE WHEN ok THEN '' WHEN p_size <= 5 THEN concat('Value ', CAST(p_size AS STRING), ' must be greater than 5')
  ELSE concat('Value ', CAST(p_size AS STRING), ' must be less than 45') END AS message FROM (SELECT *, p_size > 5 AND p_size < 45 AS ok FROM part)""")
def range_exclusive(spark, d):
    rule = Rule("r", "range", "p_size", {"min_exclusive": 5, "max_exclusive": 45})
    return _verdict(table(spark, d, "part"), rule, "p_partkey")


@query("range_on_text", J + "SELECT row_id, ver, amount IS NULL AS ok, CASE WHEN amount IS NULL THEN '' ELSE 'Value must be numeric, got str' END AS message FROM judged")
def range_on_text(spark, d):
    """A text column without a type rule fails its range, null aside."""
    return _verdict(dirty(spark, d), Rule("r", "range", "amount", {"min": 0}), "row_id", "ver")


@query("regex_match", J + """SELECT row_id, ver, NOT r2 AS ok,
  CASE WHEN r2 THEN concat('Value ''', transaction_id, ''' does not match pattern ''^TXN[0-9]{10}$''') ELSE '' END AS message FROM judged""")
def regex_match(spark, d):
    return _verdict(dirty(spark, d), RULES[1], "row_id", "ver")


@query("regex_flags", r"""SELECT page_id, regexp_matches(url, '^HTTPS://[^/]+/(en|de)/', 'i') AS ok FROM pages""")
def regex_flags(spark, d):
    """Flags as numbers, and matching anchored at the start only."""
    rule = Rule("r", "regex", "url", {"pattern": r"HTTPS://[^/]+/(?P<lang>en|de)/", "flags": 2})
    return _verdict(table(spark, d, "pages"), rule, "page_id").drop("message")


@query("regex_on_numbers", "SELECT o_orderkey, regexp_matches(CAST(o_orderkey AS STRING), '^[1-5]+$') AS ok FROM orders")
def regex_on_numbers(spark, d):
    rule = Rule("r", "regex", "o_orderkey", {"pattern": r"[1-5]+$"})
    return _verdict(table(spark, d, "orders"), rule, "o_orderkey").drop("message")


@query("custom_expression", """SELECT l_returnflag, sum((l_extendedprice / l_quantity <= 1500)::INT)::BIGINT AS n_ok, count(*) AS n FROM lineitem GROUP BY 1""")
def custom_expression(spark, d):
    v = validate(table(spark, d, "lineitem"), [Rule("c", "custom", "l_extendedprice", {"expression": "value / l_quantity <= 1500"})])
    return v.groupBy("l_returnflag").agg(F.count_if(F.col("_v.status") == "valid").alias("n_ok"), F.count(F.lit(1)).alias("n"))


@query("custom_expression_errors", J + """SELECT row_id, ver, coalesce(TRY_CAST(amount AS DOUBLE) / nullif(row_id % 3, 0) > 1000, amount IS NULL) AS ok FROM judged""")
def custom_expression_errors(spark, d):
    """An expression that errs (a bad cast, a division by zero) fails the row, not the job."""
    rule = Rule("c", "custom", "amount", {"expression": "CAST(value AS DOUBLE) / (row_id % 3) > 1000"})
    return _verdict(dirty(spark, d), rule, "row_id", "ver").drop("message")


@query("custom_expression_overflow", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_orderkey::HUGEINT * 10000000000000000 BETWEEN 1 AND 9223372036854775807 AS ok FROM lineitem""")
def custom_expression_overflow(spark, d):
    """A product beyond BIGINT fails the row; it neither wraps nor stops the job."""
    rule = Rule("c", "custom", "l_orderkey", {"expression": "value * 10000000000000000 > 0"})
    return _verdict(table(spark, d, "lineitem"), rule, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").drop("message")


@query("conditional_rule", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, NOT (l_returnflag = 'R' AND l_discount > 0.05) AS ok FROM lineitem""")
def conditional_rule(spark, d):
    rule = Rule("c", "custom", "l_discount", {"expression": "IF l_returnflag = 'R' THEN value <= 0.05"})
    return _verdict(table(spark, d, "lineitem"), rule, "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").drop("message")


@query("cross_field_rule", """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate >= o_orderdate AS ok FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def cross_field_rule(spark, d):
    both = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    rule = Rule("c", "custom", "l_shipdate", {"expression": "l_shipdate >= o_orderdate"})
    return _verdict(both, rule, "o_orderkey", "l_linenumber", "l_partkey", "l_suppkey").drop("message")


@query("tolerance_rule", """SELECT p_partkey, abs(p_retailprice - (900 + p_partkey / 10.0)) <= 50.5 AS ok FROM part""")
def tolerance_rule(spark, d):
    rule = Rule("c", "custom", "p_retailprice", {"expression": "p_retailprice = 900 + p_partkey / 10.0D", "tolerance": 50.5})
    return _verdict(table(spark, d, "part"), rule, "p_partkey").drop("message")


@query("in_list_rule", "SELECT conv_id, turn, role IN ('user', 'assistant') AS ok FROM conversations")
def in_list_rule(spark, d):
    rule = Rule("c", "custom", "role", {"expression": "value IN ('user', 'assistant')"})
    return _verdict(table(spark, d, "conversations"), rule, "conv_id", "turn").drop("message")


@query("is_unique", J + """SELECT d.transaction_id, d.row_id, d.ver, d.transaction_id IS NULL OR c.n = 1 AS ok FROM judged d
  LEFT JOIN (SELECT transaction_id, count(*) AS n FROM judged GROUP BY 1) c ON d.transaction_id = c.transaction_id""")
def is_unique(spark, d):
    rule = Rule("u", "custom", "transaction_id", {"expression": "IS_UNIQUE(value)"})
    return _verdict(dirty(spark, d), rule, "transaction_id", "row_id", "ver").drop("message")


@query("custom_python", """SELECT doc_id, len(string_split(text, ' ')) >= 50 AS ok FROM documents""")
def custom_python(spark, d):
    """The user's own function, over Arrow batches of whole texts."""
    rule = Rule("p", "custom", "text", {
        "validator_func": lambda values, records: values.str.count(" ") + 1 >= 50, "vectorized": True, "fields": ["doc_id"]})
    return _verdict(table(spark, d, "documents"), rule, "doc_id").drop("message")


@query("custom_python_raising", """SELECT c_custkey, c_acctbal >= 0 AS ok, CASE WHEN c_acctbal >= 0 THEN '' ELSE concat('Account: overdrawn in ', c_mktsegment) END AS message FROM customer""")
def custom_python_raising(spark, d):
    """A function that raises: its text becomes the message."""

    def no_debt(value, record):
        if value < 0:
            raise ValueError(f"overdrawn in {record['c_mktsegment']}")

    rule = Rule("p", "custom", "c_acctbal", {"validator_func": no_debt, "error_message": "Account", "fields": ["c_mktsegment"]})
    return _verdict(table(spark, d, "customer"), rule, "c_custkey")


_LISTS = "SELECT row_id, ver, failed_rules, warnings FROM judged"


@query("failed_rule_list", J + _LISTS)
def failed_rule_list(spark, d):
    """All failures of each row, in rule order, beside its warnings."""
    return judged(spark, d).select("row_id", "ver", F.array_join("_v.failed_rules", ",").alias("failed_rules"), F.array_join("_v.warnings", ",").alias("warnings"))


@query("passed_rule_list", J + """SELECT row_id, ver, concat_ws(',', CASE WHEN NOT r1 THEN 'transaction_id_required' END, CASE WHEN NOT r2 THEN 'transaction_id_format' END,
    CASE WHEN NOT r3 THEN 'amount_required' END, CASE WHEN NOT r4 THEN 'amount_type' END, CASE WHEN NOT r5 THEN 'amount_range' END,
    CASE WHEN NOT r6 THEN 'status_values' END, CASE WHEN NOT w1 THEN 'email_format' END) AS passed_rules FROM judged""")
def passed_rule_list(spark, d):
    return judged(spark, d).select("row_id", "ver", F.array_join("_v.passed_rules", ",").alias("passed_rules"))


@query("error_messages", J + "SELECT row_id, ver, error_messages, n_failed FROM judged WHERE NOT good")
def error_messages(spark, d):
    """One message per failed rule, in step with the rule names."""
    bad = judged(spark, d).filter("_v.status <> 'valid'")
    return bad.select("row_id", "ver", F.array_join("_v.error_messages", "|").alias("error_messages"), F.size("_v.failed_rules").alias("n_failed"))


@query("split_is_total", J + "SELECT count(*) AS total, sum(good::INT)::BIGINT AS valid, sum((NOT good)::INT)::BIGINT AS invalid FROM judged")
def split_is_total(spark, d):
    valid, invalid = split(judged(spark, d))
    both = valid.select(F.lit(1).alias("v")).unionAll(invalid.select(F.lit(0).alias("v")))
    return both.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("v") == 1).alias("valid"), F.count_if(F.col("v") == 0).alias("invalid"))


@query("warnings_only_pass", J + "SELECT row_id, ver FROM judged WHERE good AND w1")
def warnings_only_pass(spark, d):
    return judged(spark, d).filter((F.col("_v.status") == "valid") & (F.size("_v.warnings") > 0)).select("row_id", "ver")


@query("disabled_rules", J + "SELECT row_id, ver, NOT (r1 OR r2 OR r6) AS ok FROM judged")
def disabled_rules(spark, d):
    """Rules switched off do not count."""
    rules = [Rule(r.rule_name, r.rule_type, r.field_name, r.parameters, r.severity, not r.rule_name.startswith("amount")) for r in RULES]
    return judged(spark, d, rules).select("row_id", "ver", (F.col("_v.status") == "valid").alias("ok"))


@query("no_rules", J + "SELECT count(*) AS valid FROM judged")
def no_rules(spark, d):
    return judged(spark, d, []).filter("_v.status = 'valid'").agg(F.count(F.lit(1)).alias("valid"))


@query("manual_review", J + "SELECT CASE WHEN good THEN 'valid' WHEN n_failed >= 2 THEN 'manual_review' ELSE 'invalid' END AS status, count(*) AS n FROM judged GROUP BY 1")
def manual_review(spark, d):
    """Rows that break two rules at once are set aside for people."""
    return judged(spark, d, review_threshold=2).groupBy(F.col("_v.status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


_HOLES = ["transaction_id", "amount", "email"]


@query("all_null_rows", J + """SELECT row_id, ver FROM judged WHERE transaction_id IS NULL AND (amount IS NULL OR trim(amount) = '') AND email IS NULL""")
def all_null_rows(spark, d):
    """Rows with nothing in any data column."""
    df = dirty(spark, d).select(*_HOLES, F.col("row_id").alias("_q_row_id"), F.col("ver").alias("_q_ver"))
    v = validate(df, [], reject_all_null=True)
    return v.filter(F.array_contains("_v.failed_rules", "no_valid_data")).select(F.col("_q_row_id").alias("row_id"), F.col("_q_ver").alias("ver"))


@query("missing_key_rows", J + """SELECT CASE WHEN transaction_id IS NULL THEN 'record_id_missing' ELSE '' END AS failed, count(*) AS n FROM judged GROUP BY 1""")
def missing_key_rows(spark, d):
    """Otherwise good rows without an id are rejected, never dropped."""
    v = judged(spark, d, [], key=F.col("transaction_id"))
    return v.groupBy(F.array_join("_v.failed_rules", ",").alias("failed")).agg(F.count(F.lit(1)).alias("n"))


@query("failures_by_rule", J + FAILURES_SQL + "SELECT rule_name, rule_type, field_name, count(*) AS n FROM failures GROUP BY ALL")
def failures_by_rule(spark, d):
    return metrics.failures_by_rule(judged(spark, d), rules_frame(spark, RULES))


@query("failures_by_type_and_field", J + FAILURES_SQL + """SELECT concat('s', CAST(row_id % 3 AS STRING)) AS source_id, rule_type, field_name, count(*) AS n FROM failures GROUP BY ALL""")
def failures_by_type_and_field(spark, d):
    source = F.concat(F.lit("s"), (F.col("row_id") % 3).cast("string"))
    return metrics.failures_by_type_and_field(judged(spark, d), rules_frame(spark, RULES), source)


@query("warnings_by_rule", J + "SELECT 'email_format' AS rule_name, 'regex' AS rule_type, 'email' AS field_name, count(*) AS n FROM judged WHERE w1")
def warnings_by_rule(spark, d):
    return metrics.warnings_by_rule(judged(spark, d), rules_frame(spark, RULES))


@query("warnings_by_source", J + "SELECT concat('s', CAST(row_id % 3 AS STRING)) AS source_id, 'email_format' AS rule_name, count(*) AS n FROM judged WHERE w1 GROUP BY 1")
def warnings_by_source(spark, d):
    return metrics.warnings_by_source(judged(spark, d), F.concat(F.lit("s"), (F.col("row_id") % 3).cast("string")))


@query("status_by_source", J + """SELECT concat('s', CAST(row_id % 3 AS STRING)) AS source_id, CASE WHEN good THEN 'valid' WHEN n_failed >= 3 THEN 'manual_review' ELSE 'invalid' END AS status, count(*) AS count FROM judged GROUP BY ALL""")
def status_by_source(spark, d):
    return metrics.records_by_status(judged(spark, d), F.concat(F.lit("s"), (F.col("row_id") % 3).cast("string")))


@query("batch_result", J + """SELECT count(*) AS total_records, sum(good::INT)::BIGINT AS valid_records, sum((NOT good)::INT)::BIGINT AS invalid_records,
  CAST(0 AS BIGINT) AS duplicate_records, CAST(1 AS BIGINT) AS schema_id, CAST(0.98 AS DOUBLE) AS schema_confidence FROM judged""")
def batch_result(spark, d):
    return metrics.batch_result(judged(spark, d), schema_id=1, confidence=0.98)


@query("id_format_customers", "SELECT c_custkey, false AS ok FROM customer WHERE c_name LIKE '%#%' UNION ALL SELECT c_custkey, true FROM customer WHERE c_name NOT LIKE '%#%'")
def id_format_customers(spark, d):
    return table(spark, d, "customer").select("c_custkey", valid_identifier(F.col("c_name")).alias("ok"))


@query("id_format_sources", "SELECT source, regexp_matches(trim(source), '^[A-Za-z0-9_.-]{1,255}$') AS ok, count(*) AS n FROM documents GROUP BY ALL")
def id_format_sources(spark, d):
    return table(spark, d, "documents").groupBy("source", valid_identifier(F.col("source")).alias("ok")).agg(F.count(F.lit(1)).alias("n"))


@query("nested_rule", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 10 AND 80 AS ok FROM events""")
def nested_rule(spark, d):
    """Rules on a dotted path into JSON text: type first, then range on the coerced value."""
    rules = [Rule("t", "type_check", "props.k", {"expected_type": "int"}), Rule("r", "range", "props.k", {"min": 10, "max": 80})]
    return validate(table(spark, d, "events"), rules).select("event_id", (F.col("_v.status") == "valid").alias("ok"))


@query("nested_rule_variant", """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) BETWEEN 10 AND 80 AS ok FROM events""")
def nested_rule_variant(spark, d):
    """The same on a variant column."""
    df = table(spark, d, "events").select("event_id", F.try_parse_json("props").alias("doc"))
    rules = [Rule("t", "type_check", "doc.k", {"expected_type": "int"}), Rule("r", "range", "doc.k", {"min": 10, "max": 80})]
    return validate(df, rules).select("event_id", (F.col("_v.status") == "valid").alias("ok"))


@query("nested_rule_struct", "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount <= 0.07 AND l_tax > 0.01 AS ok FROM lineitem")
def nested_rule_struct(spark, d):
    """Rules on a struct field and on a map key."""
    df = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.struct("l_discount").alias("price"), F.create_map(F.lit("tax"), "l_tax").alias("extra"))
    rules = [Rule("a", "range", "price.l_discount", {"max": 0.07}), Rule("b", "range", "extra.tax", {"min_exclusive": 0.01})]
    return validate(df, rules).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", (F.col("_v.status") == "valid").alias("ok"))


@query("type_check_int_overflow", """SELECT k, CASE WHEN k % 5 = 0 OR k > 9000 THEN 'int_range' ELSE '' END AS failed_rules,
  CASE WHEN k % 5 = 0 THEN NULL ELSE k END AS a FROM (SELECT o_orderkey AS k FROM orders)""")
def type_check_int_overflow(spark, d):
    """A whole number too large for BIGINT is still above a maximum."""
    text = F.when(F.col("k") % 5 == 0, F.concat(F.lit("9"), F.lpad(F.col("k").cast("string"), 24, "0"))).otherwise(F.col("k").cast("string"))
    df = table(spark, d, "orders").select(F.col("o_orderkey").alias("k")).withColumn("a", text)
    rules = [Rule("int_type", "type_check", "a", {"expected_type": "int"}), Rule("int_range", "range", "a", {"max": 9000})]
    return validate(df, rules).select("k", F.array_join("_v.failed_rules", ",").alias("failed_rules"), "a")
