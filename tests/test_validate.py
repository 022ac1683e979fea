import datetime
import math
import re

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidegate.functions.lenient import errors_as_null
from tidegate.functions.values import coercion, python_text
from tidegate.operators.validate import bind_value, coerce_types, split, validate
from tidegate.rules import Rule


def verdicts(df, rules, **kw):
    return validate(df, rules, **kw).select("_v.*").collect()


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "a string")


# -- a small restatement of the record semantics in Python, for comparison -------------


def py_int(s):
    try:
        int(s)
        return True
    except ValueError:
        return False


def py_float(s):
    try:
        float(s)
        return True
    except ValueError:
        return False


def py_bool(s):
    return s.lower() in ("true", "1", "yes", "false", "0", "no")


CASES = ["12", " 12 ", "+7", "-3", "1.5", "1e3", "1_000", "1__0", "_1", "1_", "1.5d", "1.5f", "0x1A", "nan", "-inf", "Infinity", "99999999999999999999",
         "", "   ", " ", "\x1f5", "TRUE", "yes", "No", "0", "1", "t", "y", "١٢", ".5", "5.", ".", "1e", "e5", "1 2", "NaN ", "\x85", "abc"]


@pytest.mark.parametrize("target,check", [("int", py_int), ("float", py_float), ("bool", py_bool)])
def test_text_coercion_verdicts(spark, target, check):
    rows = validate(texts(spark, CASES), [Rule("t", "type_check", "a", {"expected_type": target})])
    got = {r.raw: not r.failed for r in rows.select(F.col("_raw.a").alias("raw"), (F.size("_v.failed_rules") > 0).alias("failed")).collect()}
    assert got == {c: check(c) for c in CASES}


@settings(max_examples=5, deadline=None, derandomize=True, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.text(max_size=8), st.text("0123456789+-._eEinfa xy\t ", max_size=7), st.floats().map(str), st.integers().map(str)), min_size=60, max_size=120, unique=True))
def test_text_verdicts_agree_with_python(spark, values):
    values = [v for v in values if "\x00" not in v and not any(0xD800 <= ord(c) < 0xE000 for c in v)]
    df = spark.createDataFrame([(v, v, v, v) for v in values], "i string, f string, r string, x string")
    rules = [
        Rule("i", "type_check", "i", {"expected_type": "int"}),
        Rule("f", "type_check", "f", {"expected_type": "float"}),
        Rule("r", "required_field", "r"),
        Rule("x", "regex", "x", {"pattern": r"\w+\s?[0-9.]*$"}),
    ]
    got = {r.x: set(r.failed_rules) for r in validate(df, rules).select("x", "_v.failed_rules").collect()}
    for v in values:
        expect = {"i": py_int(v), "f": py_float(v), "r": v.strip() != "", "x": re.match(r"\w+\s?[0-9.]*$", v) is not None}
        assert got[v] == {k for k, ok in expect.items() if not ok}, repr(v)


def test_coerced_values(spark):
    df = texts(spark, ["12", " 1_000 ", "99999999999999999999", "x", None])
    assert [r.a for r in coerce_types(df, [Rule("t", "type_check", "a", {"expected_type": "int"})]).collect()] == [12, 1000, None, None, None]
    floats = coerce_types(texts(spark, ["1_0.5", "inf", "1e3"]), [Rule("t", "type_check", "a", {"expected_type": "float"})])
    assert [r.a for r in floats.collect()] == [10.5, math.inf, 1000.0]


def test_number_columns_as_types(spark):
    df = spark.createDataFrame([(99.9, True), (float("nan"), False), (None, None)], "d double, b boolean")
    rows = verdicts(df, [Rule("i", "type_check", "d", {"expected_type": "int"}), Rule("b", "type_check", "d", {"expected_type": "bool"}, enabled=False),
                         Rule("k", "type_check", "b", {"expected_type": "int", "coerce": False})])
    assert [r.failed_rules for r in rows] == [[], ["i"], []]
    assert coerce_types(df, [Rule("i", "type_check", "d", {"expected_type": "int"})]).first().d == 99


@pytest.mark.parametrize("value", [0.1, 1e7, 123456789.125, 1e16, 1.5e-5, 0.0005, -2.5e20, 0.0, float("inf"), float("nan"), 1e15, 3.0])
def test_float_text(spark, value):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(value,)], "d double")
    assert df.select(python_text(F.col("d"), T.DoubleType())).first()[0] == str(value)


def test_required(spark):
    df = texts(spark, [None, "", "  ", " ", "x"])
    assert [r.error_messages for r in verdicts(df, [Rule("r", "required_field", "a")])] == [
        ["Field value is null"], *[["Field value is empty string"]] * 3, []]
    lax = [Rule("r", "required_field", "a", {"allow_empty_string": True})]
    assert [r.status for r in verdicts(df, lax)] == ["invalid"] + ["valid"] * 4
    assert {tuple(r.error_messages) for r in verdicts(df, [Rule("r", "required_field", "zz")])} == {("Field is missing from record",)}


def test_other_rules_pass_on_missing_fields(spark):
    rules = [Rule("t", "type_check", "zz", {"expected_type": "int"}), Rule("n", "range", "zz", {"min": 1}), Rule("x", "regex", "zz", {"pattern": "a"}),
             Rule("c", "custom", "zz", {"expression": "value > 1"})]
    assert verdicts(texts(spark, ["q"]), rules)[0].passed_rules == ["t", "n", "x", "c"]


def test_range_messages_and_nan(spark):
    df = spark.createDataFrame([(5.0,), (-1.0,), (10.0,), (float("nan"),), (None,), (0.0,)], "a double")
    rows = verdicts(df, [Rule("r", "range", "a", {"min": 0, "max_exclusive": 10}), Rule("s", "range", "a", {"min_exclusive": 0.0, "max": 9.5})])
    assert [r.error_messages for r in rows] == [
        [], ["Value -1.0 is less than minimum 0", "Value -1.0 must be greater than 0.0"],
        ["Value 10.0 must be less than 10", "Value 10.0 exceeds maximum 9.5"], [], [], ["Value 0.0 must be greater than 0.0"]]
    assert verdicts(texts(spark, ["5"]), [Rule("r", "range", "a", {"min": 0})])[0].error_messages == ["Value must be numeric, got str"]
    bools = spark.createDataFrame([(True,), (False,)], "a boolean")
    assert [r.error_messages for r in verdicts(bools, [Rule("r", "range", "a", {"min": 1})])] == [[], ["Value False is less than minimum 1"]]


def test_range_sees_the_coerced_value(spark):
    rules = [Rule("t", "type_check", "a", {"expected_type": "float"}), Rule("r", "range", "a", {"max": 3})]
    assert [r.failed_rules for r in verdicts(texts(spark, ["2.5", "7", "x"]), rules)] == [[], ["r"], ["t"]]


def test_strict_types(spark):
    df = spark.createDataFrame([("1", 2)], "a string, b int")
    rules = [Rule("s", "type_check", "a", {"expected_type": "int", "coerce": False}), Rule("i", "type_check", "b", {"expected_type": "integer", "coerce": False})]
    assert verdicts(df, rules)[0].error_messages == ["Expected int, got str"]


def test_dates(spark):
    df = texts(spark, ["2025-01-31T10:00:00Z", "2025-02-30T10:00:00Z", "nope", None])
    rule = Rule("t", "type_check", "a", {"expected_type": "datetime", "date_format": "%Y-%m-%dT%H:%M:%SZ"})
    assert [r.status for r in verdicts(df, [rule])] == ["valid", "invalid", "invalid", "valid"]
    free = Rule("t", "type_check", "a", {"expected_type": "date"})
    assert coerce_types(texts(spark, ["2025-01-31"]), [free]).first().a == datetime.date(2025, 1, 31)


def test_custom_sql(spark):
    df = spark.createDataFrame([("a", 2, 4, "value"), ("b", 0, None, None)], "name string, n int, value int, other string")
    rules = [
        Rule("div", "custom", "n", {"expression": "10 / value > 1", "error_message": "too big"}),
        Rule("own", "custom", "name", {"expression": "value = 'a' OR value = 'value'"}),
        Rule("if", "custom", "n", {"expression": "IF other = 'value' THEN value >= 2"}),
        Rule("tol", "custom", "n", {"lhs": "value", "rhs": "name = 'a'", "tolerance": 1}, enabled=False),
        Rule("sum", "custom", "n", {"expression": "n = value", "tolerance": 0.5}),
    ]
    a, b = verdicts(df, rules)
    assert a.failed_rules == [] and b.failed_rules == ["div", "own"] and b.error_messages[0] == "too big"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    with pytest.raises(ValueError, match="'broken'"):
        validate(df, [Rule("broken", "custom", "n", {"expression": "no_such_column > 1"})])


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_custom_sql_errors_are_nulls_in_either_mode(spark, ansi):
    least = -(2**63)
    df = spark.createDataFrame([("1", 2, 2**63 - 1), ("x", 0, least), (None, 3, 5)], "a string, b int, c long")
    expected = {
        "c + 1 > 0": [None, False, True],
        "c * 2 - c > 0": [None, None, True],
        "-c < 0": [True, None, True],
        "abs(c)": [2**63 - 1, None, 5],
        "-b": [-2, 0, -3],
        "10 / b": [5.0, None, 10 / 3],
        "7 div b + 7 % b": [4, None, 3],
        "pmod(7, b)": [1, None, 1],
        "CAST(a AS INT)": [1, None, None],
        "a > 0": [True, None, None],
        "array(1, 2)[b]": [None, 1, None],
        "element_at(array(1, 2), b + 1)": [None, 1, None],
        "make_date(2025, b, 1)": [datetime.date(2025, 2, 1), None, datetime.date(2025, 3, 1)],
        "exists(array(a, '2'), x -> 10 / CAST(x AS INT) > b)": [True, True, True],
        "CASE WHEN b = 0 THEN 1 / b ELSE b END": [2.0, None, 3.0],
        "sum(b) OVER () > 3": [True, True, True],
    }
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        found = df.select("a", "c", *[errors_as_null(df, t).alias(t) for t in expected]).collect()
        assert spark.conf.get("spark.sql.ansi.enabled") == ansi
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    rows = sorted(found, key=lambda r: (r.a is None, r.a or ""))
    for text, values in expected.items():
        assert [r[text] for r in rows] == values, text


def test_value_binding():
    assert bind_value("value > 1 AND x = 'value' AND t.value = value2 AND `value`", "c") == "`c` > 1 AND x = 'value' AND t.value = value2 AND `value`"


def test_uniqueness(spark):
    df = spark.createDataFrame([(i, k) for i, k in enumerate(["a", "a", "b", None, None])], "i int, a string")
    v = validate(df, [Rule("u", "custom", "a", {"unique": True})]).orderBy("i")
    assert [r.status for r in v.select("_v.status").collect()] == ["invalid", "invalid", "valid", "valid", "valid"]
    assert v.count() == 5


def test_python_functions(spark):
    def check(value, record):
        if value > record["limit"]:
            raise ValueError(f"{value} over {record['limit']}")

    df = spark.createDataFrame([(5, 9), (7, 6), (None, 3)], "a int, limit int")
    rows = verdicts(df, [Rule("p", "custom", "a", {"validator_func": check, "error_message": "Limit"}),
                         Rule("v", "custom", "a", {"validator_func": lambda s, r: s < 6, "vectorized": True})])
    assert rows[0].failed_rules == []
    assert rows[1].error_messages == ["Limit: 7 over 6", "Custom validation failed"]
    assert rows[2].failed_rules == ["p", "v"]  # an exception is a failure


def test_severity_review_and_alignment(spark):
    rules = [Rule(f"e{i}", "regex", "a", {"pattern": p}) for i, p in enumerate(["x", "y", "z"])] + [Rule("w", "regex", "a", {"pattern": "q"}, "warning")]
    rows = verdicts(texts(spark, ["x", "", None]), rules)
    assert [(r.status, len(r.failed_rules), len(r.error_messages), r.warnings) for r in rows] == [
        ("invalid", 2, 2, ["w"]), ("manual_review", 3, 3, ["w"]), ("valid", 0, 0, [])]


def test_special_rules(spark):
    df = spark.createDataFrame([(None, " ", None), ("k", None, "{bad"), (None, "x", None)], "k string, a string, _corrupt_record string")
    rows = verdicts(df, [], reject_all_null=True, key=F.col("k"))
    assert [r.failed_rules for r in rows] == [["no_valid_data"], ["malformed_record"], ["record_id_missing"]]


def test_nested_fields(spark):
    df = spark.sql("""SELECT named_struct('b', 5) AS s, map('k', 'x') AS m, parse_json('{"p":{"q":"12"}}') AS v, '{"a":{"b":"7"}}' AS t
                      UNION ALL SELECT named_struct('b', 50), map(), parse_json('{}'), 'broken'""")
    rules = [Rule("s", "range", "s.b", {"max": 9}), Rule("m", "required_field", "m.k"), Rule("v", "required_field", "v.p.q"),
             Rule("t1", "type_check", "t.a.b", {"expected_type": "int"}), Rule("t2", "range", "t.a.b", {"max": 9})]
    a, b = verdicts(df, rules)
    assert a.failed_rules == [] and b.failed_rules == ["s", "m", "v"]
    assert b.error_messages[1:] == ["Field is missing from record", "Field value is null"]


def test_odd_column_names(spark):
    df = spark.createDataFrame([("1", "x")], "`a.b` string, `c d` string")
    rows = verdicts(df, [Rule("t", "type_check", "a.b", {"expected_type": "int"}), Rule("r", "regex", "c d", {"pattern": "y"})])
    assert rows[0].failed_rules == ["r"]


def test_split_is_total(spark):
    df = spark.range(1000).withColumn("a", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id").cast("string")))
    good, bad = split(validate(df, [Rule("r", "required_field", "a")]))
    assert (good.count(), bad.count()) == (666, 334)


def test_plan_has_no_python_and_no_shuffle(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("unused"))
    rules = [Rule("t", "type_check", "a", {"expected_type": "float"}), Rule("r", "range", "a", {"min": 1}), Rule("x", "regex", "a", {"pattern": r"\d"})]
    v = validate(df, rules)
    plan = v.filter("_v.status = 'valid'").select("_v.warnings")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "unused" not in plan
    assert plan.count("RLIKE") <= 8  # each predicate once, however many outputs read it


def test_unsupported_targets(spark):
    from pyspark.sql import types as T

    arr = spark.sql("SELECT array(1) AS a")
    assert verdicts(arr, [Rule("t", "type_check", "a", {"expected_type": "int"})])[0].error_messages == ["Cannot coerce list to int: not a whole number"]
    with pytest.raises(ValueError):
        coercion(F.col("a"), T.StringType(), "money")
