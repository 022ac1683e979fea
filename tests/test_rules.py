import json
import re

import pytest

from tidegate.functions.patterns import spark_datetime_format, spark_regex
from tidegate.rules import Rule, RuleBuilder, check_rules, load_rules, parse_rules, rule_summary, rules_frame


def test_field_form(tmp_path):
    f = tmp_path / "r.yaml"
    f.write_text(
        "rules:\n  amount:\n    - type: required_field\n    - type: range\n      name: amount_ok\n      params: {min: 1, max: 9}\n"
        "      severity: warning\n      enabled: false\n"
    )
    a, b = load_rules(f)
    assert (a.rule_name, a.severity, a.enabled) == ("amount_required_field_0", "error", True)
    assert (b.rule_name, b.parameters, b.severity, b.enabled) == ("amount_ok", {"min": 1, "max": 9}, "warning", False)


def test_flat_form_groups_lists_and_aliases():
    config = {
        "user_rules": [{"rule_name": "e", "rule_type": "required", "field_name": "email"}],
        "quality_rules": [{"rule_name": "n", "rule_type": "required_field", "field_name": ["a", "b"]}],
    }
    assert [(r.rule_name, r.rule_type, r.field_name) for r in parse_rules(config)] == [
        ("e", "required_field", "email"),
        ("n_a", "required_field", "a"),
        ("n_b", "required_field", "b"),
    ]
    assert [r.rule_name for r in parse_rules(config, "user_rules")] == ["e"]
    assert len(parse_rules({"rules": config["user_rules"]})) == 1


@pytest.mark.parametrize(
    "config",
    [None, {}, {"other": 1}, {"rules": {"a": {"type": "regex"}}}, {"rules": {"a": [{"name": "x"}]}},
     {"rules": {"a": [{"type": "required_field", "severity": "fatal"}]}}, [{"rule_name": "x"}]],
)
def test_bad_configurations(config):
    with pytest.raises(ValueError):
        parse_rules(config)


def test_missing_file():
    with pytest.raises(FileNotFoundError):
        load_rules("/no/such/rules.yaml")


def test_json_file(tmp_path):
    f = tmp_path / "r.json"
    f.write_text(json.dumps([{"rule_name": "x", "rule_type": "regex", "field_name": "a", "parameters": {"pattern": "^x"}}]))
    assert load_rules(f)[0].parameters == {"pattern": "^x"}


def test_builder():
    rules = RuleBuilder().add_required_field("a").add_type_check("a", "int").add_range("a", 1, 5).add_regex("b", "^x").build()
    assert [r.rule_name for r in rules] == ["a_required", "a_type_check", "a_range", "b_regex"]
    assert rules[2].parameters == {"min": 1, "max": 5}
    assert all(r.severity == "error" for r in rules)


@pytest.mark.parametrize(
    "rule",
    [
        Rule("bad", "nope", "a"),
        Rule("bad", "type_check", "a"),
        Rule("bad", "type_check", "a", {"expected_type": "money"}),
        Rule("bad", "range", "a"),
        Rule("bad", "range", "a", {"min": "1"}),
        Rule("bad", "range", "a", {"min": 5, "max": 1}),
        Rule("bad", "range", "a", {"min": 5, "max_exclusive": 5}),
        Rule("bad", "regex", "a"),
        Rule("bad", "regex", "a", {"pattern": "("}),
        Rule("bad", "regex", "a", {"pattern": "(a)(?(1)b|c)"}),
        Rule("bad", "custom", "a"),
        Rule("bad", "custom", "a", {"validator_func": "text"}),
        Rule("bad", "required_field", "a", {}, "fatal"),
    ],
)
def test_unsound_rules_are_named(rule):
    with pytest.raises(ValueError, match="'bad'"):
        check_rules([rule])


def test_contradictions_and_disabled():
    two = [Rule("a", "type_check", "x", {"expected_type": "int"}), Rule("b", "type_check", "x", {"expected_type": "date"})]
    with pytest.raises(ValueError, match="'b'"):
        check_rules(two)
    assert len(check_rules([two[0], Rule("b", "type_check", "x", {"expected_type": "date"}, enabled=False)])) == 1
    with pytest.raises(ValueError, match="twice"):
        check_rules([two[0], two[0]])


def test_summary(spark):
    rules = [Rule("a", "regex", "x", {"pattern": "x"}), Rule("b", "range", "x", {"min": 1}, "warning"), Rule("c", "regex", "x", {"pattern": "x"}, enabled=False)]
    rows = {(r.kind, r.name): r.rules for r in rule_summary(rules_frame(spark, rules)).collect()}
    assert rows == {("total", "all"): 2, ("type", "regex"): 1, ("type", "range"): 1, ("severity", "error"): 1, ("severity", "warning"): 1}


PATTERNS = [
    (r"^\d{3}-(?P<a_b>\w)(?P=a_b)$", 0),
    (r"[[\]a&&b]+x", 0),
    (r"[^]x]+", 0),
    (r"a{,2}b", 0),
    (r"héllo", re.I),
    (r"(?i)ABC.", re.S),
    (r"x$", 0),
    (r"^b", re.M),
    (r"\w+\Z", re.A),
    (r"a b # note", re.X),
]
TEXTS = ["123-éé", "123-ab", "[a&x", "]]", "yy", "aab", "b", "HÉLLO", "abc\n", "x\n", "x", "a\nb", "b\n", "é", "word", "ab", "", "abcd"]


@pytest.mark.parametrize("pattern,flags", PATTERNS)
def test_patterns_mean_the_same(spark, pattern, flags):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    got = {r.t: r.m for r in df.select("t", F.col("t").rlike(spark_regex(pattern, flags)).alias("m")).collect()}
    assert got == {t: re.match(pattern, t, flags) is not None for t in TEXTS}


def test_date_formats():
    assert spark_datetime_format("%Y-%m-%dT%H:%M:%SZ") == "yyyy-MM-dd'T'HH:mm:ss'Z'"
    assert spark_datetime_format("yyyy/MM") == "yyyy/MM"
    with pytest.raises(ValueError):
        spark_datetime_format("%Q")
