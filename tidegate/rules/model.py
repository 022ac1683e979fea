"""The rule list: what a rule is, how to build one, and what a sound list looks like."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.patterns import spark_datetime_format, spark_regex
from tidegate.functions.values import TYPE_NAMES

# Rule types, severities, range bounds.
RULE_TYPES = ("required_field", "type_check", "range", "regex", "custom")
SEVERITIES = ("error", "warning")
BOUNDS = ("min", "max", "min_exclusive", "max_exclusive")

RULE_COLUMNS = (
    "rule_name STRING, rule_type STRING, field_name STRING, parameters STRING, severity STRING, enabled BOOLEAN"
)


@dataclass(frozen=True)
class Rule:
    rule_name: str
    rule_type: str
    field_name: str
    parameters: dict[str, Any] = field(default_factory=dict)
    severity: str = "error"
    enabled: bool = True

    def row(self) -> tuple:
        shown = {k: v for k, v in self.parameters.items() if not callable(v)}
        return (
            self.rule_name,
            self.rule_type,
            self.field_name,
            json.dumps(shown, sort_keys=True, default=str),
            self.severity,
            self.enabled,
        )

    # -- parameters under their several spellings ------------------------------------
    @property
    def target(self) -> str:
        wanted = self.parameters.get("expected_type")
        if not wanted:
            raise ValueError("type_check needs the parameter 'expected_type'")
        name = TYPE_NAMES.get(wanted.lower()) if isinstance(wanted, str) else TYPE_NAMES.get(wanted.__name__)
        if not name:
            raise ValueError(f"Unsupported type: {wanted}")
        return name

    @property
    def coerces(self) -> bool:
        return bool(self.parameters.get("coerce", self.parameters.get("allow_coercion", True)))

    @property
    def date_format(self) -> str | None:
        return self.parameters.get("date_format", self.parameters.get("format"))

    @property
    def is_unique(self) -> bool:
        text = str(self.parameters.get("expression") or "")
        return self.rule_type == "custom" and (
            bool(self.parameters.get("unique")) or re.fullmatch(r"(?i)\s*is_unique\(\s*value\s*\)\s*", text) is not None
        )

    def java_pattern(self) -> str:
        pattern = self.parameters.get("pattern")
        if not pattern:
            raise ValueError("regex needs the parameter 'pattern'")
        flags = int(self.parameters.get("flags") or 0)
        if isinstance(pattern, re.Pattern):
            return spark_regex(pattern.pattern, pattern.flags & ~re.U)
        if not isinstance(pattern, str):
            raise ValueError(f"Pattern must be text or a compiled pattern, got {type(pattern).__name__}")
        return spark_regex(pattern, flags)

    def pattern_text(self) -> str:
        pattern = self.parameters["pattern"]
        return pattern.pattern if isinstance(pattern, re.Pattern) else pattern


def _check_one(rule: Rule) -> None:
    p = rule.parameters
    if rule.rule_type not in RULE_TYPES:
        raise ValueError(f"Unknown rule type: {rule.rule_type}")
    if rule.severity not in SEVERITIES:
        raise ValueError(f"Invalid severity '{rule.severity}': must be 'error' or 'warning'")
    if not rule.rule_name or not rule.field_name:
        raise ValueError("a rule needs a name and a field")
    if rule.rule_type == "type_check":
        rule.target
        if rule.date_format:
            spark_datetime_format(rule.date_format)
    elif rule.rule_type == "regex":
        rule.java_pattern()
    elif rule.rule_type == "range":
        given = {b: p[b] for b in BOUNDS if p.get(b) is not None}
        if not given:
            raise ValueError("range needs at least one of min, max, min_exclusive, max_exclusive")
        for name, bound in given.items():
            if isinstance(bound, bool) or not isinstance(bound, (int, float)):
                raise ValueError(f"range bound '{name}' must be a number, got {bound!r}")
        low = max((v for b, v in given.items() if b.startswith("min")), default=None)
        high = min((v for b, v in given.items() if b.startswith("max")), default=None)
        if low is not None and high is not None:
            open_end = p.get("min_exclusive") == low or p.get("max_exclusive") == high
            if low > high or (low == high and open_end):
                raise ValueError(f"no value can lie between {low} and {high}")
    elif rule.rule_type == "custom":
        func = p.get("validator_func")
        if func is not None and not callable(func):
            raise ValueError("validator_func must be callable")
        if func is None and not (rule.is_unique or p.get("expression") or (p.get("lhs") and p.get("rhs"))):
            raise ValueError("custom needs 'validator_func', 'expression', 'lhs' and 'rhs', or 'unique'")


def active_rules(rules: Iterable[Rule | dict]) -> list[Rule]:
    """Enabled rules in order, each checked; errors name the rule."""
    return check_rules(rules)


def check_rules(rules: Iterable[Rule | dict]) -> list[Rule]:
    """Reject unsound or contradictory rules before any data is read."""
    out: list[Rule] = []
    names: set[str] = set()
    types: dict[str, tuple[str, str]] = {}
    for r in rules:
        rule = r if isinstance(r, Rule) else Rule(**r)
        if not rule.enabled:
            continue
        try:
            _check_one(rule)
        except ValueError as e:
            raise ValueError(f"Rule '{rule.rule_name}': {e}") from e
        if rule.rule_name in names:
            raise ValueError(f"Rule '{rule.rule_name}': the name is used twice")
        names.add(rule.rule_name)
        if rule.rule_type == "type_check":
            first = types.setdefault(rule.field_name, (rule.target, rule.rule_name))
            if first[0] != rule.target:
                raise ValueError(
                    f"Rule '{rule.rule_name}': field '{rule.field_name}' cannot be {rule.target} "
                    f"and {first[0]} (rule '{first[1]}')"
                )
        out.append(rule)
    return out


class RuleBuilder:
    """Chain of ``add_*`` calls that ends in ``build()``."""

    def __init__(self) -> None:
        self._rules: list[Rule] = []

    def add(self, rule: Rule) -> RuleBuilder:
        self._rules.append(rule)
        return self

    def add_required_field(self, field_name: str, allow_empty_string: bool = False, **kw: Any) -> RuleBuilder:
        return self._named(field_name, "required", "required_field", {"allow_empty_string": allow_empty_string}, kw)

    def add_type_check(self, field_name: str, expected_type: str, coerce: bool = True, **kw: Any) -> RuleBuilder:
        return self._named(field_name, "type_check", "type_check", {"expected_type": expected_type, "coerce": coerce}, kw)

    def add_range(
        self, field_name: str, min_value: float | None = None, max_value: float | None = None, **kw: Any
    ) -> RuleBuilder:
        bounds = {k: v for k, v in (("min", min_value), ("max", max_value)) if v is not None}
        return self._named(field_name, "range", "range", bounds, kw)

    def add_regex(self, field_name: str, pattern: str, **kw: Any) -> RuleBuilder:
        return self._named(field_name, "regex", "regex", {"pattern": pattern}, kw)

    def build(self) -> list[Rule]:
        return list(self._rules)

    def _named(self, field_name: str, suffix: str, rule_type: str, params: dict, kw: dict) -> RuleBuilder:
        return self.add(Rule(kw.pop("rule_name", f"{field_name}_{suffix}"), rule_type, field_name, params, **kw))


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """The rule list as a table; it is as long as the rule file, never as the data."""
    return spark.createDataFrame([r.row() for r in rules], RULE_COLUMNS)


def rule_summary(rules: DataFrame) -> DataFrame:
    """Enabled rules counted in total, by type and by severity."""
    enabled = rules.filter("enabled")
    counted = enabled.groupingSets([["rule_type"], ["severity"], []], "rule_type", "severity").agg(
        F.count(F.lit(1)).alias("rules"), F.grouping_id().alias("_level")
    )
    kind = F.when(F.col("_level") == 1, "type").when(F.col("_level") == 2, "severity").otherwise("total")
    return counted.select(kind.alias("kind"), F.coalesce("rule_type", "severity", F.lit("all")).alias("name"), "rules")
