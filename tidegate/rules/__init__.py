"""Declarative validation rules: model, loading, building, checking."""

from tidegate.rules.loader import load_rules, parse_rule, parse_rules
from tidegate.rules.model import Rule, RuleBuilder, active_rules, check_rules, rules_frame, rule_summary

__all__ = [
    "Rule",
    "RuleBuilder",
    "active_rules",
    "check_rules",
    "load_rules",
    "parse_rule",
    "parse_rules",
    "rule_summary",
    "rules_frame",
]
