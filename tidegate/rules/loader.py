"""Rule files: YAML or JSON, grouped by field or as flat lists."""

from __future__ import annotations

import json
from pathlib import Path
from typing import Any

from tidegate.rules.model import SEVERITIES, Rule

# Fixed value: short rule type names allowed in files.
_TYPE_ALIASES = {"required": "required_field"}


def _read(path: str | Path) -> Any:
    file = Path(path)
    if not file.exists():
        raise FileNotFoundError(f"Rule file not found: {path}")
    text = file.read_text(encoding="utf-8")
    if file.suffix == ".json":
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - depends on the installation
        raise ImportError("reading YAML rule files needs PyYAML; JSON rule files do not") from e
    return yaml.safe_load(text)


def load_rules(path: str | Path, group: str | None = None) -> list[Rule]:
    """Rules of a file; ``group`` picks one section of a file of flat lists."""
    return parse_rules(_read(path), group)


def load_rule(path: str | Path) -> Rule:
    """A file that holds one rule."""
    return parse_rule(_read(path))


def parse_rules(config: Any, group: str | None = None) -> list[Rule]:
    if isinstance(config, list):
        return [r for entry in config for r in _flat(entry)]
    if not isinstance(config, dict) or not config:
        raise ValueError("A rule configuration must contain a 'rules' section")
    if group is not None:
        if group not in config:
            raise ValueError(f"No rule group '{group}'")
        return parse_rules(config[group])
    if "rules" in config:
        section = config["rules"]
        if isinstance(section, list):
            return parse_rules(section)
        if not isinstance(section, dict):
            raise ValueError("'rules' must map fields to lists of rules")
        return [r for name, entries in section.items() for r in _field_rules(name, entries)]
    if all(isinstance(v, list) and v and all("rule_type" in e for e in v) for v in config.values()):
        return [r for entries in config.values() for r in parse_rules(entries)]
    raise ValueError("A rule configuration must contain a 'rules' section")


def _field_rules(name: str, entries: Any) -> list[Rule]:
    if not isinstance(entries, list):
        raise ValueError(f"Rules for field '{name}' must be a list")
    return [_one(name, entry, i) for i, entry in enumerate(entries)]


def _one(name: str, entry: dict, index: int) -> Rule:
    if "type" not in entry:
        raise ValueError(f"A rule for field '{name}' is missing 'type'")
    kind = entry["type"]
    return _make(entry.get("name", f"{name}_{kind}_{index}"), kind, name, entry)


def _make(rule_name: str, kind: str, field_name: str, entry: dict) -> Rule:
    severity = entry.get("severity", "error")
    if severity not in SEVERITIES:
        raise ValueError(f"Invalid severity '{severity}' for rule '{rule_name}': must be 'error' or 'warning'")
    params = entry.get("params", entry.get("parameters")) or {}
    return Rule(rule_name, _TYPE_ALIASES.get(kind, kind), field_name, dict(params), severity, entry.get("enabled", True))


def _flat(entry: dict) -> list[Rule]:
    for needed in ("rule_name", "rule_type", "field_name"):
        if needed not in entry:
            raise ValueError(f"A rule is missing '{needed}': {entry}")
    fields = entry["field_name"]
    if isinstance(fields, list):
        return [_make(f"{entry['rule_name']}_{f}", entry["rule_type"], f, entry) for f in fields]
    return [_make(entry["rule_name"], entry["rule_type"], fields, entry)]


def parse_rule(entry: dict) -> Rule:
    """One rule in the flat form."""
    rules = _flat(entry)
    if len(rules) != 1:
        raise ValueError("expected one rule on one field")
    return rules[0]
