"""Rules compiled to Spark columns.

``validate`` turns a rule list into two projections over the input: one boolean per rule,
then one result struct.  There is no Python worker
in it unless a rule brings its own Python function, and no shuffle unless a rule asks for
uniqueness.  The same projection serves a batch and a stream.
"""

from __future__ import annotations

import inspect
import re
from collections.abc import Iterable
from dataclasses import dataclass
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.lenient import errors_as_null
from tidegate.functions.payload import data_columns
from tidegate.functions.values import (
    blank,
    coercion,
    is_numeric,
    is_text,
    python_text,
    python_type_name,
    quoted,
    strip,
    strict_type_matches,
)
from tidegate.rules.model import Rule, check_rules
from tidegate.session import fit_generated_code

CORRUPT = "_corrupt_record"
RESULT_TYPE = (
    "struct<status:string,passed_rules:array<string>,failed_rules:array<string>,"
    "error_messages:array<string>,warnings:array<string>>"
)

# Null-key rows of a uniqueness check are spread over this many slots of the join.
_NULL_SLOTS = 256


@dataclass(frozen=True)
class Field:
    """One rule field found in a frame; ``exists`` is None when it always does."""

    col: Column
    dtype: T.DataType
    exists: Column | None = None


def find_field(df: DataFrame, name: str) -> Field | None:
    """A column by name, or a dotted path into a struct, map, variant or JSON text."""
    if name in df.columns:
        return Field(quoted(name), df.schema[name].dataType)
    head, _, rest = name.partition(".")
    if not rest or head not in df.columns:
        return None
    col, dtype, exists = quoted(head), df.schema[head].dataType, None
    parts = rest.split(".")
    for i, part in enumerate(parts):
        tail = ".".join(parts[i:])
        if isinstance(dtype, T.StructType):
            if part not in dtype.names:
                return None
            col, dtype = col.getField(part), dtype[part].dataType
        elif isinstance(dtype, T.MapType):
            exists = F.coalesce(F.map_contains_key(col, F.lit(part)), F.lit(False))
            col, dtype = col.getItem(part), dtype.valueType
        elif isinstance(dtype, T.VariantType):
            return Field(F.try_variant_get(col, "$." + tail, "string"), T.StringType(), exists)
        elif is_text(dtype):
            return Field(F.get_json_object(col, "$." + tail), T.StringType(), exists)
        else:
            return None
    return Field(col, dtype, exists)


def _coercing(rules: Iterable[Rule]) -> dict[str, Rule]:
    out: dict[str, Rule] = {}
    for r in rules:
        if r.rule_type == "type_check" and r.coerces:
            out.setdefault(r.field_name, r)
    return out


def coerce_types(df: DataFrame, rules: Iterable[Rule | dict]) -> DataFrame:
    """Give each type-checked column its rule type; originals stay in ``_raw``.

    Text that cannot be coerced becomes null here and fails its type_check later.
    """
    if "_raw" in df.columns:
        return df
    changed, raw = {}, []
    for name, rule in _coercing(check_rules(rules)).items():
        if name not in df.columns:
            continue
        dtype = df.schema[name].dataType
        new = coercion(quoted(name), dtype, rule.target, rule.date_format)
        if new.dtype != dtype:
            changed[name] = new.value
            raw.append(quoted(name).alias(name))
    if not changed:
        return df
    return df.select(
        *[changed[c].alias(c) if c in changed else quoted(c) for c in df.columns], F.struct(*raw).alias("_raw")
    )


class _Scope:
    """Raw and processed view of each rule field in one (possibly coerced) frame."""

    def __init__(self, df: DataFrame, rules: list[Rule]):
        self.df = df
        self._raw = df.schema["_raw"].dataType if "_raw" in df.columns else T.StructType()
        self._coercing = _coercing(rules)

    def is_coerced(self, name: str) -> bool:
        return name in self._raw.names

    def raw(self, name: str) -> Field | None:
        if name in self._raw.names:
            return Field(F.col("_raw").getField(name), self._raw[name].dataType)
        return find_field(self.df, name)

    def processed(self, name: str) -> Field | None:
        found = find_field(self.df, name)
        rule = self._coercing.get(name)
        if found is None or rule is None or name in self.df.columns:
            return found
        new = coercion(found.col, found.dtype, rule.target, rule.date_format)
        return Field(new.value, new.dtype, found.exists)


class Verdict(NamedTuple):
    """When a rule fails, and the text for rows where it does."""

    fails: Column
    text: Column


def _verdict(fails: Column, text: Column | str) -> Verdict:
    return Verdict(F.coalesce(fails, F.lit(False)), F.lit(text) if isinstance(text, str) else text)


def _required(rule: Rule, scope: _Scope) -> Verdict:
    found = scope.raw(rule.field_name)
    if found is None:
        return _verdict(F.lit(True), "Field is missing from record")
    fails, text = found.col.isNull(), F.when(found.col.isNull(), "Field value is null")
    if found.exists is not None:
        text = F.when(~found.exists, "Field is missing from record").when(found.col.isNull(), "Field value is null")
    if is_text(found.dtype) and not rule.parameters.get("allow_empty_string", False):
        fails = fails | blank(found.col)
        text = text.otherwise("Field value is empty string")
    return _verdict(fails, text)


# Why a value cannot be read as a type.
_REASONS = {
    "int": "not a whole number",
    "float": "not a number",
    "bool": "not a boolean word",
    "datetime": "not a timestamp of the expected format",
    "date": "not a date of the expected format",
    "str": "not text",
}


def _type_check(rule: Rule, scope: _Scope) -> Verdict | None:
    found = scope.raw(rule.field_name)
    if found is None:
        return None
    own = python_type_name(found.dtype)
    if not rule.coerces:
        if strict_type_matches(found.dtype, rule.target):
            return None
        return _verdict(found.col.isNotNull(), f"Expected {rule.target}, got {own}")
    new = coercion(found.col, found.dtype, rule.target, rule.date_format)
    failed = found.col.isNotNull() & ~new.ok
    if scope.is_coerced(rule.field_name):
        # a value means success, so the text is examined again only where there is none
        failed = found.col.isNotNull() & quoted(rule.field_name).isNull() & ~new.ok
    return _verdict(failed, f"Cannot coerce {own} to {rule.target}: {_REASONS[rule.target]}")


# How each bound is broken, and the words for it.
_BOUNDS = (
    ("min", lambda v, b: v < b, "is less than minimum"),
    ("min_exclusive", lambda v, b: v <= b, "must be greater than"),
    ("max", lambda v, b: v > b, "exceeds maximum"),
    ("max_exclusive", lambda v, b: v >= b, "must be less than"),
)


def _range(rule: Rule, scope: _Scope) -> Verdict | None:
    found = scope.processed(rule.field_name)
    if found is None:
        return None
    if not is_numeric(found.dtype):
        return _verdict(found.col.isNotNull(), f"Value must be numeric, got {python_type_name(found.dtype)}")
    value = found.col.cast("int") if isinstance(found.dtype, T.BooleanType) else found.col
    text, beyond = python_text(found.col, found.dtype), None
    if scope.is_coerced(rule.field_name) and isinstance(found.dtype, T.LongType):
        raw = scope.raw(rule.field_name)
        if is_text(raw.dtype):  # a whole number that BIGINT cannot hold still has a side on which it lies
            beyond = F.when(found.col.isNull() & raw.col.isNotNull() & coercion(raw.col, raw.dtype, "int").ok,
                            F.when(strip(raw.col).startswith("-"), float("-inf")).otherwise(float("inf")))
            text = F.coalesce(text, raw.col)
    fails, words = F.lit(False), F.when(F.lit(False), F.lit(""))
    for key, broken, phrase in _BOUNDS:
        bound = rule.parameters.get(key)
        if bound is not None:
            fails = fails | broken(value, F.lit(bound))
            words = words.when(broken(value, F.lit(bound)), f" {phrase} {bound}")
            if beyond is not None:
                outside = F.coalesce(broken(beyond, F.lit(float(bound))), F.lit(False))
                fails, words = F.coalesce(fails, F.lit(False)) | outside, words.when(outside, f" {phrase} {bound}")
    if isinstance(found.dtype, (T.FloatType, T.DoubleType)):
        fails = fails & ~F.isnan(value)  # no comparison with NaN holds
    return _verdict(fails, F.concat(F.lit("Value "), text, words))


def _regex(rule: Rule, scope: _Scope) -> Verdict | None:
    found = scope.raw(rule.field_name)
    if found is None:
        return None
    text = python_text(found.col, found.dtype)
    message = F.concat(F.lit("Value '"), text, F.lit(f"' does not match pattern '{rule.pattern_text()}'"))
    return _verdict(~text.rlike(rule.java_pattern()), message)


# -- custom rules ---------------------------------------------------------------------

_QUOTED_OR_VALUE = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|(?<![\w.])value(?![\w(])", re.I)
_IF_THEN = re.compile(r"(?is)\A\s*if\s+(?P<when>.+?)\s+then\s+(?P<then>.+)\Z")
_EQUATION = re.compile(r"(?s)\A(?P<lhs>[^=<>!]+)={1,2}(?P<rhs>[^=<>!]+)\Z")


def bind_value(text: str, name: str) -> str:
    """Let ``value`` in an expression mean the column ``name``, outside quotes."""
    return _QUOTED_OR_VALUE.sub(lambda m: f"`{name}`" if m.group().lower() == "value" else m.group(), text)


def _expression(rule: Rule, value_column: str) -> str:
    """The SQL predicate of a custom rule; null means it could not be decided."""
    p = rule.parameters
    tolerance = p.get("tolerance")
    condition, text = p.get("when"), p.get("expression")
    if text and (clause := _IF_THEN.match(text)):
        condition, text = clause["when"], clause["then"]
    lhs, rhs = p.get("lhs"), p.get("rhs")
    if tolerance is not None and not lhs:
        equation = _EQUATION.match(text or "")
        if not equation:
            raise ValueError(f"Rule '{rule.rule_name}': a tolerance needs one equation, got {text!r}")
        lhs, rhs = equation["lhs"], equation["rhs"]
    if lhs:
        text = f"abs(({lhs}) - ({rhs})) <= {tolerance or 0}"
    if condition:
        text = f"CASE WHEN {condition} THEN coalesce(({text}), false) ELSE true END"
    return bind_value(text, value_column)


def _python_rule(rule: Rule, df: DataFrame, value: Field | None) -> Column:
    """A rule with the user's own Python function, in Arrow batches.

    ``validator_func(value, record)`` raises to reject.  With ``vectorized: True`` it takes
    a Series and a record DataFrame and returns a boolean Series.  ``fields`` limits the
    record to the columns the function needs.
    """
    func, text = rule.parameters["validator_func"], rule.parameters.get("error_message") or "Custom validation failed"
    names = rule.parameters.get("fields") or data_columns(df)
    record = F.struct(*[quoted(n).alias(n) for n in names])
    given = value.col if value is not None else F.lit(None).cast("string")
    if rule.parameters.get("vectorized"):

        def texts(values: pd.Series, records: pd.DataFrame) -> list[str | None]:
            ok = pd.Series(func(values, records)).fillna(False).astype(bool).to_numpy()
            return [None if good else text for good in ok]

        def judge_batch(values: pd.Series, records: pd.DataFrame) -> pd.Series:
            try:
                return pd.Series(texts(values, records), dtype=object)
            except Exception:  # judged row by row, so that a verdict does not hang on the size of a batch
                found: list[str | None] = []
                for k in range(len(values)):
                    try:
                        found += texts(values.iloc[k : k + 1], records.iloc[k : k + 1])
                    except Exception as e:
                        found.append(f"{text}: {e}")
                return pd.Series(found, dtype=object)

        return F.pandas_udf(judge_batch, "string")(given, record)

    takes_record = len(inspect.signature(func).parameters) >= 2

    def judge(value, record):
        try:
            func(value, record.asDict(recursive=True)) if takes_record else func(value)
        except Exception as e:
            return f"{text}: {e}"
        return None

    return F.udf(judge, "string", useArrow=True)(given, record)


def _with_duplicate_marks(df: DataFrame, scope: _Scope, unique: dict[int, Rule]) -> DataFrame:
    """Add ``_dup_<i>`` (true when the field's value occurs more than once).

    Values are counted with map-side combining and only repeated values are joined back,
    so a hot value never gathers its rows in one task; AQE splits its join partition.
    Null values, which cannot repeat, get random-free slots of their own.
    """
    for i, rule in unique.items():
        found = scope.processed(rule.field_name)
        if found is None:
            df = df.withColumn(f"_dup_{i}", F.lit(False))
            continue
        key, slot = f"_uk_{i}", f"_us_{i}"
        repeated = (
            df.select(found.col.alias(key))
            .filter(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.count(F.lit(1)).alias("_n"))
            .filter("_n > 1")
            .select(key, F.lit(0).cast("bigint").alias(slot), F.lit(True).alias(f"_dup_{i}"))
        )
        spread = F.when(found.col.isNull(), F.pmod(F.monotonically_increasing_id(), F.lit(_NULL_SLOTS))).otherwise(0)
        df = (
            df.withColumn(key, found.col)
            .withColumn(slot, spread.cast("bigint"))
            .join(repeated, [key, slot], "left")
            .withColumn(f"_dup_{i}", F.coalesce(f"_dup_{i}", F.lit(False)))
            .drop(key, slot)
        )
    return df


_SIMPLE = {"required_field": _required, "type_check": _type_check, "range": _range, "regex": _regex}


def _default_text(rule: Rule) -> str:
    return rule.parameters.get("error_message") or "Custom validation failed"


def verdicts(df: DataFrame, rules: list[Rule]) -> tuple[DataFrame, list[Column]]:
    """Add one boolean ``_f_<i>`` per rule (true = fails); return the texts for failing rows.

    Status, name lists and texts are all read from these flags, so each predicate is
    evaluated once per row, and texts only where a rule fails.
    """
    unique = {i: r for i, r in enumerate(rules) if r.is_unique}
    if unique and df.isStreaming:
        names = ", ".join(r.rule_name for r in unique.values())
        raise ValueError(f"Rules need a whole batch and cannot run on a stream: {names}")
    scope = _Scope(df, rules)
    if unique:
        df = _with_duplicate_marks(df, scope, unique)

    flags: dict[str, Column] = {}
    python_texts: dict[str, Column] = {}
    bound: dict[str, Column] = {}
    sql_rules: dict[int, Rule] = {}
    texts: list[Column] = []
    for i, rule in enumerate(rules):
        if rule.rule_type != "custom":
            verdict = _SIMPLE[rule.rule_type](rule, scope) or Verdict(F.lit(False), F.lit(""))
            flags[f"_f_{i}"] = verdict.fails
            texts.append(verdict.text)
            continue
        texts.append(F.lit(_default_text(rule)))
        found = scope.processed(rule.field_name)
        if i in unique:
            flags[f"_f_{i}"] = F.col(f"_dup_{i}")
        elif rule.parameters.get("validator_func"):
            python_texts[f"_t_{i}"] = _python_rule(rule, df, found)
            texts[i] = F.col(f"_t_{i}")
        else:
            sql_rules[i] = rule
            bound[f"_in_{i}"] = found.col if found is not None else F.lit(None)
            raw = scope.raw(rule.field_name)
            bound[f"_null_{i}"] = raw.col.isNull() if raw is not None else F.lit(True)

    # A filter on the result must not pull every predicate down into itself and evaluate it a
    # second time; it stops at a projection with a value the optimizer cannot know.
    flags["_f_pin"] = F.spark_partition_id() < 0
    out = df.withColumns({**flags, **python_texts, **bound})
    if python_texts:
        out = out.withColumns({name.replace("_t_", "_f_"): F.col(name).isNotNull() for name in python_texts})
    for i, rule in sql_rules.items():
        try:
            passes = errors_as_null(out, f"coalesce(CAST(({_expression(rule, f'_in_{i}')}) AS BOOLEAN), `_null_{i}`)")
            out = out.withColumn(f"_f_{i}", ~passes)
        except Exception as e:
            raise ValueError(f"Rule '{rule.rule_name}': {e}") from e
    return out.drop(*bound, *[f"_dup_{i}" for i in unique]), texts


def _present(parts: list[Column]) -> Column:
    """The non-empty texts among ``parts``, in order."""
    pin = F.when(F.col("_f_pin"), "pin").otherwise("")
    return F.array_remove(F.array(pin, *parts), "") if parts else F.array().cast("array<string>")


def _lost_numbers(df: DataFrame, rules: list[Rule]) -> Column | None:
    """Rows where a whole number in text is too large for its BIGINT column: they must not pass with a null."""
    lost = None
    for name, rule in _coercing(rules).items():
        raw = df.schema["_raw"].dataType if "_raw" in df.columns else T.StructType()
        if rule.target == "int" and name in raw.names and is_text(raw[name].dataType):
            text = F.col("_raw").getField(name)
            here = F.coalesce(text.isNotNull() & quoted(name).isNull() & coercion(text, raw[name].dataType, "int").ok, F.lit(False))
            lost = here if lost is None else lost | here
    return lost


def validate(
    df: DataFrame,
    rules: Iterable[Rule | dict],
    *,
    review_threshold: int = 3,
    reject_all_null: bool = False,
    reject_lost_numbers: bool = False,
    key: Column | None = None,
    result: str = "_v",
) -> DataFrame:
    """Coerce, apply every enabled rule to every row and add one result struct.

    Filter on data columns before this step: a filter on its output does not reach the scan.

    ``status`` is valid, invalid, or manual_review when at least ``review_threshold`` error
    rules failed.  Warnings never make a row invalid.  Rows whose text could not be parsed
    fail ``malformed_record``; with ``reject_all_null`` empty rows fail ``no_valid_data``; with ``reject_lost_numbers``
    whole numbers in text that BIGINT cannot hold fail ``number_out_of_range``;
    with ``key``, otherwise good rows without a key fail ``record_id_missing``.
    """
    checked = check_rules(rules)
    fit_generated_code(df.sparkSession)
    record = data_columns(df)
    judged, texts = verdicts(coerce_types(df, checked), checked)

    # (name, fails, text) of everything that can make a row invalid, in order
    failing: list[tuple[str, Column, Column]] = []
    if CORRUPT in df.columns:
        broken = quoted(CORRUPT).isNotNull()
        if record:  # Spark refuses scans that need the corrupt text alone, so another column is named
            broken = broken | (F.col("_f_pin") & quoted(record[0]).isNotNull())
        failing.append(("malformed_record", broken, F.lit("Record could not be parsed")))
    if reject_all_null and record:
        raw = set(judged.schema["_raw"].dataType.names) if "_raw" in judged.columns else set()
        empty = F.lit(True)
        for c in record:
            col = F.col("_raw").getField(c) if c in raw else quoted(c)
            empty = empty & (F.coalesce(blank(col), F.lit(True)) if is_text(df.schema[c].dataType) else col.isNull())
        judged = judged.withColumn("_f_empty", empty)
        failing.append(("no_valid_data", F.col("_f_empty"), F.lit("No valid data")))
    lost = _lost_numbers(judged, checked) if reject_lost_numbers else None
    if lost is not None:
        judged = judged.withColumn("_f_lost", lost)
        failing.append(("number_out_of_range", F.col("_f_lost"), F.lit("Whole number does not fit 64 bits")))
    flags = [F.col(f"_f_{i}") for i in range(len(checked))]
    failing += [(r.rule_name, f, t) for r, f, t in zip(checked, flags, texts) if r.severity == "error"]

    n_failed = F.col("_f_pin").cast("int")
    for _, fails, _ in failing:
        n_failed = n_failed + fails.cast("int")
    judged = judged.withColumn("_n_failed", n_failed)
    n_failed = F.col("_n_failed")
    no_key = F.lit(False)
    if key is not None:
        no_key = (n_failed == 0) & (F.coalesce(key, F.lit("")) == "")
        failing.append(("record_id_missing", no_key, F.lit("Record has no usable id")))

    status = (
        F.when((n_failed == 0) & ~no_key, "valid").when(n_failed >= review_threshold, "manual_review").otherwise("invalid")
    )
    verdict = F.struct(
        status.alias("status"),
        _present([F.when(~f, r.rule_name).otherwise("") for r, f in zip(checked, flags)]).alias("passed_rules"),
        _present([F.when(f, n).otherwise("") for n, f, _ in failing]).alias("failed_rules"),
        _present([F.coalesce(F.when(f, t), F.when(f, n), F.lit("")) for n, f, t in failing]).alias("error_messages"),
        _present([F.when(f, r.rule_name).otherwise("") for r, f in zip(checked, flags) if r.severity == "warning"]).alias(
            "warnings"
        ),
    )
    helpers = [c for c in judged.columns if c.startswith(("_f_", "_t_", "_n_failed")) and c not in df.columns]
    return judged.withColumn(result, verdict).drop(*helpers)


def split(validated: DataFrame, result: str = "_v") -> tuple[DataFrame, DataFrame]:
    """Valid and invalid rows; the status is never null, so the split is total."""
    good = F.col(f"{result}.status") == "valid"
    return validated.filter(good), validated.filter(~good)
