"""Column helpers that give Spark columns the value semantics of Python records.

Rules were written for Python values, so a text column is judged by what ``int()``,
``float()``, ``str()`` and ``str.strip()`` would do with it.  Everything here returns
built-in Spark expressions; nothing runs in a Python worker.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.patterns import spark_datetime_format

# The white space that Python's str.strip() removes, as a Java class.
_SPACE = r"[\s\x1c-\x1f]"
BLANK = rf"(?U)\A{_SPACE}*\z"
_EDGES = rf"(?U)\A{_SPACE}+|{_SPACE}+\z"

# The text forms Python's int() and float() accept (they allow less white space).
_DIGITS = r"\d+(?:_\d+)*"
INT_TEXT = rf"(?U)\A\s*[+-]?{_DIGITS}\s*\z"
FLOAT_TEXT = (
    rf"(?U)\A\s*[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?"
    rf"|(?i:inf|infinity|nan))\s*\z"
)

# The words a text may use for a boolean, in any case.
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")

# Type names allowed in rules -> canonical name.
TYPE_NAMES = {
    "integer": "int",
    "int": "int",
    "decimal": "float",
    "float": "float",
    "double": "float",
    "string": "str",
    "str": "str",
    "boolean": "bool",
    "bool": "bool",
    "datetime": "datetime",
    "timestamp": "datetime",
    "date": "date",
}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def blank(col: Column) -> Column:
    """Nothing but white space; text that starts with a visible ASCII letter needs no regex."""
    return ~F.ascii(col).between(33, 126) & col.rlike(BLANK)


def _matches(col: Column, pattern: str) -> Column:
    """Try the pattern on ASCII first, which is much faster, then on all of Unicode."""
    return col.rlike(pattern.removeprefix("(?U)")) | col.rlike(pattern)


def strip(col: Column) -> Column:
    """``str.strip()``: every Unicode space, not only 0x20."""
    return F.regexp_replace(col, _EDGES, "")


def python_type_name(dtype: T.DataType) -> str:
    """The Python type name a value of this Spark type has in a record."""
    if is_text(dtype):
        return "str"
    if isinstance(dtype, T.BooleanType):
        return "bool"
    if isinstance(dtype, _INTEGRAL):
        return "int"
    if isinstance(dtype, _FLOATING):
        return "float"
    if isinstance(dtype, T.DecimalType):
        return "Decimal"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, T.BinaryType):
        return "bytes"
    if isinstance(dtype, T.ArrayType):
        return "list"
    if isinstance(dtype, (T.StructType, T.MapType, T.VariantType)):
        return "dict"
    return dtype.typeName()


def _float_text(col: Column) -> Column:
    """``repr(float)``: plain digits from 1e-4 up to 1e16, exponent form outside."""
    text = col.cast("string")
    size = F.abs(col)
    plain = F.regexp_replace(F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", ""), r"\.$", ".0")
    mantissa = F.regexp_replace(F.split_part(text, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(text, F.lit("E"), F.lit(2)).try_cast("int")
    exponent = F.concat(mantissa, F.lit("e"), F.format_string("%+03d", power))
    return (
        F.when(F.isnan(col), F.lit("nan"))
        .when(col == float("inf"), F.lit("inf"))
        .when(col == float("-inf"), F.lit("-inf"))
        .when(~text.contains("E"), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(exponent)
    )


def python_text(col: Column, dtype: T.DataType) -> Column:
    """``str(value)`` for a value of this Spark type."""
    if is_text(dtype):
        return col
    if isinstance(dtype, T.BooleanType):
        return F.initcap(col.cast("string"))
    if isinstance(dtype, _FLOATING):
        return _float_text(col)
    if isinstance(dtype, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return F.to_json(col)
    return col.cast("string")


@dataclass(frozen=True)
class Coercion:
    """Verdict and value of turning one column into a rule type.

    ``ok`` is null-free only where the input is not null; callers skip nulls first.
    """

    ok: Column
    value: Column
    dtype: T.DataType


def _number(col: Column, sql_type: str) -> Column:
    """Cast text already known to be a number; the clean-up runs only if the cast gives null."""
    return F.coalesce(col.try_cast(sql_type), F.regexp_replace(strip(col), "_", "").try_cast(sql_type))


def coercion(col: Column, dtype: T.DataType, target: str, fmt: str | None = None) -> Coercion:
    """How a value of ``dtype`` becomes ``target`` (a canonical rule type name)."""
    always, never = F.lit(True), F.lit(False)
    if target == "str":
        return Coercion(always, python_text(col, dtype), T.StringType())
    if target == "int":
        if is_text(dtype):
            ok = _matches(col, INT_TEXT)
            return Coercion(ok, F.when(ok, _number(col, "bigint")), T.LongType())
        if isinstance(dtype, (*_INTEGRAL, T.BooleanType)):
            return Coercion(always, col, dtype)
        if isinstance(dtype, _FLOATING):
            ok = ~F.isnan(col) & (F.abs(col) != float("inf"))
            return Coercion(ok, F.when(ok, col.try_cast("bigint")), T.LongType())
        if isinstance(dtype, T.DecimalType):
            return Coercion(always, col.try_cast("bigint"), T.LongType())
        return Coercion(never, F.lit(None).cast("bigint"), T.LongType())
    if target == "float":
        if is_text(dtype):
            ok = _matches(col, FLOAT_TEXT)
            return Coercion(ok, F.when(ok, _number(col, "double")), T.DoubleType())
        if isinstance(dtype, _FLOATING):
            return Coercion(always, col, dtype)
        if isinstance(dtype, (T.NumericType, T.BooleanType)):
            return Coercion(always, col.cast("double"), T.DoubleType())
        return Coercion(never, F.lit(None).cast("double"), T.DoubleType())
    if target == "bool":
        if is_text(dtype):
            word = F.lower(col)
            value = F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)
            return Coercion(word.isin(*TRUE_WORDS, *FALSE_WORDS), value, T.BooleanType())
        if isinstance(dtype, T.BooleanType):
            return Coercion(always, col, dtype)
        if isinstance(dtype, T.NumericType):
            return Coercion(always, col != 0, T.BooleanType())
        if isinstance(dtype, (T.ArrayType, T.MapType)):
            return Coercion(always, F.size(col) > 0, T.BooleanType())
        return Coercion(always, F.when(col.isNotNull(), True), T.BooleanType())
    if target in ("datetime", "date"):
        out: T.DataType = T.TimestampType() if target == "datetime" else T.DateType()
        if is_text(dtype):
            pattern = spark_datetime_format(fmt) if fmt else None
            if target == "datetime":
                value = F.try_to_timestamp(col, F.lit(pattern)) if pattern else F.try_to_timestamp(col)
            else:
                value = F.try_to_date(col, pattern) if pattern else F.try_to_date(col)
            return Coercion(value.isNotNull(), value, out)
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            value = col if isinstance(dtype, type(out)) else col.cast(out)
            return Coercion(always, value, out)
        return Coercion(never, F.lit(None).cast(out), out)
    raise ValueError(f"Unsupported type: {target}")


def strict_type_matches(dtype: T.DataType, target: str) -> bool:
    """Whether values of ``dtype`` already have the rule type (a bool counts as int)."""
    own = python_type_name(dtype)
    return own == target or (own == "bool" and target == "int") or (own == "datetime" and target == "date")
