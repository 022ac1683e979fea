"""Normalising values and shaping columns before validation.

Each step keeps the values it changed in a ``_before_*`` struct for the audit trail.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.patterns import spark_datetime_format
from tidegate.functions.payload import is_helper
from tidegate.functions.values import coercion, is_text, quoted, strip
from tidegate.operators.schema import merge_schemas

# The two date spellings that are unified by default.
DATE_FORMATS = ("%m/%d/%Y", "%Y-%m-%d")
DATE_OUTPUT = "yyyy-MM-dd"


def normalize_dates(
    df: DataFrame, columns: Iterable[str], formats: Iterable[str] = DATE_FORMATS, output: str = DATE_OUTPUT
) -> DataFrame:
    """Rewrite text dates in one format; text in none of the formats stays as it is."""
    columns = list(columns)
    patterns = [spark_datetime_format(f) for f in formats]
    new = {}
    for c in columns:
        parsed = F.coalesce(*[F.try_to_date(quoted(c), p) for p in patterns])
        new[c] = F.coalesce(F.date_format(parsed, spark_datetime_format(output)), quoted(c))
    return _rewrite(df, new, "_before_dates")


def trim_fields(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Strip all Unicode white space from both ends of text columns."""
    if columns is None:
        columns = [f.name for f in df.schema if is_text(f.dataType) and not is_helper(f.name)]
    return _rewrite(df, {c: strip(quoted(c)) for c in columns}, "_before_trim")


def _rewrite(df: DataFrame, new: dict, before: str) -> DataFrame:
    kept = F.struct(*[quoted(c).alias(c) for c in new])
    return df.select(*[new[c].alias(c) if c in new else quoted(c) for c in df.columns], kept.alias(before))


def fit_columns(df: DataFrame, schema: T.StructType, evolve: bool = True) -> tuple[DataFrame, T.StructType, list[str]]:
    """Settle columns the schema does not know: add them to it, or drop them.

    Returns the frame, the schema to use from now on and one text per decision.  Known
    columns that are absent are added as nulls.
    """
    known = set(schema.names)
    extra = [f for f in df.schema if f.name not in known and not is_helper(f.name)]
    helpers = [c for c in df.columns if is_helper(c) and c not in known]
    if evolve:
        additions = T.StructType([T.StructField(f.name, f.dataType, True) for f in extra])
        schema, notes = merge_schemas(schema, T.StructType([*schema.fields, *additions.fields]))
    else:
        notes = [f"Dropped field: {f.name} ({f.dataType})" for f in extra]
    cols = []
    for f in schema:
        cols.append(quoted(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *[quoted(c) for c in helpers]), schema, notes


# Spark type -> rule type used to read text as that type.
_READ_AS = {
    T.ByteType: "int",
    T.ShortType: "int",
    T.IntegerType: "int",
    T.LongType: "int",
    T.FloatType: "float",
    T.DoubleType: "float",
    T.BooleanType: "bool",
    T.TimestampType: "datetime",
    T.DateType: "date",
}


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Read text columns as the types of a stored schema; originals stay in ``_raw``."""
    new, raw = {}, []
    for f in schema:
        target = _READ_AS.get(type(f.dataType))
        if f.name in df.columns and target and is_text(df.schema[f.name].dataType):
            new[f.name] = coercion(quoted(f.name), T.StringType(), target).value.try_cast(f.dataType)
            raw.append(quoted(f.name).alias(f.name))
    if not new:
        return df
    return df.select(*[new[c].alias(c) if c in new else quoted(c) for c in df.columns], F.struct(*raw).alias("_raw"))


def sample_rows(df: DataFrame, fraction: float, seed: int | None = None) -> DataFrame:
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def sample_by_key(df: DataFrame, fraction: float, *keys: str) -> DataFrame:
    """The rows whose key's MD5 lies in the first ``fraction`` of its range: the same rows in every
    run, engine and partitioning, and the same keys from every table."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must lie between 0 and 1")
    text = F.concat_ws("-", *[F.coalesce(quoted(k).cast("string"), F.lit("")) for k in keys])
    bound = round(fraction * 16**8)
    return df if bound == 16**8 else df.filter(F.substring(F.md5(text), 1, 8) < f"{bound:08x}")
