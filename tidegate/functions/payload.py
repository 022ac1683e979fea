"""Packing records into JSON payloads, their checksums and their ids."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.values import quoted

# Columns that may name a record, in order of preference.
RECORD_ID_COLUMNS = ("transaction_id", "record_id")
DEDUP_KEY_COLUMNS = ("transaction_id", "record_id", "id")

# Columns the library adds to a frame; everything else is data.
HELPER_COLUMNS = frozenset({"_raw", "_v", "_copies", "_rid", "_good", "_corrupt_record", "_before_dates", "_before_trim", "_n", "_content", "_version"})
HELPER_PREFIXES = ("_f_", "_t_", "_in_", "_null_", "_dup_", "_uk_", "_us_", "_q_")

_KEEP_NULLS = {"ignoreNullFields": "false"}


def is_helper(name: str) -> bool:
    return name in HELPER_COLUMNS or name.startswith(HELPER_PREFIXES)


def data_columns(df: DataFrame, drop: Iterable[str] = ()) -> list[str]:
    """Columns that belong to the record."""
    dropped = set(drop)
    return [c for c in df.columns if not is_helper(c) and c not in dropped]


def payload(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The record as a JSON object, nulls kept."""
    cols = list(columns) if columns is not None else data_columns(df)
    if not cols:
        return F.lit("{}")
    return F.to_json(F.struct(*[quoted(c).alias(c) for c in cols]), _KEEP_NULLS)


def raw_payload(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """The record as it arrived: trimmed, reformatted and coerced columns go back to their original values."""
    cols = list(columns) if columns is not None else data_columns(df)
    arrived = {}
    for step in ("_raw", "_before_dates", "_before_trim"):  # the first step on a value is the last one here
        if step in df.columns:
            arrived |= {c: F.col(step).getField(c) for c in df.schema[step].dataType.names}
    parts = [arrived.get(c, quoted(c)).alias(c) for c in cols]
    if "_corrupt_record" in df.columns:
        packed = F.to_json(F.struct(*parts, quoted("_corrupt_record").alias("_corrupt_record")), _KEEP_NULLS)
        plain = F.to_json(F.struct(*parts), _KEEP_NULLS) if parts else F.lit("{}")
        return F.when(quoted("_corrupt_record").isNotNull(), packed).otherwise(plain)
    return F.to_json(F.struct(*parts), _KEEP_NULLS) if parts else F.lit("{}")


def _sorted_value(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        parts = [_sorted_value(col.getField(f.name), f.dataType).alias(f.name) for f in sorted(dtype, key=lambda f: f.name)]
        return F.when(col.isNotNull(), F.struct(*parts))
    if isinstance(dtype, T.MapType):
        return F.map_from_entries(F.array_sort(F.map_entries(col)))
    return col


def checksum(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """MD5 of the key-sorted JSON payload."""
    cols = sorted(columns if columns is not None else data_columns(df))
    parts = [_sorted_value(quoted(c), df.schema[c].dataType).alias(c) for c in cols]
    return F.md5(F.to_json(F.struct(*parts), _KEEP_NULLS) if parts else F.lit("{}"))


def record_id(df: DataFrame, columns: Iterable[str] = RECORD_ID_COLUMNS) -> Column:
    """First non-empty id column as text, null if there is none."""
    found = [F.nullif(quoted(c).cast("string"), F.lit("")) for c in columns if c in df.columns]
    return F.coalesce(*found) if found else F.lit(None).cast("string")


def payload_field(data: Column, path: str) -> Column:
    """One field of a JSON payload as text; dots step into nested objects."""
    return F.get_json_object(data, "$." + path)


def valid_identifier(col: Column) -> Column:
    """Record and source ids: 1 to 255 letters, digits, ``_ - .`` once stripped."""
    from tidegate.functions.values import strip

    bare = strip(col)
    return F.coalesce(bare.rlike(r"\A[A-Za-z0-9_.\-]+\z") & (F.length(bare) <= 255), F.lit(False))


def content_hash(df: DataFrame, columns: Iterable[str] | None = None) -> Column:
    """64-bit hash over whole rows; maps and variants are hashed as JSON."""
    parts = []
    for c in columns if columns is not None else df.columns:
        parts.append(F.to_json(quoted(c)) if _unhashable(df.schema[c].dataType) else quoted(c))
    return F.xxhash64(*parts) if parts else F.lit(0).cast("bigint")


def row_identity(df: DataFrame) -> Column:
    """Two hashes over whole rows, the second with the places of nulls: equal for equal rows only."""
    nulls = [quoted(c).isNull() for c in df.columns]
    return F.struct(content_hash(df).alias("a"), F.xxhash64(F.lit("row"), *nulls, content_hash(df, reversed(df.columns))).alias("b"))


def _unhashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _unhashable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_unhashable(f.dataType) for f in dtype)
    return False
