"""Duplicates: remove, report, compare.

All of it is aggregation with map-side combining: each task sends at most one row per key,
so a key that holds a third of the input costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.payload import DEDUP_KEY_COLUMNS, content_hash, row_identity
from tidegate.functions.values import quoted


def dedup_key(df: DataFrame) -> str | None:
    """The column that names a record, if there is one."""
    return next((c for c in DEDUP_KEY_COLUMNS if c in df.columns), None)


def dedup_latest(df: DataFrame, keys: str | Iterable[str], order_by: Iterable[str] = (), copies: str = "_copies") -> DataFrame:
    """One row per key: the greatest in ``order_by``, ties settled by content.

    ``copies`` counts the rows a kept row stands for, so kept and removed rows add up to the
    input without a second pass.  Rows with a null key are all kept.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    total = F.sum(copies) if copies in df.columns else F.count(F.lit(1))  # rows may stand for several already
    columns = [c for c in df.columns if c != copies]
    rest = [c for c in columns if c not in keys]
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | quoted(k).isNull()
    order = F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order_by)], content_hash(df, columns).alias("tie"))
    # rows without a key are grouped by their content and given out as often as they came, so that a
    # task that runs again gives the same rows
    marked = df.select("*", F.when(no_key, row_identity(df)).alias("_alone"), order.alias("_order"))
    grouped = marked.groupBy(*[quoted(k) for k in keys], "_alone").agg(
        F.max_by(F.struct(*[quoted(c).alias(c) for c in rest], F.lit(0).alias("_pad")), "_order").alias("_row"),
        total.alias(copies),
    )
    alone = F.col("_alone").isNotNull()
    each = F.explode(F.sequence(F.lit(1).cast("bigint"), F.when(alone, F.col(copies)).otherwise(F.lit(1)))).alias("_each")
    return grouped.select("*", each).select(
        *[quoted(c) if c in keys else F.col("_row").getField(c).alias(c) for c in columns],
        F.when(alone, F.lit(1)).otherwise(F.col(copies)).alias(copies),
    )


def losers(rows: DataFrame, keys: str | Iterable[str], order_by: Iterable[str] = (), row: str = "_n", content: str = "_content") -> DataFrame:
    """(row number, ``_win``, ``_differs``): the rows that are not the newest of their key, each with the number of the row that is
    and whether it says something else.

    ``row`` numbers the rows, ``content`` is a hash of each.  Only keys, order, hash and number are shuffled, and combined map-side;
    wide rows stay where they are, and the join of a hot key can be split, as each key has one newest row.  Rows with a null key never lose.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = F.lit(True)
    for k in keys:
        known = known & quoted(k).isNotNull()
    key = F.struct(*[quoted(k).alias(f"k{i}") for i, k in enumerate(keys)])
    order = F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order_by)], F.col(content).alias("content"), F.col(row).alias("row"))
    narrow = rows.filter(known).select(key.alias("_key"), order.alias("_order"))
    best = narrow.groupBy("_key").agg(F.max("_order").alias("_best"), F.count(F.lit(1)).alias("_copies")).filter("_copies > 1")
    behind = narrow.join(best.select("_key", "_best"), "_key").filter("_order.row <> _best.row")
    return behind.select(F.col("_order.row").alias(row), F.col("_best.row").alias("_win"), (F.col("_order.content") != F.col("_best.content")).alias("_differs"))


def duplicate_rows(rows: DataFrame, lost: DataFrame, value: Column, record_id: Column, row: str = "_n") -> DataFrame:
    """(record_id, lost_data, kept_data, copies, differs): what ``losers`` lost, equal values counted, beside what was kept."""
    values = rows.select(row, record_id.alias("record_id"), value.alias("data"))
    counted = lost.join(values, row).groupBy("_win", "record_id", F.col("data").alias("lost_data"), F.col("_differs").alias("differs")).agg(F.count(F.lit(1)).alias("copies"))
    kept = values.select(F.col(row).alias("_win"), F.col("data").alias("kept_data"))
    return counted.join(kept, "_win").select("record_id", "lost_data", "kept_data", "copies", "differs")


def report_of(log: DataFrame) -> DataFrame:
    """The duplicate report of a log of lost rows: per record its copies, how many different values, and the kept one."""
    return log.groupBy("source_id", "batch_id", "record_id", F.col("kept_data").alias("kept_value")).agg(
        (F.sum("copies") + 1).alias("copies"), (F.count_if("differs") + 1).alias("distinct_values")
    )


def dedup_any(df: DataFrame, key: str | None = None, copies: str = "_copies") -> DataFrame:
    """One row per record id (whichever id column exists); without one nothing changes."""
    key = key or dedup_key(df)
    if key is None:
        return df.withColumn(copies, F.lit(1).cast("bigint"))
    return dedup_latest(df, key, copies=copies)


def duplicates_removed(deduped: DataFrame, copies: str = "_copies") -> DataFrame:
    """One row: rows read, rows kept, rows removed."""
    total = F.coalesce(F.sum(copies), F.lit(0))
    kept = F.count(F.lit(1))
    return deduped.agg(total.alias("total"), kept.alias("kept"), (total - kept).alias("duplicates"))


def duplicate_report(df: DataFrame, key: str, order_by: Iterable[str], value: Column) -> DataFrame:
    """Keys that occur more than once: copies, how many different values, which one is kept."""
    order = F.struct(*[quoted(c).alias(f"o{i}") for i, c in enumerate(order_by)], value.alias("tie"))
    per_value = (
        df.select(quoted(key).alias(key), value.alias("_value"), order.alias("_order"))
        .filter(quoted(key).isNotNull())
        .groupBy(key, "_value")
        .agg(F.count(F.lit(1)).alias("_n"), F.max("_order").alias("_order"))
    )
    return (
        per_value.groupBy(key)
        .agg(
            F.sum("_n").alias("copies"),
            F.count(F.lit(1)).alias("distinct_values"),
            F.max_by("_value", "_order").alias("kept_value"),
        )
        .filter("copies > 1")
    )


def duplicate_values(df: DataFrame, key: str, value: Column) -> DataFrame:
    """Every value of every repeated key with its number of copies."""
    per_value = df.select(quoted(key).alias(key), value.alias("value")).filter(quoted(key).isNotNull()).groupBy(key, "value").count()
    repeated = per_value.groupBy(key).agg(F.sum("count").alias("_n")).filter("_n > 1").select(key)
    return per_value.join(repeated, key, "left_semi").withColumnRenamed("count", "copies")


def classify_changes(existing: DataFrame, incoming: DataFrame, key: str = "record_id") -> DataFrame:
    """Incoming rows as insert, update or unchanged, by checksum against the stored row."""
    stored = existing.select(key, F.col("checksum").alias("_stored"))
    change = (
        F.when(F.col("_stored").isNull(), "insert")
        .when(F.col("_stored") == F.col("checksum"), "unchanged")
        .otherwise("update")
    )
    return incoming.join(stored, key, "left").withColumn("change", change).drop("_stored")


def conflicts(existing: DataFrame, incoming: DataFrame, key: str = "record_id") -> DataFrame:
    """Records that arrive with other values than the stored ones."""
    stored = existing.select(key, F.col("data").alias("stored_data"), F.col("checksum").alias("stored_checksum"))
    return incoming.join(stored, key).filter(F.col("checksum") != F.col("stored_checksum")).select(
        key, "stored_data", F.col("data").alias("incoming_data")
    )
