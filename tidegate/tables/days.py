"""Folding the days of a table that are over.

Batches write into folders of their own, which makes repeating one exact and leaves many small files.  A fold moves the
batches of past days into one folder per day, ``closed/<table>/day=...``, with as many files as the day's rows need.  A batch
that is repeated after that is written into its own folder again; its folded rows are left out by readers from then on and
dropped by the next fold.  ``fold_log`` keeps which batch has rows in which day, so a fold reads no other folded day.

The new days are staged in full, with a list of what to do, before any folder is replaced; a fold that was broken off is
finished by the next one (or by ``recover``).  Until the folders of its batches are gone, readers take the rows from
those.  While a day that was folded before is replaced, a reader can miss it.  One writer per lake.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import functions as F

from tidegate.session import delete_path, folder_bytes, folder_files, folders_of, has_data, move_path, path_exists, write_marker
from tidegate.tables.lake import BATCHES, DAYS, PARTITIONS, SCHEMAS, Lake

#: Stored bytes from which a day gets another file.
FILE_BYTES = 128 << 20


def fold_closed_days(lake: Lake, now: datetime | None = None) -> dict[str, list[str]]:
    """Folds the days before today in all tables; returns the days that were written, by table."""
    today = f"{now or datetime.now():%Y-%m-%d}"
    done = {name: fold(lake, name, today) for name in (*BATCHES, *DAYS)}
    return {name: days for name, days in done.items() if days}


def fold_on_new_day(lake: Lake) -> None:
    """Folds once a day: the first caller of a day does it, a marker tells the others."""
    marks = f"{lake.root}/closed/_days"
    today = f"folded={datetime.now():%Y-%m-%d}"
    if path_exists(lake.spark, f"{marks}/{today}"):
        return
    fold_closed_days(lake)
    delete_path(lake.spark, marks)
    write_marker(lake.spark, f"{marks}/{today}")


def fold(lake: Lake, name: str, before: str) -> list[str]:
    """Folds the batches of a table whose newest row is of a day before ``before``; rows without a time are never folded."""
    recover(lake, name)
    if not lake.has(name):
        return []
    return _join_files(lake, name, before) if name in DAYS else _fold_batches(lake, name, before)


def _fold_batches(lake: Lake, name: str, before: str) -> list[str]:
    spark, staging = lake.spark, _staging(lake, name)
    keys, at = BATCHES[name]
    batch, day = F.concat_ws("/", *keys), F.date_format(at, "yyyy-MM-dd")
    live = lake.live(name).withColumns({"_batch": batch, "_day": day})
    # dates, not texts: a greatest text is found by sorting all rows
    last = live.groupBy("_batch").agg(F.max(F.to_date(at)).alias("last"), F.count_if(F.col("_day").isNull()).alias("undated"))
    over = last.filter((F.col("last") < F.lit(before).cast("date")) & (F.col("undated") == 0)).select("_batch").collect()  # names of folders to delete
    if not over:
        return []
    # stored, Spark knows their size and does not shuffle the table's rows to join them
    spark.createDataFrame(over, "_batch STRING").coalesce(1).write.parquet(f"{staging}/over")
    names = spark.read.schema("_batch STRING").parquet(f"{staging}/over")
    rows = live.join(names, "_batch", "left_semi")
    # days in which one of them was folded before
    earlier = lake.read("fold_log").filter(F.col("name") == name).join(names, F.col("batch") == F.col("_batch"), "left_semi")
    days = sorted(r[0] for r in rows.select("_day").union(earlier.select("day")).distinct().collect())
    kept = lake.closed(name).filter(F.col("day").isin(days)).withColumn("_batch", batch).join(names, "_batch", "left_anti")
    columns = [c for c in live.columns if not c.startswith("_")]
    fresh = rows.select(*columns, F.col("_day").alias("day")).unionByName(kept.select(*columns, "day"))
    # files follow the bytes of a day: small days are joined, large ones split
    fresh.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(f"{staging}/rows")
    log = rows.select(F.lit(name).alias("name"), F.col("_batch").alias("batch"), F.col("_day").alias("day")).distinct()
    log.repartition(1).write.parquet(f"{staging}/log")  # coalesce would draw the scan into one task
    staged = set(folders_of(spark, f"{staging}/rows"))
    todo = [("empty", d) for d in days if f"day={d}" not in staged] + [("batch", r[0]) for r in over]
    _commit(lake, name, todo)
    return days


def _join_files(lake: Lake, name: str, before: str) -> list[str]:
    """Days that have more files than their bytes need."""
    spark, folders = lake.spark, folders_of(lake.spark, lake.path(name))
    past = [f.partition("=")[2] for f in folders if f.startswith("day=") and f.partition("=")[2] < before]
    days = []
    for d in past:
        folder = f"{lake.path(name)}/day={d}"
        if folder_files(spark, folder) > 1 + folder_bytes(spark, folder) // FILE_BYTES:
            days.append(d)
    if days:
        rows = lake.live(name).filter(F.col("day").isin(days))
        rows.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(f"{_staging(lake, name)}/rows")
        _commit(lake, name, [])
    return days


def _staging(lake: Lake, name: str) -> str:
    return f"{lake.root}/closed/_fold_{name}"


def _commit(lake: Lake, name: str, todo: list[tuple[str, str]]) -> None:
    staging = _staging(lake, name)
    lake.spark.createDataFrame(todo, "what STRING, name STRING").coalesce(1).write.parquet(f"{staging}/todo")
    write_marker(lake.spark, f"{staging}/_READY")
    recover(lake, name)


def recover(lake: Lake, name: str) -> None:
    """Finishes the fold of a table that was staged in full, or drops what was staged in part.  Each step can be repeated."""
    spark, staging = lake.spark, _staging(lake, name)
    if not path_exists(spark, f"{staging}/_READY"):
        if path_exists(spark, staging):
            delete_path(spark, staging)
        return
    target = lake.path(name) if name in DAYS else lake.closed_path(name)
    todo = spark.read.schema("what STRING, name STRING").parquet(f"{staging}/todo").collect()
    for folder in folders_of(spark, f"{staging}/rows"):
        delete_path(spark, f"{target}/{folder}")
        move_path(spark, f"{staging}/rows/{folder}", f"{target}/{folder}")
    for r in todo:
        if r.what == "empty":
            delete_path(spark, f"{target}/day={r.name}")
    over = {r.name for r in todo if r.what == "batch"}
    if over:
        for folder, batch in _batch_folders(lake, name):
            if batch in over:
                delete_path(spark, folder)
        if has_data(spark, f"{staging}/log"):
            lake.append(spark.read.schema(SCHEMAS["fold_log"]).parquet(f"{staging}/log"), "fold_log")
    delete_path(spark, staging)


def _batch_folders(lake: Lake, name: str) -> Iterator[tuple[str, str]]:
    """The batch folders of a table, each with the name of its batch."""
    found = [(lake.path(name), {})]
    for column in PARTITIONS[name]:
        found = [
            (f"{path}/{folder}", {**values, column: unquote(folder.partition("=")[2])})
            for path, values in found
            for folder in folders_of(lake.spark, path)
            if folder.startswith(f"{column}=")
        ]
    for path, values in found:
        yield path, "/".join(values[k] for k in BATCHES[name][0])


def drop_days(lake: Lake, name: str, before: str) -> list[str]:
    """Deletes the folders of days before ``before``; nothing is read."""
    folder = lake.path(name) if name in DAYS else lake.closed_path(name)
    old = [f for f in folders_of(lake.spark, folder) if f.startswith("day=") and f.partition("=")[2] < before]
    for f in old:
        delete_path(lake.spark, f"{folder}/{f}")
    return [f.partition("=")[2] for f in old]
