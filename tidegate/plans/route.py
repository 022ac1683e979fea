"""From validated rows to the tables; the same steps for a file batch and a stream batch."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field, replace
from typing import Iterator

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidegate.functions.payload import RECORD_ID_COLUMNS, content_hash, data_columns, payload, record_id as record_id_of
from tidegate.functions.values import is_text, quoted
from tidegate.operators import dedup, lineage, quarantine
from tidegate.operators.clean import DATE_FORMATS, DATE_OUTPUT, normalize_dates, trim_fields
from tidegate.operators.validate import CORRUPT, validate
from tidegate.rules.model import Rule
from tidegate.session import delete_path, shared_folder
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, order_key, warehouse_rows


@dataclass(frozen=True)
class Settings:
    """How records are identified, compared and judged."""

    id_columns: tuple[str, ...] = RECORD_ID_COLUMNS
    deduplicate: bool = True
    dedup_key: str | tuple[str, ...] | None = None
    latest_by: tuple[str, ...] = ()
    review_threshold: int = 3
    reject_all_null: bool = True
    audit_coercions: bool = True
    compact: bool | None = None  # fold the log: always, never, or when it is due
    trim: bool | tuple[str, ...] = False  # text columns to strip, or all of them
    date_columns: tuple[str, ...] = ()  # text dates to bring into one format
    date_formats: tuple[str, ...] = DATE_FORMATS
    date_output: str = DATE_OUTPUT
    log_duplicates: bool = True


def clean(df: DataFrame, settings: Settings) -> DataFrame:
    """The cleaning that the settings ask for; values as they were stay in ``_before_*``."""
    if settings.trim:
        df = trim_fields(df, None if settings.trim is True else [c for c in settings.trim if c in df.columns])
    dates = [c for c in settings.date_columns if c in df.columns and is_text(df.schema[c].dataType)]
    return normalize_dates(df, dates, settings.date_formats, settings.date_output) if dates else df


def judge_all(df: DataFrame, rules: Iterable[Rule], settings: Settings) -> DataFrame:
    """Every row, cleaned and validated; adds ``_rid`` and ``_v``."""
    df = clean(df, settings)
    return validate(
        df.withColumn("_rid", record_id_of(df, settings.id_columns)), rules, review_threshold=settings.review_threshold,
        reject_all_null=settings.reject_all_null, reject_lost_numbers=True, key=F.col("_rid"),
    )


def merge_keys(df: DataFrame, settings: Settings) -> list[list[str]]:
    """The keys of which the newest valid row is kept, one after another."""
    key = settings.dedup_key or dedup.dedup_key(df)
    keys = [[key] if isinstance(key, str) else list(key)] if settings.deduplicate and key else []
    # the warehouse holds a record id once; what is merged there counts as duplicate
    return keys if _ids_unique(df, settings) else [*keys, ["_rid"]]


def judge(df: DataFrame, rules: Iterable[Rule], settings: Settings) -> DataFrame:
    """Validate every row, then keep the newest *valid* row per key; adds ``_rid``, ``_v`` and ``_copies``.

    Rows that fail are all kept for the quarantine: no row is dropped unjudged, and an older
    valid row is not lost behind a newer one that fails.  Loads settle their rows after they are written (``settled``); this is the
    same as one frame.
    """
    judged = judge_all(df, rules, settings)
    for keys in merge_keys(df, settings):
        judged = _newest_valid(judged, keys, [c for c in settings.latest_by if c in df.columns])
    return judged if "_copies" in judged.columns else judged.withColumn("_copies", F.lit(1).cast("bigint"))


def _newest_valid(judged: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    good = F.col("_v.status") == "valid"
    helpers = [f"_key_{i}" for i in range(len(keys))]
    keyed = judged.withColumns({h: F.when(good, quoted(k)) for h, k in zip(helpers, keys)})
    return dedup.dedup_latest(keyed, helpers, newest).drop(*helpers)


@dataclass(frozen=True)
class Counts:
    total: int
    valid: int
    invalid: int
    duplicates: int
    events: dict[str, int] = field(default_factory=dict)  # audit events by type


@dataclass(frozen=True)
class Batch:
    """A judged batch on disk: ``good`` rows to load, ``bad`` ones, and the valid rows that newer ones replace (``lost``, see
    ``dedup.losers``; ``valid`` holds them and the good ones)."""

    valid: DataFrame
    good: DataFrame
    bad: DataFrame
    lost: DataFrame | None
    counts: Counts


@contextmanager
def settled(judged: DataFrame, keys: list[list[str]], latest_by: Iterable[str] = ()) -> Iterator[Batch]:
    """The judged rows, written once to the shared folder and read from there, with the newest valid row of each key settled.

    All sinks and counts read the same files, so they agree with each other even if executors are lost on the way, and the source is
    read and judged once.  Wide rows are not shuffled: duplicates are found among keys and row numbers.
    """
    spark = judged.sparkSession
    folder = shared_folder(spark)
    marked = judged.withColumns({
        "_good": F.col("_v.status") == "valid", "_content": content_hash(judged, data_columns(judged)), "_n": F.monotonically_increasing_id(),
    })
    marked.write.partitionBy("_good").parquet(f"{folder}/rows")
    schema = marked.select(*[c for c in marked.columns if c != "_good"], "_good").schema
    rows = spark.read.schema(schema).parquet(f"{folder}/rows")
    try:
        valid, bad = (rows.filter(c).drop("_good") for c in ("_good", "NOT _good"))
        good, lost = valid, None
        for k, key in enumerate(keys):
            behind = dedup.losers(good, key, [c for c in latest_by if c in judged.columns])
            behind.write.parquet(f"{folder}/lost{k}")
            behind = spark.read.schema(behind.schema).parquet(f"{folder}/lost{k}")
            if not behind.isEmpty():
                lost = behind if lost is None else lost.unionByName(behind)
                good = valid.join(lost.select("_n"), "_n", "left_anti")
        sizes = rows.agg(F.count_if("_good").alias("valid"), F.count_if(~F.col("_good")).alias("invalid")).first()
        gone = lost.count() if lost is not None else 0
        yield Batch(valid, good, bad, lost, Counts(sizes.valid + sizes.invalid, sizes.valid - gone, sizes.invalid, gone))
    finally:
        delete_path(spark, folder)


@contextmanager
def observed_copy(df: DataFrame, **metrics: Column) -> Iterator[tuple[DataFrame, dict]]:
    """The rows, written once to the shared folder, and aggregates of them that were gathered while they were written: the source
    is read once."""
    spark, seen = df.sparkSession, Observation()
    folder = shared_folder(spark)
    df.observe(seen, *[m.alias(name) for name, m in metrics.items()]).write.parquet(folder)
    try:
        yield spark.read.schema(df.schema).parquet(folder), seen.get
    finally:
        delete_path(spark, folder)


def write_sinks(
    lake: Lake,
    batch: Batch,
    rules: Iterable[Rule],
    source_id: str,
    batch_id: str,
    *,
    settings: Settings,
    schema_version_id: int | None = None,
    batch_seq: int | None = None,
    at: Column | None = None,
    compact: bool | None = None,
) -> Counts:
    """Warehouse, quarantine, duplicate and audit rows of one settled batch.

    Every write replaces the batch's own partitions, so a repeated batch leaves one copy.
    """
    at = at if at is not None else F.current_timestamp()
    counts, good, bad = batch.counts, batch.good, batch.bad
    seen = Observation()

    def quarantine_write() -> None:
        rejected = quarantine.quarantine_rows(bad, source_id, batch_id, quarantined_at=at, record_id=F.col("_rid"))
        lake.replace_partitions(rejected, "quarantine_record")

    def audit_write() -> None:
        audit = _audit_events(lake, good, bad, rules, source_id, counts, settings, schema_version_id, at)
        lake.replace_partitions(lineage.stored_form(audit, batch_id).observe(seen, *lineage.counted_types()), "audit_log")

    def warehouse_write() -> None:
        order = order_key(good, [c for c in settings.latest_by if c in good.columns])
        packed = warehouse_rows(good.drop(CORRUPT), source_id, schema_version_id, record_id=F.col("_rid"), processed_at=at, order=order)
        Warehouse(lake).append(packed, batch_id, batch_seq, unique=True, count=False)

    def duplicates_write() -> None:
        lost = dedup.duplicate_rows(batch.valid, batch.lost, payload(batch.valid.drop(CORRUPT)), F.col("_rid"))
        named = lost.withColumns({"source_id": F.lit(source_id), "logged_at": at, "batch_id": F.lit(batch_id)})
        lake.replace_partitions(named, "duplicate_log")

    # The sinks read the same staged files and do not depend on each other.
    jobs = [audit_write]
    if counts.invalid:
        jobs.append(quarantine_write)
    if counts.valid:
        jobs.append(warehouse_write)
    if counts.duplicates and settings.log_duplicates:
        jobs.append(duplicates_write)
    with ThreadPoolExecutor(len(jobs)) as pool:
        for done in [pool.submit(job) for job in jobs]:
            done.result()
    fold = compact if compact is not None else settings.compact
    if counts.valid and (fold if fold is not None else Warehouse(lake).fold_is_due()):
        Warehouse(lake).compact()
    return replace(counts, events={k: n for k, n in seen.get.items() if n})


def _audit_events(
    lake: Lake, good: DataFrame, bad: DataFrame, rules: Iterable[Rule], source_id: str, counts: Counts,
    settings: Settings, schema_version_id: int | None, at: Column,
) -> DataFrame:
    keys = {"record_id": F.col("_rid"), "source_id": F.lit(source_id), "created_at": at}
    failed = bad.select("_rid", F.col("_v.failed_rules").alias("failed_rules"), F.col("_v.error_messages").alias("error_messages"))
    audit = lineage.write_events(good, schema_version_id, **keys).unionByName(lineage.quarantine_events(failed, **keys))
    coerced = lineage.coercion_events(good, rules, **keys) if settings.audit_coercions else None
    if coerced is not None:
        audit = audit.unionByName(coerced)
    if "_before_trim" in good.columns:
        audit = audit.unionByName(lineage.trim_events(good, **keys))
    if "_before_dates" in good.columns:
        audit = audit.unionByName(lineage.date_events(good, settings.date_output, **keys))
    if counts.duplicates:
        removed = lake.spark.createDataFrame([(counts.duplicates,)], "duplicates BIGINT")
        audit = audit.unionByName(lineage.dedup_events(removed, source_id, at))
    return audit


def _ids_unique(rows: DataFrame, settings: Settings) -> bool:
    """Whether de-duplication already left one row per record id."""
    ids = [c for c in settings.id_columns if c in rows.columns]
    key = settings.dedup_key or dedup.dedup_key(rows)
    return settings.deduplicate and len(ids) == 1 and key in (ids[0], (ids[0],))
