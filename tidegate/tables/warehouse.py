"""The warehouse table: keyed rows, replaced on conflict.

A batch is appended to a log partition of its own, so the cost of a write follows the batch
and not the table; this is what a stream needs.  ``compact`` folds the log into the base,
which is partitioned by a hash of the key, and rewrites only buckets that changed.  The number of buckets grows with the
table by linear hashing: a new bucket takes its rows from one old bucket, and no other is touched.  ``upsert``
appends and folds when the log has become a tenth of the base.  ``current`` is the table as readers should see it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.payload import checksum, data_columns, payload, record_id as record_id_of
from tidegate.functions.values import quoted
from tidegate.session import delete_path, folder_bytes, folders_of, has_data, path_exists, write_marker
from tidegate.tables.lake import Lake

_ROW = ("record_id", "source_id", "data", "schema_version_id", "processed_at", "checksum")
_REPLACED = ("data", "schema_version_id", "processed_at", "checksum")
_ORDERED = (*_ROW, "order_key")
_ORDER_TYPE = "array<struct<n: decimal(38,10), t: string>>"


def check_batch_id(batch_id: str) -> str:
    """Batch ids name folders, so they keep to letters, digits, ``_ . -``."""
    if not re.fullmatch(r"[A-Za-z0-9_.-]{1,200}", batch_id):
        raise ValueError(f"Not a usable batch id: {batch_id!r}")
    return batch_id


def bucket_of(key: Column, buckets: int) -> Column:
    """Linear hashing: the place in the next power of two, or, if there is no such bucket yet, in the power of two before."""
    whole = _power(buckets)
    place = F.pmod(F.xxhash64(key), F.lit(whole)).cast("int")
    return F.when(place < buckets, place).otherwise(place - whole // 2).cast("int")


def _power(buckets: int) -> int:
    return 1 << (buckets - 1).bit_length()


def split_from(bucket: int, buckets: int) -> int:
    """The one of ``buckets`` buckets that a new bucket takes its rows from."""
    while bucket >= buckets:
        bucket -= _power(bucket + 1) // 2
    return bucket


def order_key(df: DataFrame, columns: Iterable[str], types: T.StructType | None = None) -> Column:
    """What versions of a record are compared by, in one type for all tables: numbers and times as numbers, other values as texts; nulls
    come first.  With ``types``, texts are read as the types they have there.  Null without columns."""
    parts = []
    for c in columns:
        value, kind = quoted(c), df.schema[c].dataType
        if types is not None and c in types.names and isinstance(kind, T.StringType):
            value, kind = value.try_cast(types[c].dataType), types[c].dataType
        if isinstance(kind, T.DateType):
            value, kind = value.cast("timestamp"), T.TimestampType()
        if isinstance(kind, T.TimestampNTZType):
            value = value.cast("timestamp")
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            n, t = F.unix_micros(value), F.lit(None)
        elif isinstance(kind, (T.NumericType, T.BooleanType)):
            n, t = value.try_cast("decimal(38,10)"), F.lit(None)
        else:
            n, t = F.lit(None), value
        parts.append(F.struct(n.cast("decimal(38,10)").alias("n"), t.cast("string").alias("t")))
    return F.array(*parts).cast(_ORDER_TYPE) if parts else F.lit(None).cast(_ORDER_TYPE)


def warehouse_rows(
    df: DataFrame,
    source_id: str,
    schema_version_id: int | None = None,
    *,
    record_id: Column | None = None,
    processed_at: Column | None = None,
    columns: list[str] | None = None,
    order: Column | None = None,
) -> DataFrame:
    """Records in the warehouse layout; the payload is the whole row without helper columns.

    ``order`` (see ``order_key``) says which version of a record is newer, whenever it arrives.
    """
    cols = columns if columns is not None else data_columns(df, drop=("source_id", "validation_status"))
    return df.select(
        (record_id if record_id is not None else record_id_of(df)).alias("record_id"),
        F.lit(source_id).alias("source_id"),
        payload(df, cols).alias("data"),
        F.lit(schema_version_id).cast("bigint").alias("schema_version_id"),
        (processed_at if processed_at is not None else F.current_timestamp()).alias("processed_at"),
        checksum(df, cols).alias("checksum"),
        (order if order is not None else F.lit(None).cast(_ORDER_TYPE)).alias("order_key"),
    )


def last_per_key(rows: DataFrame, order: Column) -> DataFrame:
    """The newest version of each record: by its order key if it has one, then by ``order``, which is by arrival.  The source of
    the first one to arrive stays."""
    value = F.struct(*_REPLACED, "order_key")
    newest = F.struct(F.col("order_key").alias("version"), order.alias("arrival"))
    picked = rows.groupBy("record_id").agg(F.max_by(value, newest).alias("_row"), F.min_by("source_id", order).alias("source_id"))
    return picked.select("record_id", "source_id", *[F.col("_row").getField(c).alias(c) for c in (*_REPLACED, "order_key")])


def merge_rows(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Upsert as a frame: incoming values win, the stored source stays, one row per record.

    ``incoming`` must hold each record once.  Both sides are unique in the key, so no join
    partition can be hot.
    """
    new = incoming.select(*[F.col(c).alias(f"_n_{c}") for c in _ROW])
    joined = existing.select(*_ROW).join(new, F.col("record_id") == F.col("_n_record_id"), "full_outer")
    is_new = F.col("_n_record_id").isNotNull()
    return joined.select(
        F.coalesce("record_id", "_n_record_id").alias("record_id"),
        F.when(F.col("record_id").isNotNull(), F.col("source_id")).otherwise(F.col("_n_source_id")).alias("source_id"),
        *[F.when(is_new, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in _REPLACED],
    )


class Warehouse:
    def __init__(self, lake: Lake):
        self.lake = lake
        self.spark = lake.spark
        self._staging = f"{lake.root}/_staging/warehouse"

    def base(self) -> DataFrame:
        return self.lake.read("warehouse_data")

    def log(self) -> DataFrame:
        return self.lake.read("warehouse_log")

    def current(self) -> DataFrame:
        base = self.base().select(*_ORDERED)
        if not has_data(self.spark, self.lake.path("warehouse_log")):
            return base.select(*_ROW)
        log = self.log().select(*_ORDERED, "batch_seq", "batch_id")
        if len(folders_of(self.spark, self.lake.path("warehouse_log"))) == 1 and not self.lake.has("warehouse_data"):
            return log.select(*_ROW)  # one batch holds each record once
        both = base.withColumns({"batch_seq": F.lit(-1).cast("bigint"), "batch_id": F.lit("")}).unionByName(log)
        return last_per_key(both, F.struct("batch_seq", "batch_id")).select(*_ROW)

    def append(
        self, rows: DataFrame, batch_id: str, batch_seq: int | None = None, order: Column | None = None, unique: bool = False,
        count: bool = True,
    ) -> int:
        """Add a batch to the log and return its number of records.

        The newest row (by ``order``, default processed_at) of a record that occurs more than
        once is kept; ``unique`` says that none does and saves the shuffle.  Repeating a batch
        id replaces the earlier attempt.  Without ``count`` nothing is read back.
        """
        check_batch_id(batch_id)
        seq = batch_seq if batch_seq is not None else time.time_ns() // 1000
        if "order_key" not in rows.columns:
            rows = rows.withColumn("order_key", F.lit(None).cast(_ORDER_TYPE))
        if not unique:
            newest = order if order is not None else F.col("processed_at")
            rows = last_per_key(rows, F.struct(newest.alias("o"), F.col("checksum").alias("t")))
        # null ids would be merged into one record, so they are an error here
        no_id = F.raise_error(F.lit("a warehouse row has no record_id")).cast("string")
        rows = rows.withColumn("record_id", F.coalesce("record_id", no_id))
        stored = rows.withColumns({"batch_seq": F.lit(seq).cast("bigint"), "batch_id": F.lit(batch_id)})
        self.lake.replace_partitions(stored, "warehouse_log")
        folder = f"{self.lake.path('warehouse_log')}/batch_id={batch_id}"
        return self.spark.read.parquet(folder).count() if count and path_exists(self.spark, folder) else 0

    def fold_is_due(self, share: float = 0.1, batches: int = 16) -> bool:
        """Whether the log has grown to this share of the base, or to this many batches.

        Folding then keeps the bytes rewritten per byte loaded bounded (by 1 / share), however
        large the table and however small the batches, and the log a reader has to settle small.  The first batches of a table
        wait for each other.
        """
        log, base = (folder_bytes(self.spark, self.lake.path(n)) for n in ("warehouse_log", "warehouse_data"))
        return base > 0 and log >= share * base or self.batches_waiting() >= batches

    def batches_waiting(self) -> int:
        """Batches in the log."""
        return len(folders_of(self.spark, self.lake.path("warehouse_log")))

    def upsert(
        self, rows: DataFrame, batch_id: str, batch_seq: int | None = None, order: Column | None = None, fold: bool | None = None
    ) -> int:
        """Append a batch and fold the log if that is due (``fold`` overrides)."""
        count = self.append(rows, batch_id, batch_seq, order)
        if fold if fold is not None else self.fold_is_due():
            self.compact()
        return count

    def upsert_one(self, row: DataFrame, batch_id: str) -> int:
        """Exactly one row; more are an error, as the rest would be lost."""
        if len(row.limit(2).collect()) > 1:
            raise ValueError("upsert_one takes one row; use upsert")
        return self.upsert(row, batch_id)

    def compact(self) -> int:
        """Fold the log into the base and return the number of buckets rewritten.

        The new contents of the touched buckets are written to a staging folder first.  If the
        job dies while the base is being replaced, the complete staging copy is applied again
        by the next writer (or by ``recover``), so no bucket is ever lost.
        """
        self.recover()
        log_path = self.lake.path("warehouse_log")
        if not has_data(self.spark, log_path):
            return 0
        folded = [f.removeprefix("batch_id=") for f in folders_of(self.spark, log_path) if f.startswith("batch_id=")]
        before = self.lake.bucket_count()
        bytes_now = sum(folder_bytes(self.spark, self.lake.path(n)) for n in ("warehouse_log", "warehouse_data"))
        buckets = max(before, -(-bytes_now // self.lake.bucket_bytes))
        log = self.log().filter(F.col("batch_id").isin(folded))
        # a single batch holds each record once already
        latest = log.select(*_ORDERED) if len(folded) == 1 else last_per_key(log, F.struct("batch_seq", "batch_id"))
        incoming = latest.withColumn("bucket", bucket_of(F.col("record_id"), buckets))
        # at most `buckets` numbers: those with news, and those that are split and what comes of them
        touched = {r.bucket for r in incoming.select("bucket").distinct().collect()} | set(range(before, buckets))
        touched |= {split_from(b, before) for b in touched}
        existing = self.lake.read("warehouse_data").filter(F.col("bucket").isin(sorted(touched)))
        if buckets > before:
            existing = existing.withColumn("bucket", bucket_of(F.col("record_id"), buckets))
        both = existing.select(*_ORDERED, "bucket", F.lit(0).alias("_new")).unionByName(incoming.select(*_ORDERED, "bucket", F.lit(1).alias("_new")))
        # One shuffle serves the merge and the files: by bucket, and large buckets in parts of their own task and file, by another
        # hash than the bucket's.  A record has at most two rows here and keys hash evenly, so buckets and parts are even too.  Parts
        # are dealt by their number: hashed once more, some tasks would get several.
        parts = -(-bytes_now // (buckets * self.lake.part_bytes))
        part = F.col("bucket") * parts + F.pmod(F.hash("record_id"), F.lit(parts))
        placed = both.withColumn("_part", part).repartitionById(max(1, len(touched)) * parts, "_part")
        merged = placed.groupBy("bucket", "_part", "record_id").agg(
            F.max_by(F.struct(*_REPLACED, "order_key"), F.struct("order_key", "_new")).alias("_row"), F.min_by("source_id", "_new").alias("source_id")
        )
        out = merged.select("record_id", "source_id", *[F.col("_row").getField(c).alias(c) for c in (*_REPLACED, "order_key")], "bucket")
        delete_path(self.spark, self._complete)
        self.lake.shaped(out, "warehouse_data").write.mode("overwrite").partitionBy("bucket").parquet(self._staging)
        plan = self.spark.range(0, 1, 1, 1).select(F.lit(buckets).alias("buckets"), F.array(*map(F.lit, sorted(touched))).alias("touched"))
        plan.write.mode("overwrite").parquet(f"{self._staging}_plan")
        write_marker(self.spark, self._complete)
        if not self.recover():
            raise RuntimeError("the fold was not applied; the log is kept")
        for batch_id in folded:
            delete_path(self.spark, f"{log_path}/batch_id={batch_id}")
        return len(touched)

    @property
    def _complete(self) -> str:
        """Own marker of a complete staging copy: Spark's may be switched off."""
        return f"{self._staging}_complete"

    def recover(self) -> bool:
        """Apply a complete staging copy, if a fold left one behind; whether there was one."""
        if not path_exists(self.spark, self._complete):
            return False
        plan = self.spark.read.parquet(f"{self._staging}_plan").first()
        if has_data(self.spark, self._staging):
            self.lake.replace_partitions(self.spark.read.schema(self.lake.read("warehouse_data").schema).parquet(self._staging), "warehouse_data")
            # a split can leave nothing in a bucket
            filled = {int(f.removeprefix("bucket=")) for f in folders_of(self.spark, self._staging) if f.startswith("bucket=")}
            for bucket in set(plan.touched) - filled:
                delete_path(self.spark, f"{self.lake.path('warehouse_data')}/bucket={bucket}")
        if plan.buckets != self.lake.bucket_count() or not self.lake.has("lake_setting"):
            self.lake.set_bucket_count(plan.buckets)
        delete_path(self.spark, self._complete)
        delete_path(self.spark, self._staging)
        return True


def upsert_catalog_table(rows: DataFrame, table: str) -> None:
    """The same upsert as one MERGE, for catalogs with row-level writes."""
    target, source = F.col("t.record_id"), F.col("s.record_id")
    new_values = {c: F.col(f"s.{c}") for c in _REPLACED}
    (
        rows.alias("s")
        .mergeInto(f"{table} AS t", target == source)
        .whenMatched()
        .update(new_values)
        .whenNotMatched()
        .insertAll()
        .merge()
    )


# -- databases ------------------------------------------------------------------------


def jdbc_merge_sql(staging: str, target: str, dialect: str = "postgresql") -> str:
    """The statement that moves a staged batch into the target table inside the database."""
    cols = ", ".join(_ROW)
    if dialect == "postgresql":
        sets = ", ".join(f"{c} = EXCLUDED.{c}" for c in _REPLACED)
        picked = f"SELECT DISTINCT ON (record_id) {cols} FROM {staging} ORDER BY record_id, processed_at DESC"
        return f"INSERT INTO {target} ({cols}) {picked} ON CONFLICT (record_id) DO UPDATE SET {sets}"
    sets = ", ".join(f"{c} = s.{c}" for c in _REPLACED)
    values = ", ".join(f"s.{c}" for c in _ROW)
    return (
        f"MERGE INTO {target} t USING {staging} s ON t.record_id = s.record_id "
        f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({values})"
    )


def write_jdbc(rows: DataFrame, url: str, staging: str, properties: dict[str, str] | None = None, partitions: int = 16) -> None:
    """Executors write the batch to a staging table; run ``jdbc_merge_sql`` in the database after it."""
    unique = last_per_key(rows, F.struct("processed_at", "checksum")).select(*_ROW)
    unique.repartition(partitions).write.mode("overwrite").jdbc(url, staging, properties=properties or {})
