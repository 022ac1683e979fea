"""The tables of one deployment, as partitioned Parquet under one root folder."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.session import has_data

SCHEMAS = {
    "data_source": """source_id STRING, source_type STRING, schema_version_id BIGINT,
        connection_info MAP<STRING, STRING>, enabled BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP, _rev BIGINT""",
    "validation_rule": """rule_id BIGINT, rule_name STRING, rule_type STRING, field_name STRING, parameters STRING,
        enabled BOOLEAN, severity STRING, created_at TIMESTAMP, _rev BIGINT""",
    "schema_version": """schema_id BIGINT, source_id STRING, version INT, schema_definition STRING, inferred BOOLEAN,
        confidence DOUBLE, created_at TIMESTAMP, deprecated_at TIMESTAMP, _rev BIGINT""",
    "warehouse_data": """record_id STRING, source_id STRING, data STRING, schema_version_id BIGINT,
        processed_at TIMESTAMP, checksum STRING, order_key ARRAY<STRUCT<n: DECIMAL(38,10), t: STRING>>, bucket INT""",
    "warehouse_log": """record_id STRING, source_id STRING, data STRING, schema_version_id BIGINT,
        processed_at TIMESTAMP, checksum STRING, order_key ARRAY<STRUCT<n: DECIMAL(38,10), t: STRING>>, batch_seq BIGINT,
        batch_id STRING""",
    "quarantine_record": """quarantine_id BIGINT, record_id STRING, raw_payload STRING, failed_rules ARRAY<STRING>,
        error_messages ARRAY<STRING>, status STRING, quarantined_at TIMESTAMP, source_id STRING, batch_id STRING""",
    "quarantine_event": """quarantine_id BIGINT, source_id STRING, batch_id STRING, event STRING, at TIMESTAMP,
        event_batch STRING""",
    "duplicate_log": """record_id STRING, source_id STRING, lost_data STRING, kept_data STRING, copies BIGINT, differs BOOLEAN,
        logged_at TIMESTAMP, batch_id STRING""",
    "audit_log": """log_id BIGINT, record_id STRING, source_id STRING, transformation_type STRING, field_name STRING,
        old_value STRING, new_value STRING, rule_applied STRING, created_at TIMESTAMP, month STRING, batch_id STRING""",
    "run_log": """batch_id STRING, source_id STRING, mode STRING, status STRING, total BIGINT, valid BIGINT,
        invalid BIGINT, duplicates BIGINT, seconds DOUBLE, started_at TIMESTAMP, error STRING, component STRING,
        attempt INT, events MAP<STRING, BIGINT>, day STRING""",
    "stream_progress": """query_id STRING, run_id STRING, query_name STRING, batch_id BIGINT, at TIMESTAMP, input_rows BIGINT,
        input_rate DOUBLE, processing_rate DOUBLE, trigger_ms BIGINT, backpressure BOOLEAN, lag BIGINT, day STRING""",
    "lake_setting": "name STRING, value BIGINT",
    "fold_log": "name STRING, batch STRING, day STRING",
    "alert": """record_id STRING, source_id STRING, rule_name STRING, message STRING, raised_at TIMESTAMP,
        batch_id STRING""",
}

PARTITIONS = {
    "warehouse_data": ["bucket"],
    "warehouse_log": ["batch_id"],
    "quarantine_record": ["source_id", "batch_id"],
    "quarantine_event": ["event_batch"],
    "duplicate_log": ["batch_id"],
    "audit_log": ["month", "batch_id"],
    "alert": ["batch_id"],
    "stream_progress": ["day"],
    "run_log": ["day"],
}

# Tables with a folder per batch whose closed days are folded (see tables/days.py): what names a batch, and the time of a row.
BATCHES = {
    "quarantine_record": (["source_id", "batch_id"], "quarantined_at"),
    "quarantine_event": (["event_batch"], "at"),
    "duplicate_log": (["batch_id"], "logged_at"),
    "audit_log": (["batch_id"], "created_at"),
    "alert": (["batch_id"], "raised_at"),
}
# Tables that are written by day at once; a fold only joins the files of a day.
DAYS = ("run_log", "stream_progress")

# Point lookups by record skip row groups with a Bloom filter sized to what a file holds.
LOOKUP_COLUMNS = {"warehouse_data": "record_id", "quarantine_record": "record_id", "audit_log": "record_id"}

# Current state of an append-only control table = the newest revision of each key.
KEYS = {"data_source": ["source_id"], "validation_rule": ["rule_id"], "schema_version": ["source_id", "version"]}


#: Stored bytes of a warehouse bucket, and of the part of a bucket that one task rewrites.
BUCKET_BYTES = 256 << 20
PART_BYTES = 32 << 20


@cache
def table_schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])


class Lake:
    """Reads and writes the tables below one root folder."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64, bucket_bytes: int = BUCKET_BYTES, part_bytes: int = PART_BYTES):
        """The warehouse table starts with ``buckets`` buckets; each fold adds as many as keep them at ``bucket_bytes`` on average.
        A bucket is rewritten by as many tasks as keep them at ``part_bytes``."""
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_bytes = bucket_bytes
        self.part_bytes = part_bytes

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def has(self, name: str) -> bool:
        return has_data(self.spark, self.path(name))

    def closed_path(self, name: str) -> str:
        return f"{self.root}/closed/{name}"

    def read(self, name: str, since: str | None = None) -> DataFrame:
        """A table, with the days that were folded.  ``since`` (``yyyy-MM-dd``) leaves out folded days before it unread."""
        live = self.live(name)
        if name not in BATCHES or not has_data(self.spark, self.closed_path(name)):
            return live
        keys, _ = BATCHES[name]
        closed = self.closed(name) if since is None else self.closed(name).filter(F.col("day") >= since)
        # a batch that was written again after its day was folded has its rows in its own folder
        kept = closed.drop("day").join(live.select(*keys).distinct(), keys, "left_anti")
        return live.unionByName(kept.select(*live.columns))

    def live(self, name: str) -> DataFrame:
        """What lies in the table's own folder."""
        if not self.has(name):
            return self.spark.createDataFrame([], SCHEMAS[name])
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name))

    def closed(self, name: str) -> DataFrame:
        """The folded days of a table, with their ``day``; months are read from the days, so they prune folders."""
        schema = SCHEMAS[name] + ", day STRING"
        if not has_data(self.spark, self.closed_path(name)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(self.closed_path(name))
        return rows.withColumn("month", F.substring("day", 1, 7)) if "month" in rows.columns else rows

    def shaped(self, df: DataFrame, name: str) -> DataFrame:
        """Columns in table order; a missing or mistyped one is an error."""
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(name)])

    def append(self, df: DataFrame, name: str) -> None:
        self._writer(df, name).mode("append").parquet(self.path(name))

    def replace_partitions(self, df: DataFrame, name: str) -> None:
        """Write whole partitions; running the same batch again replaces its own rows."""
        writer = self._writer(df, name).mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.parquet(self.path(name))

    def _writer(self, df: DataFrame, name: str):
        writer = self.shaped(df, name).write
        if name in LOOKUP_COLUMNS:
            writer = writer.option(f"parquet.bloom.filter.enabled#{LOOKUP_COLUMNS[name]}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        return writer.partitionBy(*PARTITIONS[name]) if name in PARTITIONS else writer

    def bucket_count(self) -> int:
        """Buckets of the warehouse table.  Its folds write the number down, and it only grows."""
        counts = self.read("lake_setting").filter("name = 'buckets'").agg(F.max("value")).first()[0]
        return counts or self.buckets

    def set_bucket_count(self, buckets: int) -> None:
        row = self.spark.range(0, 1, 1, 1).select(F.lit("buckets").alias("name"), F.lit(buckets).cast("bigint").alias("value"))
        self.append(row, "lake_setting")

    # -- control tables --------------------------------------------------------------
    def current(self, name: str) -> DataFrame:
        """Newest revision per key of a control table."""
        return newest(self.read(name), KEYS[name], F.col("_rev"))

    def next_id(self, name: str, column: str) -> int:
        return self.read(name).agg(F.coalesce(F.max(column), F.lit(0)) + 1).first()[0]

    def revise(self, rows: DataFrame, name: str) -> None:
        """Append a new revision of some rows."""
        self.append(rows.withColumn("_rev", F.lit(self.next_id(name, "_rev"))), name)

    def log_run(self, **fields) -> None:
        defaults = dict.fromkeys(
            ["batch_id", "source_id", "mode", "status", "total", "valid", "invalid", "duplicates", "seconds",
             "started_at", "error", "component", "attempt", "events"]
        )
        row = {**defaults, **fields}
        row["day"] = f"{row['started_at'] or datetime.now():%Y-%m-%d}"
        one = self.spark.range(0, 1, 1, 1)  # a row of literals needs no Python worker
        value = lambda v: F.create_map(*[F.lit(x) for kv in v.items() for x in kv]) if isinstance(v, dict) and v else F.lit(v or None if isinstance(v, dict) else v)
        self.append(one.select(*[value(v).alias(k) for k, v in row.items()]), "run_log")


def newest(df: DataFrame, keys: Iterable[str], order: Column) -> DataFrame:
    """The whole row with the greatest ``order`` per key, combined map-side."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns])
