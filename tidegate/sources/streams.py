"""Streaming sources: watched folders and Kafka topics."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.validate import CORRUPT
from tidegate.session import path_exists
from tidegate.sources.files import FORMATS, parsed_columns, tag_source, with_corrupt_column


def file_stream(
    spark: SparkSession,
    path: str,
    source_id: str,
    schema: T.StructType,
    file_format: str = "json",
    max_files_per_trigger: int = 10,
    latest_first: bool = False,
    **options: Any,
) -> DataFrame:
    """New files of a folder as they arrive; lines that do not parse stay in ``_corrupt_record``."""
    check_file_stream(spark, path, file_format, schema)
    kind = file_format.lower()
    settings = {"maxFilesPerTrigger": max_files_per_trigger, "latestFirst": str(latest_first).lower(), **options}
    if kind in ("csv", "json"):
        settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **settings}
        schema = with_corrupt_column(schema)
    if kind == "csv":
        settings = {"header": True, "columnPruning": False, **settings}
    return tag_source(spark.readStream.format(kind).schema(schema).options(**settings).load(path), source_id)


def text_stream(spark: SparkSession, path: str, source_id: str, max_files_per_trigger: int = 10) -> DataFrame:
    """New files of a folder as raw lines in ``value``: parsing and drift checks come per batch."""
    if not path_exists(spark, path):
        raise ValueError(f"No such folder: {path}")
    return tag_source(spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger).text(path), source_id)


def check_file_stream(spark: SparkSession, path: str, file_format: str, schema: T.StructType | None) -> None:
    if file_format.lower() not in FORMATS:
        raise ValueError(f"Unsupported stream format '{file_format}': one of {', '.join(FORMATS)}")
    if schema is None:
        raise ValueError("a file stream needs a schema: stored, given, or taken from a batch read of existing files")
    if not path_exists(spark, path):
        raise ValueError(f"No such folder: {path}")


def schema_from_existing(spark: SparkSession, path: str, file_format: str = "json") -> T.StructType:
    """A one-off batch look at the files already there."""
    return spark.read.format(file_format).load(path).schema


def text_schema(schema: T.StructType) -> T.StructType:
    """The same columns read as text, so a value of the wrong type is kept for the record."""
    simple = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
    return T.StructType([f if isinstance(f.dataType, simple) else T.StructField(f.name, T.StringType(), True) for f in schema])


# Offset words a Kafka reader may start from.
_OFFSET_WORDS = ("earliest", "latest")


def kafka_options(source_id: str, connection_info: dict[str, str], max_offsets_per_trigger: int | None = 10000) -> dict[str, str]:
    """Reader options for a registered Kafka source, checked."""
    servers, topic = connection_info.get("kafka_bootstrap_servers"), connection_info.get("kafka_topic")
    if not servers:
        raise ValueError("connection_info needs kafka_bootstrap_servers")
    if not topic:
        raise ValueError("connection_info needs kafka_topic")
    offsets = connection_info.get("starting_offsets", "latest")
    if offsets not in _OFFSET_WORDS and not offsets.startswith("{"):
        raise ValueError(f"starting_offsets must be earliest, latest or a JSON offset spec, got {offsets!r}")
    out = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": offsets,
        "kafka.group.id": connection_info.get("kafka_group_id", f"{source_id}_consumer"),
        # lost offsets stop the stream unless the source is registered as one that may lose some
        "failOnDataLoss": str(connection_info.get("fail_on_data_loss", "true")).lower(),
    }
    if max_offsets_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return out


def kafka_stream(
    spark: SparkSession, source_id: str, connection_info: dict[str, str], value_schema: T.StructType | None = None,
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """A topic as parsed rows, all that has come since the last trigger unless a rate is given; needs Spark's
    Kafka connector on the class path."""
    options = kafka_options(source_id, connection_info, max_offsets_per_trigger)
    raw = spark.readStream.format("kafka").options(**options).load()
    return tag_source(parse_kafka_values(raw, value_schema), source_id)


def parse_kafka_values(raw: DataFrame, value_schema: T.StructType | None = None) -> DataFrame:
    """Message values as columns, beside key, topic, partition, offset and timestamp.

    Works on any frame with a binary or text ``value``.  A value that is no JSON object is kept
    in ``_corrupt_record``.
    """
    text = F.col("value").cast("string")
    rest = [c for c in raw.columns if c != "value"]
    if value_schema is None:
        return raw.select(*rest, text.alias("value_str"))
    clash = set(value_schema.names)
    parse, columns = parsed_columns(text, with_corrupt_column(value_schema))
    meta = [F.col(c).alias(f"kafka_{c}") if c in clash else F.col(c) for c in rest]
    named = [c if c not in clash else f"kafka_{c}" for c in rest]
    return raw.select(*meta, parse.alias("_p")).select(*named, *[c.alias(n) for n, c in columns.items()])
