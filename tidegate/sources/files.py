"""Batch file sources."""

from __future__ import annotations

import re
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.values import quoted
from tidegate.operators.validate import CORRUPT

# Readable formats.
FORMATS = ("csv", "json", "parquet")


def tag_source(df: DataFrame, source_id: str) -> DataFrame:
    return df.withColumn("source_id", F.lit(source_id))


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType(), True)])


def read(spark: SparkSession, path: str, file_format: str = "csv", schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """Read files of a known format; every format takes a schema and options."""
    kind = file_format.lower()
    if kind not in FORMATS:
        raise ValueError(f"Unsupported file format '{file_format}': one of {', '.join(FORMATS)}")
    if kind == "csv":
        return read_csv(spark, path, schema, **options)
    if kind == "json":
        return read_json(spark, path, schema, **options)
    reader = spark.read.options(**options)
    return (reader.schema(schema) if schema is not None else reader).parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    header: bool = True,
    delimiter: str = ",",
    infer_schema: bool = True,
    mixed_headers: bool = False,
    **options: Any,
) -> DataFrame:
    """CSV in PERMISSIVE mode.

    ``infer_schema=False`` without a schema reads every column as text and keeps lines that
    do not parse in ``_corrupt_record``; this is the form validation wants.  Files whose header
    differs from the first one's then stop the read, unless ``mixed_headers=True``: see ``read_mixed_csv``.
    """
    settings = {"header": header, "delimiter": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    if mixed_headers:
        if schema is not None or infer_schema or str(header).lower() != "true":
            raise ValueError("mixed_headers reads texts by the names in the files: it takes a header, no schema and infer_schema=False")
        return read_mixed_csv(spark, path, settings)
    reader = spark.read.options(**settings)
    if schema is not None:
        if CORRUPT in schema.names:
            # with pruned columns the parser would not notice a wrong number of fields
            reader = reader.option("columnPruning", False)
        return reader.schema(schema).csv(path)
    if infer_schema:
        return reader.option("inferSchema", True).csv(path)
    return _texts_by_header(spark, [path], settings)


def _texts_by_header(spark: SparkSession, paths: list[str], settings: dict[str, Any]) -> DataFrame:
    """All columns as text; the files share the header of the first one."""
    names = spark.read.options(**settings).csv(paths[0]).columns  # reads the first line only
    texts = with_corrupt_column(T.StructType([T.StructField(n, T.StringType(), True) for n in names]))
    # enforceSchema=false: a file whose header differs is an error, not misplaced columns
    return spark.read.options(**settings).schema(texts).options(enforceSchema=False, columnPruning=False).csv(paths)


#: Headers that one folder may have; each is a scan of its own in the plan.
MOST_HEADERS = 200


def files_by_header(spark: SparkSession, path: str, settings: dict[str, Any] | None = None) -> list[list[str]]:
    """The files of a folder that share their first line with a word, each group in the order of its names.

    One scan of the text: hashes of lines and their positions are folded into one pair per file
    before the shuffle.  The driver gets the file names, as it does for any scan.
    """
    asked = settings or {}
    known = {k: v for k, v in asked.items() if k in ("lineSep", "recursiveFileLookup", "pathGlobFilter", "modifiedAfter", "modifiedBefore", "basePath")}
    lines = spark.read.options(**known).text(path)
    comment = asked.get("comment")
    is_line = F.trim("value", F.lit(" \t\r")) != ""
    if comment:
        is_line &= ~F.col("value").startswith(comment)
    first = (
        lines.filter(is_line)
        .select(F.xxhash64(F.rtrim("value", F.lit("\r"))).alias("line"), "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at"))
        .groupBy("file_path")
        # a file's blocks may be read in any order; within one, positions rise
        .agg(F.min_by("line", F.col("at")).alias("later"), F.min_by("line", F.when(F.col("file_block_start") == 0, F.col("at"))).alias("line"))
    )
    groups = first.groupBy(F.coalesce("line", "later").alias("line")).agg(F.sort_array(F.collect_list("file_path")).alias("files"))
    return sorted(r["files"] for r in groups.limit(MOST_HEADERS + 1).collect())


def _literal_path(uri: str) -> str:
    """A file's address as a path that is not taken for a pattern."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(uri))


def read_mixed_csv(spark: SparkSession, path: str, settings: dict[str, Any]) -> DataFrame:
    """CSV files with differing headers, as text: files are grouped by their header, each group is read
    with its own names, and the groups are joined by name.  A column that a file lacks is null there.

    A header must be one line.  Empty files bring nothing; a folder with no header at all is an error,
    and so are more than ``MOST_HEADERS`` different ones.  For columns from folder names give ``basePath``.
    """
    groups = files_by_header(spark, path, settings)
    if not groups:
        raise ValueError(f"No file with a header in '{path}'")
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"More than {MOST_HEADERS} different headers in '{path}'")
    parts = [_texts_by_header(spark, [_literal_path(f) for f in files], settings) for files in groups]
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.select(*[quoted(c) for c in together.columns if c != CORRUPT], CORRUPT)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, **options: Any) -> DataFrame:
    """Line-delimited JSON; with ``multiLine=True`` each file is one document."""
    settings = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT, **options}
    reader = spark.read.options(**settings)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_json_elements(spark: SparkSession, path: str, schema: T.StructType, **options: Any) -> DataFrame:
    """JSON files that hold one array each: one row per element.

    Elements that are no objects, and files that are no JSON, become rows with their text in
    ``_corrupt_record``.  A file is one task's work, as it must be for an array without line
    structure; use line-delimited files for large inputs.
    """
    whole = spark.read.options(**options).text(path, wholetext=True)
    doc = whole.select(F.try_parse_json("value").alias("doc")).filter(F.col("doc").isNotNull())
    element = doc.select(F.explode(F.coalesce(F.try_variant_get("doc", "$", "array<variant>"), F.array("doc"))).alias("e"))
    is_object, text = F.schema_of_variant("e").startswith("OBJECT"), F.to_json("e")
    split = element.select(F.when(is_object, text).alias("text"), F.when(~is_object, text).alias(CORRUPT))
    # a second look for the files that are no JSON: carrying the text beside every element would multiply it
    broken = whole.filter(F.try_parse_json("value").isNull()).select(F.lit(None).cast("string").alias("text"), F.col("value").alias(CORRUPT))
    return parse_objects(split.unionByName(broken), "text", schema)


def exact_texts(schema: T.StructType) -> T.StructType:
    """Text fields read as variants first: a number in a text field keeps all its digits."""
    fields = [
        T.StructField(f.name, T.VariantType(), True) if type(f.dataType) is T.StringType and f.name != CORRUPT else f
        for f in schema
    ]
    return T.StructType(fields)


def parsed_columns(text: Column, schema: T.StructType) -> tuple[Column, dict[str, Column]]:
    """The parse of a JSON text, and the columns to take from it once it is named ``_p``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    loose = exact_texts(schema)
    columns = {f.name: F.col("_p").getField(f.name) for f in schema}
    for f in loose:
        if isinstance(f.dataType, T.VariantType) and not isinstance(schema[f.name].dataType, T.VariantType):
            columns[f.name] = F.try_variant_get(columns[f.name], "$", "string")
    return F.from_json(text, loose, options), columns


def parse_objects(df: DataFrame, text: str, schema: T.StructType) -> DataFrame:
    """Columns of a JSON text column, beside the other columns.

    A field that does not fit its type is null; text that is no object is kept in
    ``_corrupt_record`` if the schema has that column.
    """
    parse, columns = parsed_columns(F.col(text), schema)
    rest = [c for c in df.columns if c != text]
    keep = [c for c in rest if c not in columns]
    if CORRUPT in rest and CORRUPT in columns:
        columns[CORRUPT] = F.coalesce(quoted(CORRUPT), columns[CORRUPT])
    return df.select(parse.alias("_p"), *[quoted(c) for c in rest]).select(
        *[c.alias(n) for n, c in columns.items()], *[quoted(c) for c in keep]
    )
