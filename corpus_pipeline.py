"""A corpus pipeline from the operators of ``tidegate.llm``: language, lines, near copies, benchmarks, tokens.

Repeated rows and null ids are as in the operators.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontaminate, jaccard, language, lines
from tidegate.llm.common import SPACES, hex_sha256, same, sized, stored
from tidegate.llm.queries import BPE_FILE, PIECE_FILE, remainder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Texts whose language is less probable than this are rejected.
LEAST_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter go, and those for which no learned language reaches ``LEAST_SCORE`` against the others:
    ties and a few very short texts.  A text in a language that was not learned mostly gets a learned one and stays.
    Learns as ``op7_language_id`` does."""
    model = language.fit(docs.filter(remainder("doc_id") != 2), language.read_pieces(public_tokenizers.path(PIECE_FILE)))
    found = model.predict(docs, lang="_lang", score="_score")
    return found.filter((F.col("_lang") != language.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)).drop("_lang", "_score")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut from the texts; documents that lose all their words go."""
    found = lines.dedup_lines(docs)
    empty = (F.col("n_deleted") > 0) & (F.trim(F.translate("kept_text", SPACES, " " * len(SPACES))) == "")
    changed = F.col("n_deleted") > 0
    found = found.filter(~empty)
    found = found.withColumns({"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))})
    return found.select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by shingles the one with the smallest id stays.  An id names one document: rows that
    share the id of a document that stays, stay; so do groups that have no id at all."""
    found = stored(jaccard.jaccard_components(docs))
    first = same(F.col("id"), F.col("component_id"))
    stay = found.filter(first).select(F.col("id").alias("stay"))
    gone = found.filter(~first).select("id").distinct()
    gone = sized(gone.join(stay, same(F.col("id"), F.col("stay")), "left_anti"))
    return docs.join(gone, same(F.col("doc_id"), F.col("id")), "left_anti")


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a test item go."""
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter("n_hit = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, packed, and the digest of the text that they decode to."""
    path = public_tokenizers.path(BPE_FILE)
    both = bpe.round_trip(docs.select("doc_id", "lang", "source", "text"), path)
    n = (F.octet_length("ids") / 4).cast("long").alias("n_tokens")
    return both.select("doc_id", "lang", "source", n, "ids", hex_sha256(F.col("decoded")).alias("decoded_sha256"))


STAGES: list[tuple[str, Stage]] = [
    ("language", known_language),
    ("line dedup", without_repeated_lines),
    ("near copies", one_of_each_group),
    ("decontamination", without_benchmarks),
    ("tokens", tokens),
]

#: Language models and token ids are beyond SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
