import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidegate.llm import bpe, common, jaccard, language, lines

KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
PIECES = ["a", "b"]
OPERATORS = {
    "op2": lambda df: bpe.round_trip(df, public_tokenizers.path("byte_bpe_50k.json")),
    "op5": lines.dedup_lines,
    "op7": lambda df: language.fit(df, PIECES),
    "op7 prediction": lambda df: language.LanguageModel(["a"], ["x"], __import__("numpy").full((1, 2), 0.5)).predict(df),
    "op9": jaccard.jaccard_components,
}


@pytest.fixture
def unset(spark):
    spark.conf.unset(KEY)
    yield
    spark.conf.unset(KEY)


def batches(spark):
    """Rows and bytes of what a Python worker gets at once of 20 MB in one partition."""

    def run(found):
        for b in found:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "size": [b.nbytes]}, pa.schema([("n", pa.int64()), ("size", pa.int64())]))

    wide = spark.range(0, 5000, 1, 1).select(F.repeat(F.lit("x"), 4000).alias("text"))
    return [tuple(r) for r in wide.mapInArrow(run, "n long, size long").collect()]


@pytest.mark.parametrize("name", OPERATORS)
def test_workers_get_a_few_megabytes_at_once(spark, docs, unset, name):
    OPERATORS[name](docs([(1, "a b", "a")], ", lang string"))
    got = batches(spark)
    assert sum(n for n, _ in got) == 5000 and max(size for _, size in got) < 5 << 20


def test_the_users_limit_stays(spark, unset):
    spark.conf.set(KEY, "16m")
    common.small_batches(spark)
    assert spark.conf.get(KEY) == "16m" and len(batches(spark)) == 2
