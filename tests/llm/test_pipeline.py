"""The stages against plain versions of their decisions, on the smallest tables."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import plain as hit_words
from tests.llm.test_jaccard import plain as groups
from tests.llm.test_lines import plain as runs

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    extra = [(900001, "123 !?", "en", "s", 6), (900002, None, "en", "s", 0), (900003, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    out = [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER))
        out.append(docs.toPandas())
    return out


def rows(frame):
    return list(zip(frame["doc_id"].tolist(), frame["text"].tolist()))


def test_language_rejects_only_what_has_no_letters(steps):
    assert set(steps[0]["doc_id"]) - set(steps[1]["doc_id"]) == {900001, 900002, 900003}
    assert list(steps[1].columns) == list(steps[0].columns)


def test_line_dedup(steps):
    before = {k: r for k, r in enumerate(sorted(rows(steps[1])))}
    want = {before[k][0]: t for k, (t, n) in runs(before, 50).items() if not n or t.split()}
    assert dict(rows(steps[2])) == want
    assert (steps[2]["n_chars"] == steps[2]["text"].str.len()).all()


def test_one_of_each_group(steps):
    assert set(steps[3]["doc_id"]) == {i for i, _, c in groups(rows(steps[2])) if i == c}


def test_decontamination(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    assert set(steps[4]["doc_id"]) == {i for i, t in rows(steps[3]) if hit_words([(i, t)], items)[0][1] == 0}


def test_tokens(steps):
    true = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = dict(rows(steps[4]))
    assert len(steps[5]) == len(texts)
    for r in steps[5].itertuples():
        assert np.frombuffer(r.ids, "<u4").tolist() == true.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids) // 4 and r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_is_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", F.sha2("ids", 256)).collect()
    assert len(got) == len(steps[5]) and {r["doc_id"] for r in got} == set(steps[5]["doc_id"])


def test_empty_documents(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
