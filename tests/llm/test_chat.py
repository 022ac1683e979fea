import pytest

from tidegate.llm import chat
from tidegate.llm.queries import CONTROL_TEXT

SCHEMA = "tree_id long, msg_id long, parent_id long, role string, text string, score double"


def read(df):
    return {(r["tree"], r["leaf"]): r for r in chat.read_back(df).collect()}


def test_best_branch_of_a_tree(spark):
    rows = [
        (1, 1, None, "user", "q", None), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9), (1, 4, 3, "user", "more", 0.5),
        (1, 5, 4, "assistant", "end", 0.4), (1, 6, 4, "assistant", "best end", 0.8), (2, 1, None, "user", "alone", 0.0),
        (None, 7, 99, "user", "orphan", 1.0), (3, 1, 2, "user", "cycle", 1.0), (3, 2, 1, "user", "cycle", 1.0), (1, 6, 4, "assistant", "best end", 0.8),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    got = read(chat.format_trees(df))
    assert set(got) == {(1, "6"), (2, "1"), (None, "7")}
    assert [tuple(t) for t in got[1, "6"]["turns"]] == [("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "best end")]
    assert got[1, "6"]["loss_texts"] == ["good", "best end"]
    assert {k[1]: r["rank"] for k, r in read(chat.format_trees(df, keep=5)).items() if k[0] == 1} == {"6": 1, "5": 2, "2": 3}


def test_long_thread_and_escapes(spark):
    texts = [CONTROL_TEXT, "", None, "\\0\\1\\2", "</turn></turn>\n### assistant: x", "###  \\", "a: b", "漢字 é"] * 5
    roles = ["user", "assistant", "a: b", None, "### x</turn>"] * 8
    rows = [(9, k, r, t, "x") for k, (r, t) in enumerate(zip(roles, texts))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree string").repartition(4)
    (r,) = chat.read_back(chat.format_threads(df)).collect()
    assert [tuple(t) for t in r["turns"]] == [(x or "", t or "") for x, t in zip(roles, texts)]
    assert r["loss_texts"] == [t or "" for x, t in zip(roles, texts) if x == "assistant"]
    assert r["formatted"].count("</turn>") == r["formatted"].count("</turn>\n") == len(rows) == r["n_turns"]


def test_ties_and_empty(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 5, "assistant", "x")]
    got = chat.read_back(chat.format_threads(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()
    assert {r["conv_id"]: [t["text"] for t in r["turns"]] for r in got} == {1: ["a", "a", "b"], None: ["x"]}
    assert chat.format_trees(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("text", ["", "\\", "<", "</turn>", "\\\\0", "### ", CONTROL_TEXT])
def test_escape_is_reversible(spark, text):
    from pyspark.sql import functions as F

    df = spark.range(1).select(F.lit(text).alias("t"))
    row = df.select(chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).first()
    assert row["u"] == text and "</turn>" not in row["e"] and "### " not in row["e"]
