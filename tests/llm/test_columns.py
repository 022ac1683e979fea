"""Extra columns: names that an operator uses itself, or gives to its results, in both cases."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidegate.llm import bpe, decontaminate, language, licenses, lines, quality, secrets, suffixes
from tidegate.llm.queries import BPE_FILE

#: Names of columns inside the operators, past and present.
INNER = """row found kinds hit_id hit_h runs spans cut n k a b h id t key full _row _both _found _cut _hit_id _hits _run_row s_id s_h run_row
hits known_digest known_as line one hit opening found_spans items_ x at""".split()


def bpe_round_trip(df):
    return bpe.round_trip(df, public_tokenizers.path(BPE_FILE))


def predicted(df):
    return language.LanguageModel(["a"], ["x"], __import__("numpy").full((1, 2), 0.5)).predict(df)


OPERATORS = {
    "op2": (bpe_round_trip, ["ids", "decoded"]),
    "op3": (secrets.scan, ["spans"]),
    "op4": (lambda df: decontaminate.decontaminate(df, df.sparkSession.createDataFrame([(1, "a b c")], "item_id long, text string")), ["n_words", "n_hit", "hit_spans", "items"]),
    "op5": (lines.dedup_lines, ["n_lines", "n_deleted", "deleted_runs", "kept_text"]),
    "op6": (quality.quality, ["n_words", "kept", "clean_text"]),
    "op7": (predicted, ["lang_pred", "score"]),
    "op8": (suffixes.dedup_bytes, ["n_bytes", "n_removed", "removed_spans", "kept"]),
    "op10": (lambda df: licenses.scan(df, df.sparkSession.createDataFrame([("L", "a b c")], "license string, text string")), ["digest", "licenses", "notices"]),
}


@pytest.mark.parametrize("name", OPERATORS)
@pytest.mark.parametrize("case", [str.lower, str.upper])
def test_extra_columns_stay(docs, name, case):
    run, results = OPERATORS[name]
    inner = [case(c) for c in INNER if c not in results]
    df = docs([(1, "A b, c"), (1, "A b, c"), (None, None)]).withColumns({c: F.lit(c) for c in inner} | {case(c): F.lit("old") for c in results})
    found = run(df)
    assert sorted(c.lower() for c in found.columns).count(results[0]) == 1 and set(results) <= set(found.columns)
    rows = found.collect()
    assert len(rows) == 3 and all(r[c] == c for r in rows for c in inner)
    assert all(r[c] != "old" for r in rows for c in results)
