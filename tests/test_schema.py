import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators import clean, schema as S


def ddl(text):
    return T.StructType.fromDDL(text)


def test_confidence(spark):
    full = spark.createDataFrame([(1, 2.0, "a"), (2, 3.0, "b")], "id int, amount double, email string")
    assert S.confidence(full, 1.0) == 1.0
    poor = spark.createDataFrame([(None, None, "x"), (None, None, None)], "_c0 int, _c1 double, _c2 string")
    assert S.confidence(poor, 1.0) == round((0.5 * 3 + 0 + 0 + 0.5) / 6, 2)
    assert S.confidence(full.limit(0), 1.0) == 0.0
    assert [S.name_score(n) for n in ("_c0", "COL1", "field12", "Column3", "amount", "col")] == [0.5, 0.5, 0.5, 0.5, 1.0, 1.0]


def test_confidence_is_one_job(spark):
    df = spark.range(100).select(*[F.col("id").alias(f"c_{i}") for i in range(20)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("confidence", "one aggregate")
    S.confidence(df, 1.0)
    assert len(tracker.getJobIdsForGroup("confidence")) <= 3  # one query, cut at its shuffles
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_infer_from_csv(spark, tmp_path):
    f = tmp_path / "a.csv"
    f.write_text("id,amount\n" + "".join(f"{i},{i}.5\n" for i in range(50)))
    schema, score = S.infer_from_csv(spark, str(f), sample_size=10000)
    assert schema == ddl("id INT, amount DOUBLE") and 0.0 <= score <= 1.0


def test_typed_schema(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("n"), F.concat(F.col("id").cast("string"), F.lit(".5")).alias("f"), F.lit("2025-01-02 10:00:00").alias("t"),
        F.lit("Yes").alias("b"), F.when(F.col("id") < 60, "12").otherwise("x").alias("m"), F.lit("q").alias("s"), F.lit(None).cast("string").alias("e"))
    found = S.typed_schema(df)
    assert [f.dataType.simpleString() for f in found] == ["bigint", "double", "timestamp", "boolean", "string", "string", "string"]
    assert S.needs_review(found) == ["m"]


def test_round_trips():
    s = ddl("a BIGINT, b STRUCT<x: ARRAY<DECIMAL(5,2)>>, c MAP<STRING, DATE>")
    assert S.dict_to_schema(S.schema_to_dict(s)) == s and S.schema_from_json(s.json()) == s


def test_merge_adds_and_widens():
    old = ddl("id INT, x FLOAT NOT NULL")
    merged, changes = S.merge_schemas(old, ddl("id BIGINT, x DOUBLE, note STRING"), allow_type_changes=True)
    assert merged == ddl("id BIGINT, x DOUBLE, note STRING")
    assert changes == ["Type changed: id (IntegerType() -> LongType())", "Type changed: x (FloatType() -> DoubleType())", "Field 'x' now nullable",
                       "Added field: note (StringType())"]
    assert S.merge_schemas(old, old)[1] == []


def test_merge_refuses():
    with pytest.raises(S.SchemaEvolutionError, match="not allowed"):
        S.merge_schemas(ddl("a INT"), ddl("a BIGINT"))
    with pytest.raises(S.SchemaEvolutionError, match="Incompatible"):
        S.merge_schemas(ddl("a STRING"), ddl("a INT"), allow_type_changes=True)
    kept, changes = S.merge_schemas(ddl("a INT"), ddl("a INT NOT NULL"))
    assert kept["a"].nullable and changes == []


def test_detect_changes(spark):
    diff = S.detect_changes(ddl("a INT, b STRING, c INT"), ddl("a BIGINT, c STRING, d INT"))
    assert (diff["added_fields"], diff["removed_fields"], diff["has_breaking_changes"]) == (["d"], ["b"], True)
    assert [(t["field"], t["compatible"]) for t in diff["type_changes"]] == [("a", True), ("c", False)]
    assert not S.detect_changes(ddl("a INT NOT NULL"), ddl("a INT"))["has_breaking_changes"]
    assert S.detect_changes(ddl("a INT"), ddl("a INT NOT NULL"))["has_breaking_changes"]
    rows = S.changes_frame(spark, ddl("a INT, b STRING"), ddl("a BIGINT, c INT")).collect()
    assert {(r.change_type, r.field, r.breaking) for r in rows} == {("new_field", "c", False), ("removed_field", "b", True), ("type_change", "a", False)}


def test_stream_merge():
    merged, evolved, changes = S.merge_stream_schemas(ddl("a INT"), ddl("a BIGINT, b STRING"))
    assert evolved and len(changes) == 2 and merged.names == ["a", "b"]
    with pytest.raises(S.SchemaEvolutionError):
        S.merge_stream_schemas(ddl("a INT, b INT"), ddl("a INT"))


def test_compare_is_stricter():
    assert S.compare_schemas(ddl("a INT"), ddl("a INT, b INT"))["compatible"]
    assert not S.compare_schemas(ddl("a INT"), ddl("a INT, b INT NOT NULL"))["compatible"]
    assert not S.compare_schemas(ddl("a INT"), ddl("a BIGINT"))["compatible"]


def test_observed_schema_and_drift(spark):
    texts = spark.createDataFrame([('{"id":1,"x":2.5}',), ('{"id":2,"new":{"y":"q"}}',), ('"no object"',), ("broken{",)], "t string")
    seen = S.observed_schema(texts, "t")
    assert seen == ddl("id BIGINT, new STRUCT<y: STRING>, x DOUBLE")
    diff = S.drift(ddl("id DOUBLE, x DOUBLE, gone STRING"), seen)
    assert diff["added_fields"] == ["new"] and not diff["has_breaking_changes"]
    assert S.drift(ddl("id BOOLEAN"), seen)["has_breaking_changes"]


def test_fit_columns(spark):
    df = spark.createDataFrame([("1", "x")], "a string, extra string")
    kept, schema, notes = clean.fit_columns(df, ddl("a STRING, b INT"))
    assert kept.columns == ["a", "b", "extra"] and notes == ["Added field: extra (StringType())"]
    dropped, schema, notes = clean.fit_columns(df, ddl("a STRING, b INT"), evolve=False)
    assert dropped.columns == ["a", "b"] and schema.names == ["a", "b"] and notes == ["Dropped field: extra (StringType())"]


def test_dates_and_trimming(spark):
    df = spark.createDataFrame([("01/31/2025", "  a ")], "d string, s string").union(spark.createDataFrame([("2025-02-01", "b ")], "d string, s string"))
    out = clean.trim_fields(clean.normalize_dates(df, ["d"]), ["s"])
    assert [(r.d, r.s) for r in out.collect()] == [("2025-01-31", "a"), ("2025-02-01", "b")]
    odd = clean.normalize_dates(spark.createDataFrame([("31/31/2025",)], "d string"), ["d"])
    assert odd.first().d == "31/31/2025"
