import json
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.operators.validate import validate
from tidegate.operators import schema as S
from tidegate.plans.route import Settings, observed_copy
from tidegate.rules import Rule
from tidegate.sources import files, streams
from tidegate.streaming.job import StreamJob, active_streams, stop_stream, stream_dedup
from tidegate.streaming.progress import ProgressLog, lag_of, progress_frame, totals
from tidegate.tables.warehouse import Warehouse

RULES = [
    Rule("id", "required_field", "transaction_id"),
    Rule("type", "type_check", "amount", {"expected_type": "float"}),
    Rule("range", "range", "amount", {"min": 0.01, "max": 1000000}),
]
SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("transaction_id", "amount", "note")])


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def run(job, spark, folder, schema=SCHEMA, **kw):
    job.start(streams.file_stream(spark, str(folder), "src", schema, **kw), available_now=True)
    job.query.awaitTermination()
    assert job.query.exception() is None


@pytest.fixture
def job(lake, tmp_path):
    return StreamJob(lake, RULES, "src", str(tmp_path / "ckpt"), settings=Settings(id_columns=("transaction_id",)), retry_delay=0.01, alerts=True)


def test_read_dispatch(spark, tmp_path):
    put(tmp_path / "c", "a.csv", "a;b", "1;x", "2;y")
    assert files.read(spark, str(tmp_path / "c"), "CSV", delimiter=";").dtypes == [("a", "int"), ("b", "string")]
    assert files.read(spark, str(tmp_path / "c"), "csv", delimiter=";", infer_schema=False).count() == 2
    with pytest.raises(ValueError):
        files.read(spark, "x", "xml")
    put(tmp_path / "j", "a.json", {"a": 1}, {"a": 2})
    assert files.read(spark, str(tmp_path / "j"), "json", T.StructType.fromDDL("a STRING")).first().a == "1"
    spark.range(3).write.parquet(str(tmp_path / "p"))
    assert files.read(spark, str(tmp_path / "p"), "parquet", T.StructType.fromDDL("id BIGINT")).count() == 3


def test_csv_keeps_broken_lines(spark, tmp_path):
    put(tmp_path / "c", "a.csv", "a,b", "1,x", "2", "3,y,z")
    df = files.read(spark, str(tmp_path / "c"), "csv", infer_schema=False)
    v = validate(df, []).select("a", "_v.status", "_corrupt_record")
    assert {(r.a, r.status, r._corrupt_record) for r in v.collect()} == {("1", "valid", None), ("2", "invalid", "2"), ("3", "invalid", "3,y,z")}
    assert validate(df, []).filter("_v.status <> 'valid'").select("a").count() == 2  # also when other columns are pruned


def test_json_array_elements(spark, tmp_path):
    put(tmp_path / "j", "a.json", '[{"id": 1, "amount": 99999999.99, "m": {"k": "v"}}, "loose text", {"other": 5}]')
    put(tmp_path / "j", "b.json", "{not json")
    schema = T.StructType.fromDDL("id STRING, amount STRING, m STRUCT<k: STRING>")
    rows = files.read_json_elements(spark, str(tmp_path / "j"), files.with_corrupt_column(schema)).collect()
    assert {(r.id, r.amount, r._corrupt_record) for r in rows} == {("1", "99999999.99", None), (None, None, '"loose text"'), (None, None, None), (None, None, "{not json\n")}


def test_kafka_options():
    info = {"kafka_bootstrap_servers": "h:9092", "kafka_topic": "a,b"}
    o = streams.kafka_options("s", info)
    assert (o["subscribe"], o["startingOffsets"], o["kafka.group.id"], o["failOnDataLoss"]) == ("a,b", "latest", "s_consumer", "true")
    assert streams.kafka_options("s", {**info, "starting_offsets": '{"a":{"0":5}}'})["startingOffsets"].startswith("{")
    for bad in ({}, {"kafka_topic": "a"}, {"kafka_bootstrap_servers": "h"}, {**info, "starting_offsets": "yesterday"}):
        with pytest.raises(ValueError):
            streams.kafka_options("s", bad)


def test_kafka_values(spark):
    raw = spark.createDataFrame([(b'{"id": 1, "topic": "inner"}', "outer", 5), (b"junk", "outer", 6)], "value binary, topic string, offset long")
    rows = streams.parse_kafka_values(raw, T.StructType.fromDDL("id BIGINT, topic STRING")).collect()
    assert (rows[0].id, rows[0].topic, rows[0].kafka_topic, rows[0].offset) == (1, "inner", "outer", 5)
    assert rows[1]._corrupt_record == "junk"
    assert streams.parse_kafka_values(raw).columns == ["topic", "offset", "value_str"]


def test_stream_arguments(spark, tmp_path):
    for path, kind, schema in ((str(tmp_path), "xml", SCHEMA), (str(tmp_path / "no"), "json", SCHEMA), (str(tmp_path), "json", None)):
        with pytest.raises(ValueError):
            streams.check_file_stream(spark, path, kind, schema)


def test_stream_end_to_end(spark, lake, job, tmp_path):
    src = tmp_path / "in"
    put(src, "1.json", {"transaction_id": "T1", "amount": 10}, {"transaction_id": "T2", "amount": "20.5"}, {"transaction_id": "", "amount": 5}, {"transaction_id": "T4", "amount": -50})
    put(src, "2.json", '{"transaction_id": "T5", "amount"', "plain text", {"transaction_id": "T6", "amount": "abc"})
    run(job, spark, src)
    got = {r.record_id for r in Warehouse(lake).current().collect()}
    assert got == {"T1", "T2"}
    reasons = sorted(r.failed_rules[0] for r in lake.read("quarantine_record").collect())
    assert reasons == ["id", "malformed_record", "malformed_record", "range", "type"]
    assert [(r.rule_name, r.record_id) for r in lake.read("alert").collect()] == [("range", "T4")]
    # once more on the same checkpoint: nothing new
    before = (lake.read("quarantine_record").count(), lake.read("audit_log").count(), lake.read("run_log").count())
    run(job, spark, src)
    assert before == (lake.read("quarantine_record").count(), lake.read("audit_log").count(), lake.read("run_log").count())
    # new files, an update of T1, a column nobody knew
    put(src, "3.json", {"transaction_id": "T1", "amount": 11, "surprise": True}, {"transaction_id": "T7", "amount": 1})
    run(job, spark, src)
    data = {r.record_id: r.data for r in Warehouse(lake).current().collect()}
    assert set(data) == {"T1", "T2", "T7"} and '"amount":11' in data["T1"]
    Warehouse(lake).compact()
    assert {r.record_id for r in Warehouse(lake).base().collect()} == {"T1", "T2", "T7"}
    status = job.status()
    assert status["status"] == "stopped" and status["source_id"] == "src"


def test_replayed_batch_leaves_one_copy(spark, lake, job):
    batch = spark.createDataFrame([("T1", "1", None), ("T2", "x", None)], SCHEMA)
    job.process(batch, 0)
    job.process(batch, 0)
    assert lake.read("quarantine_record").count() == 1 and Warehouse(lake).log().count() == 1


def test_failures_are_retried_then_raised(spark, lake, job, monkeypatch):
    batch = spark.createDataFrame([("T1", "1", None)], SCHEMA)
    real, calls = StreamJob._write, []

    def flaky(self, lake_, b, e):
        calls.append(e)
        if len(calls) < 3:
            raise OSError("sink away")
        return real(self, lake_, b, e)

    monkeypatch.setattr(StreamJob, "_write", flaky)
    job.process(batch, 7)
    runs = lake.read("run_log").orderBy("attempt").collect()
    assert [(r.status, r.attempt) for r in runs] == [("failure", 1), ("failure", 2), ("success", 3)]
    calls.clear()
    job.max_failures = 2
    with pytest.raises(OSError):
        job.process(batch, 8)


def test_start_stop_status(spark, job, tmp_path):
    src = tmp_path / "in"
    put(src, "1.json", {"transaction_id": "T1", "amount": 1})
    assert job.query is None and job.status()["status"] == "not_started"
    log = ProgressLog(job.lake)
    with log:
        job.start(streams.file_stream(spark, str(src), "src", SCHEMA), processing_time="1 second", name="live")
        with pytest.raises(RuntimeError):
            job.start(streams.file_stream(spark, str(src), "src", SCHEMA))
        job.query.processAllAvailable()
        assert any(q["name"] == "live" for q in active_streams(spark))
        assert progress_frame(spark, job.query).agg(F.sum("input_rows")).first()[0] == 1
        assert job.status()["last"]["batch_id"] >= 0
        assert stop_stream(spark, "live") and not stop_stream(spark, "nobody")
        log.flush()
        seen = totals(job.lake.read("stream_progress")).first()
        assert (seen.query_name, seen.input_rows, seen.lag) == ("live", 1, None) and seen.batches >= 1


def test_lag_from_offsets():
    kafka = {"latestOffset": {"t": {"0": 15, "1": 7}}, "endOffset": {"t": {"0": 10, "1": 7}}}
    files = {"latestOffset": None, "endOffset": {"logOffset": 3}}
    assert lag_of([kafka, files]) == 5 and lag_of([files]) is None and lag_of([]) is None
    assert lag_of([{"latestOffset": "12", "endOffset": "{\"a\": 9}"}]) == 3
    assert lag_of([{"latestOffset": "None", "endOffset": "x"}]) is None


def test_progress_beyond_what_the_query_holds(spark, lake, tmp_path):
    for k in range(120):
        put(tmp_path / "in", f"{k}.json", {"transaction_id": f"T{k}"})
    stream = streams.file_stream(spark, str(tmp_path / "in"), "src", SCHEMA, max_files_per_trigger=1)
    with ProgressLog(lake, every=7):
        q = stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "k")).trigger(availableNow=True).start()
        q.awaitTermination()
    seen = totals(lake.read("stream_progress")).first()
    assert (seen.batches, seen.input_rows) == (120, 120) and len(q.recentProgress) <= 100


def test_raw_batch_is_read_once(spark, tmp_path):
    put(tmp_path / "in", "1.json", {"a": 1}, "{broken", {"a": 2, "b": {"c": "x"}})
    reads = spark.sparkContext.accumulator(0)
    raw = spark.read.text(str(tmp_path / "in"))
    counted = raw.mapInPandas(lambda parts: (reads.add(len(p)) or p for p in parts), raw.schema)
    with observed_copy(counted, shape=S.shape_of(F.col("value")), n=F.count(F.lit(1))) as (copy, seen):
        assert S.schema_of_shape(seen["shape"]).simpleString() == "struct<a:bigint,b:struct<c:string>>"
        assert copy.count() == seen["n"] == 3 and copy.filter("value LIKE '%broken'").count() == 1
    assert reads.value == 3


def test_uniqueness_is_refused_on_streams(spark, tmp_path):
    put(tmp_path / "in", "1.json", {"transaction_id": "T1"})
    stream = streams.file_stream(spark, str(tmp_path / "in"), "src", SCHEMA)
    with pytest.raises(ValueError, match="'?u'?"):
        validate(stream, [Rule("u", "custom", "transaction_id", {"unique": True})])


def test_csv_and_parquet_streams(spark, lake, tmp_path):
    put(tmp_path / "c", "a.csv", "transaction_id,amount,note", "T1,5,x", "T2,bad,y", "T3")
    csv = StreamJob(lake, RULES, "csvsrc", str(tmp_path / "k1"), settings=Settings(id_columns=("transaction_id",)))
    run(csv, spark, tmp_path / "c", file_format="csv")
    assert sorted(r.failed_rules[0] for r in lake.read("quarantine_record").collect()) == ["malformed_record", "type"]
    spark.createDataFrame([("P1", "5", None)], SCHEMA).write.parquet(str(tmp_path / "p"))
    parquet = StreamJob(lake, RULES, "parquetsrc", str(tmp_path / "k2"), settings=Settings(id_columns=("transaction_id",)))
    run(parquet, spark, tmp_path / "p", file_format="parquet")
    assert {r.record_id for r in Warehouse(lake).current().collect()} == {"T1", "P1"}


def test_schema_drift_in_a_stream(spark, lake, tmp_path):
    from tidegate.tables.control import SchemaRegistry

    registry = SchemaRegistry(lake)
    registry.create("src", T.StructType.fromDDL("transaction_id STRING, amount DOUBLE"), inferred=False)
    src = tmp_path / "in"
    job = StreamJob(lake, RULES, "src", str(tmp_path / "k"), settings=Settings(id_columns=("transaction_id",)), raw_column="value")

    def drain(job):
        job.start(streams.text_stream(spark, str(src), "src"), available_now=True)
        job.query.awaitTermination()

    put(src, "1.json", {"transaction_id": "T1", "amount": 5})
    drain(job)
    assert registry.active("src").version == 1
    put(src, "2.json", {"transaction_id": "T2", "amount": 5.5, "new_field": "x"}, "{broken")
    drain(job)
    assert registry.get("src").names == ["transaction_id", "amount", "new_field"]
    assert lake.read("run_log").filter("status = 'schema_change'").first().error == "compatible: new_field"
    assert {r.record_id for r in Warehouse(lake).current().collect()} == {"T1", "T2"}
    # the next start reads the new column
    put(src, "3.json", {"transaction_id": "T3", "amount": 1, "new_field": "y"})
    drain(StreamJob(lake, RULES, "src", str(tmp_path / "k"), settings=Settings(id_columns=("transaction_id",)), raw_column="value"))
    data = {r.record_id: r.data for r in Warehouse(lake).current().collect()}
    assert '"new_field":"y"' in data["T3"] and '"new_field":"x"' in data["T2"]


def test_csv_files_with_differing_headers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a b%20[1].csv").write_text('id,"na,me"\n1,x\n2,y\n')
    (folder / "b.csv").write_text("na,me\n")  # other names, though the characters are like those of the first
    (folder / "c.csv").write_text('\n\nid,"na,me"\r\n3,z\r\n')
    (folder / "d.csv").write_text("extra,id\nq,4\nr,5,6\n")
    (folder / "empty.csv").write_text("")
    got = files.read(spark, str(folder), "csv", infer_schema=False, mixed_headers=True)
    assert set(got.columns) == {"id", "na,me", "na", "me", "extra", "_corrupt_record"} and got.columns[-1] == "_corrupt_record"
    rows = sorted((r["id"], r["na,me"], r["extra"], r["_corrupt_record"]) for r in got.collect())
    assert rows == [("1", "x", None, None), ("2", "y", None, None), ("3", "z", None, None), ("4", None, "q", None), ("5", None, "r", "r,5,6")]
    assert [len(g) for g in files.files_by_header(spark, str(folder))] in ([2, 1, 1], [1, 2, 1])
    with pytest.raises(ValueError, match="no schema"):
        files.read(spark, str(folder), "csv", mixed_headers=True)
    bare = tmp_path / "bare"
    bare.mkdir()
    (bare / "x.csv").write_text("")
    with pytest.raises(ValueError, match="No file with a header"):
        files.read(spark, str(bare), "csv", infer_schema=False, mixed_headers=True)


def test_stream_dedup_state(spark, tmp_path):
    """One row per key, over batches; rows without a key pass and leave no state."""
    src, out = tmp_path / "src", tmp_path / "out"
    rows = [(k, None if k % 5 == 0 else f"k{k % 3}", 2**60 + k if k % 2 else None) for k in range(60)]
    df = spark.createDataFrame(rows, "id int, Key string, big long").withColumn("ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")))
    df.repartition(3, "id").write.parquet(str(src))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    q = stream_dedup(stream, "key", "ts", "1 hour").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(str(out))
    q.awaitTermination()
    got = spark.read.parquet(str(out)).collect()
    assert sorted(r["Key"] for r in got if r["Key"]) == ["k0", "k1", "k2"] and sum(r["Key"] is None for r in got) == 12
    assert all(r["big"] == (2**60 + r["id"] if r["id"] % 2 else None) for r in got)
    assert max(op.numRowsTotal for p in q.recentProgress for op in p.stateOperators) == 3
