import datetime

import pytest
from pyspark.sql import functions as F

from tidegate.functions.payload import checksum, record_id, valid_identifier
from tidegate.operators import dedup, lineage, quarantine
from tidegate.plans import reprocess as R
from tidegate.plans.batch import load
from tidegate.plans.retention import expire_audit, expire_quarantine
from tidegate.plans.route import Settings
from tidegate.rules import Rule
from tidegate.session import folder_bytes, folder_files, path_exists
from tidegate.tables.control import RuleTable, SchemaRegistry, SourceRegistry
from tidegate.tables.lake import Lake
from tidegate.tables.warehouse import Warehouse, _power, bucket_of, jdbc_merge_sql, merge_rows, split_from, warehouse_rows

RULES = [
    Rule("transaction_id_required", "required_field", "transaction_id"),
    Rule("transaction_id_format", "regex", "transaction_id", {"pattern": "^TXN[0-9]{4}$"}),
    Rule("amount_required", "required_field", "amount"),
    Rule("amount_type", "type_check", "amount", {"expected_type": "float"}),
    Rule("amount_range", "range", "amount", {"min": 0.01, "max": 1000}),
    Rule("email_format", "regex", "email", {"pattern": "^[^@]+@[^@]+$"}, "warning"),
]
# id, amount, time, email -> good rows, each kind of bad row, a duplicate, a row without id
LINES = """transaction_id,amount,timestamp,email
TXN0001,10.50,2025-01-01T10:00:00Z,a@x.org
TXN0002,20,2025-01-01T10:01:00Z,not an email
BAD,30,2025-01-01T10:02:00Z,a@x.org
TXN0004,,2025-01-01T10:03:00Z,a@x.org
TXN0005,abc,2025-01-01T10:04:00Z,a@x.org
TXN0006,-1,2025-01-01T10:05:00Z,a@x.org
TXN0001,11.50,2025-01-01T10:06:00Z,a@x.org
,40,2025-01-01T10:07:00Z,a@x.org
,41,2025-01-01T10:08:00Z,a@x.org
TXN0010,   ,2025-01-01T10:09:00Z,
"""
SETTINGS = Settings(latest_by=("timestamp",))


@pytest.fixture
def feed(tmp_path):
    f = tmp_path / "feed.csv"
    f.write_text(LINES)
    return str(f)


def contents(lake):
    rows = Warehouse(lake).current().select("record_id", "source_id", "data", "checksum").collect()
    return sorted(tuple(r) for r in rows)


def test_load(spark, lake, feed):
    r = load(lake, RULES, "pay", feed, settings=SETTINGS, schema_fraction=1.0)
    assert (r["total_records"], r["valid_records"], r["invalid_records"], r["duplicate_records"]) == (10, 2, 7, 1)
    assert r["schema_id"] == 1 and 0 < r["schema_confidence"] <= 1
    rows = contents(lake)
    assert [x[0] for x in rows] == ["TXN0001", "TXN0002"] and '"amount":11.5' in rows[0][2]
    failed = {tuple(x.failed_rules) for x in lake.read("quarantine_record").collect()}
    assert failed == {("transaction_id_format",), ("amount_required",), ("amount_type",), ("amount_range",), ("transaction_id_required",), ("amount_required", "amount_type")}
    raw = lake.read("quarantine_record").filter("record_id = 'TXN0005'").first().raw_payload
    assert '"amount":"abc"' in raw
    kinds = {x.transformation_type: x.events for x in lineage.summary(lake.read("audit_log")).collect()}
    assert kinds == {"type_coercion": 2, "warehouse_write": 2, "quarantine": 7, "deduplication": 1, "ALL": 12}
    run = lake.read("run_log").first()
    assert (run.status, run.total, run.valid, run.invalid, run.duplicates) == ("success", 10, 2, 7, 1)


def test_load_again_changes_nothing(lake, feed):
    load(lake, RULES, "pay", feed, settings=SETTINGS, schema_fraction=1.0, batch_id="b1")
    first = contents(lake)
    load(lake, RULES, "pay", feed, settings=SETTINGS, batch_id="b1")
    assert contents(lake) == first
    assert lake.read("quarantine_record").count() == 7  # the batch replaced its own rows
    assert lake.read("audit_log").count() == 12


def test_dry_run_writes_nothing(spark, lake, feed):
    r = load(lake, RULES, "pay", feed, dry_run=True, settings=SETTINGS)
    assert (r["total_records"], r["valid_records"], r["duplicate_records"]) == (10, 2, 1)
    assert r["validation_failures_by_rule"][0] == {"rule_name": "amount_required", "failure_count": 2}
    assert not path_exists(spark, lake.root)


def test_load_without_rules_or_dedup(lake, feed):
    r = load(lake, [], "pay", feed, settings=Settings(deduplicate=False), schema_fraction=1.0)
    # two rows have no id; two valid rows share one, and the warehouse holds an id once
    assert (r["total_records"], r["valid_records"], r["invalid_records"], r["duplicate_records"]) == (10, 7, 2, 1)
    assert len(contents(lake)) == 7


def test_empty_and_headless_files(lake, tmp_path):
    empty, bare = tmp_path / "e.csv", tmp_path / "b.csv"
    empty.write_text("transaction_id,amount\n")
    bare.write_text("T1,5\nT2,6\n")
    r = load(lake, RULES, "empty", str(empty), settings=SETTINGS)
    assert (r["total_records"], r["valid_records"], r["invalid_records"]) == (0, 0, 0)
    r = load(lake, [], "bare", str(bare), header=False, settings=Settings(id_columns=("_c0",)), schema_fraction=1.0)
    assert r["valid_records"] == 2 and [x[2] for x in contents(lake)] == ['{"_c0":"T1","_c1":"5"}', '{"_c0":"T2","_c1":"6"}']


def test_load_failure_is_logged(lake, feed):
    bad = [Rule("p", "custom", "amount", {"expression": "raise_error('no') IS NULL"})]
    with pytest.raises(Exception):
        load(lake, bad, "pay", feed, settings=SETTINGS, schema_fraction=1.0)
    assert lake.read("run_log").first().status == "failure"


def test_schema_of_a_second_file(spark, lake, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("transaction_id,amount\nT1,5\n")
    b.write_text("transaction_id,amount,note\nT2,6,hello\n")
    load(lake, [], "s", str(a), schema_fraction=1.0)
    r = load(lake, [], "s", str(b))
    assert r["schema_id"] == 2 and r["schema_changes"] == ["Added field: note (StringType())"]
    assert SchemaRegistry(lake).get("s").names == ["transaction_id", "amount", "note"]
    r = load(lake, [], "s", str(b), evolve=False)
    assert r["schema_id"] == 2


def test_given_schema_types_columns(spark, lake, tmp_path):
    from pyspark.sql import types as T

    f = tmp_path / "a.csv"
    f.write_text("transaction_id,n\nT1,5\nT2,x\n")
    schema = T.StructType.fromDDL("transaction_id STRING, n BIGINT")
    load(lake, [], "s", str(f), schema=schema)
    assert [x[2] for x in contents(lake)] == ['{"transaction_id":"T1","n":5}', '{"transaction_id":"T2","n":null}']


# -- warehouse ------------------------------------------------------------------------


def rows(spark, values, source="a"):
    df = spark.createDataFrame(values, "record_id string, v int")
    return warehouse_rows(df.select(F.col("record_id").alias("_q_id"), "v"), source, 1, record_id=F.col("_q_id"))


def test_upsert_keeps_first_source(spark, lake):
    w = Warehouse(lake)
    assert w.upsert(rows(spark, [("k1", 1), ("k2", 2)], "a"), "b1") == 2
    assert w.upsert(rows(spark, [("k2", 20), ("k3", 3)], "b"), "b2") == 2
    got = {r.record_id: (r.source_id, r.data) for r in w.current().collect()}
    assert got == {"k1": ("a", '{"v":1}'), "k2": ("a", '{"v":20}'), "k3": ("b", '{"v":3}')}
    merged = merge_rows(rows(spark, [("k1", 1), ("k2", 2)], "a"), rows(spark, [("k2", 20), ("k3", 3)], "b"))
    assert {r.record_id: (r.source_id, r.data) for r in merged.collect()} == got


def test_log_and_base_read_alike(spark, lake):
    w = Warehouse(lake)
    for i, batch in enumerate([[("a", 1), ("b", 1)], [("b", 2)], [("a", 3), ("c", 3)]]):
        w.append(rows(spark, batch), f"b{i}", i)
    before = contents(lake)
    assert w.base().count() == 0
    w.compact()
    assert contents(lake) == before and w.log().count() == 0 and len(before) == 3
    assert w.compact() == 0


def test_interrupted_fold_is_finished(spark, lake, monkeypatch):
    w = Warehouse(lake)
    w.upsert(rows(spark, [(f"k{i}", i) for i in range(20)]), "b0", 0)
    w.append(rows(spark, [(f"k{i}", i * 10) for i in range(20)]), "b1", 1)
    expected = contents(lake)
    real = Lake.replace_partitions

    def dies(self, df, name):
        if name == "warehouse_data":
            from tidegate.session import delete_path

            delete_path(self.spark, self.path("warehouse_data"))  # what a crash may leave behind
            raise RuntimeError("driver lost")
        real(self, df, name)

    monkeypatch.setattr(Lake, "replace_partitions", dies)
    with pytest.raises(RuntimeError):
        w.compact()
    monkeypatch.setattr(Lake, "replace_partitions", real)
    w.compact()
    assert contents(lake) == expected


def test_bucket_count_is_fixed_by_the_first_fold(spark, lake):
    Warehouse(lake).upsert(rows(spark, [(f"k{i}", i) for i in range(50)]), "b0", 0, fold=True)
    other = Lake(spark, lake.root, buckets=7)
    Warehouse(other).upsert(rows(spark, [(f"k{i}", i + 1) for i in range(50)]), "b1", 1, fold=True)
    assert Warehouse(other).current().count() == 50 and other.bucket_count() == 4


def test_large_buckets_are_rewritten_in_parts(spark, lake):
    lake.buckets, lake.part_bytes = 2, 2000
    w = Warehouse(lake)
    w.upsert(rows(spark, [(f"k{i}", i) for i in range(2000)], "a"), "b0", 0, fold=True)
    w.upsert(rows(spark, [(f"k{i}", -i) for i in range(1000, 3000)], "b"), "b1", 1, fold=True)
    for bucket in range(2):
        assert folder_files(spark, f"{lake.path('warehouse_data')}/bucket={bucket}") > 3
    assert w.base().filter(bucket_of(F.col("record_id"), 2) != F.col("bucket")).count() == 0
    got = [(r.record_id, r.source_id, r.data) for r in w.current().collect()]
    expected = {(f"k{i}", "a" if i < 2000 else "b", f'{{"v":{i if i < 1000 else -i}}}') for i in range(3000)}
    assert len(got) == 3000 and set(got) == expected


def test_split_addresses():
    for before in range(1, 40):
        for after in range(before, 70):
            for h in range(200):
                place = lambda n: h % _power(n) if h % _power(n) < n else h % _power(n) - _power(n) // 2
                assert split_from(place(after), before) == place(before)


def test_buckets_split_as_the_table_grows(spark, lake, monkeypatch):
    lake.buckets, lake.bucket_bytes = 1, 1 << 30
    w = Warehouse(lake)
    w.upsert(rows(spark, [(f"k{i}", i) for i in range(300)]), "b0", 0, fold=True)
    assert {r.bucket for r in w.base().select("bucket").collect()} == {0}
    lake.bucket_bytes = folder_bytes(spark, lake.path("warehouse_data")) // 5
    real = Warehouse.recover
    monkeypatch.setattr(Warehouse, "recover", lambda self: False)  # dies between staging and replacing
    with pytest.raises(RuntimeError):
        w.upsert(rows(spark, [("k1", -1)], "b"), "b1", 1, fold=True)
    monkeypatch.setattr(Warehouse, "recover", real)
    assert Warehouse(lake).current().count() == 300 and lake.bucket_count() == 1
    w.upsert(rows(spark, [("one", 1)]), "b2", 2, fold=True)
    n = lake.bucket_count()
    assert n > 4 and w.base().count() == 301 == w.current().count()
    assert w.base().filter(bucket_of(F.col("record_id"), n) != F.col("bucket")).count() == 0
    # a bucket that loses its only row does not keep it
    few = Lake(spark, lake.root + "2", buckets=1)
    Warehouse(few).upsert(rows(spark, [("x", 1)]), "b0", 0, fold=True)
    few.bucket_bytes = 100
    Warehouse(few).upsert(rows(spark, [("y", 1)]), "b1", 1, fold=True)
    assert Warehouse(few).base().count() == 2 and few.bucket_count() > 10


def test_small_batches_do_not_rewrite_a_large_table(spark, lake):
    w = Warehouse(lake)
    w.upsert(rows(spark, [(f"k{i}", i) for i in range(3000)]), "b0", 0, fold=True)
    assert w.base().count() == 3000 and w.log().count() == 0
    w.upsert(rows(spark, [("k1", -1)]), "b1", 1)
    assert w.log().count() == 1 and w.current().filter("record_id = 'k1'").first().data == '{"v":-1}'
    w.upsert(rows(spark, [("k2", -2)]), "b2", 2, fold=True)
    assert w.log().count() == 0 and w.base().count() == 3000


def test_rows_without_id_are_refused(spark, lake):
    with pytest.raises(Exception, match="no record_id"):
        Warehouse(lake).append(rows(spark, [(None, 1)]), "b0")


def test_batch_ids_are_checked(spark, lake):
    with pytest.raises(ValueError):
        Warehouse(lake).append(rows(spark, [("a", 1)]), "a/b")


def test_fold_shuffles_wide_rows_once(spark, lake):
    """The fold of one batch moves rows once, by bucket."""
    w = Warehouse(lake)
    w.upsert(rows(spark, [("a", 1)]), "b0", 0, fold=True)
    seen = []
    real = Lake.shaped

    def spy(self, df, name):
        if name == "warehouse_data":
            seen.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, df, name)

    Lake.shaped = spy
    try:
        w.upsert(rows(spark, [("b", 1)]), "b1", 1, fold=True)
    finally:
        Lake.shaped = real
    assert seen[0].count("Exchange") == 1


def test_jdbc_statements():
    assert "ON CONFLICT (record_id) DO UPDATE" in jdbc_merge_sql("stage", "target")
    assert jdbc_merge_sql("stage", "target", "derby").startswith("MERGE INTO target")


# -- payloads and duplicates ------------------------------------------------------------


def test_checksum_ignores_column_order(spark):
    a = spark.createDataFrame([(1, None, ("x", 2))], "b int, a string, n struct<q:string,p:int>")
    b = spark.createDataFrame([(None, 1, (2, "x"))], "a string, b int, n struct<p:int,q:string>")
    assert a.select(checksum(a)).first() == b.select(checksum(b)).first()


def test_ids(spark):
    df = spark.createDataFrame([("", "r"), ("t", "r"), (None, None)], "transaction_id string, record_id string")
    assert [r[0] for r in df.select(record_id(df)).collect()] == ["r", "t", None]
    ids = spark.createDataFrame([("ok-1_2.x",), (" pad ",), ("bad id",), ("",), ("x" * 256,), (None,)], "i string")
    assert [r[0] for r in ids.select(valid_identifier(F.col("i"))).collect()] == [True, True, False, False, False, False]


def test_dedup_keeps_null_keys_and_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", 2), (None, 1), (None, 1), ("b", 1)], "id string, v int")
    out = dedup.dedup_latest(df, "id", ["v"])
    assert sorted((r.id or "", r.v, r._copies) for r in out.collect()) == [("", 1, 1), ("", 1, 1), ("a", 3, 3), ("b", 1, 1)]
    assert dedup.duplicates_removed(out).first() == (6, 4, 2)
    assert dedup.dedup_any(df.drop("id")).count() == 6
    composite = spark.createDataFrame([("a", 1, 5), ("a", 1, 6), ("a", 2, 5)], "x string, y int, v int")
    assert dedup.dedup_latest(composite, ["x", "y"], ["v"]).count() == 2


def test_hot_key_is_combined_before_the_shuffle(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"), F.col("id").alias("v"))
    out = dedup.dedup_latest(df, "id", ["v"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_max_by") >= 1 and "Window" not in plan
    assert out.filter("id = 'hot'").first()._copies == 10000


# -- quarantine ---------------------------------------------------------------------------


def test_review_and_reprocess(spark, lake, feed):
    load(lake, RULES, "pay", feed, settings=SETTINGS, schema_fraction=1.0)
    v = R.view(lake)
    assert R.mark(lake, "reprocess_requested", quarantine.by_rule(v, "amount_range")) == 1
    assert quarantine.totals(R.view(lake)).first() == (7, 7, 1)
    relaxed = [r for r in RULES if r.rule_name not in ("amount_range", "transaction_id_format")]
    r = R.reprocess(lake, relaxed, "pay")
    assert (r["total_reprocessed"], r["success_count"], r["failed_count"]) == (7, 2, 5)
    assert quarantine.totals(R.view(lake)).first() == (7, 5, 0)
    assert [x[0] for x in contents(lake)] == ["BAD", "TXN0001", "TXN0002", "TXN0006"]
    assert R.reprocess(lake, relaxed, "pay")["success_count"] == 0
    only = R.reprocess(lake, relaxed, "pay", error_types=["amount_type"], limit=1)
    assert only["total_reprocessed"] == 1
    R.mark(lake, "reviewed", quarantine.select_ids(R.view(lake), ["TXN0004"], "record_id"))
    assert quarantine.totals(R.view(lake)).first()[1] == 4


def test_hand_made_quarantine_rows(spark, lake):
    made = quarantine.rows_from_records(spark, [{"raw_data": {"a": 1}}, {"raw_data": "x", "failed_rules": ["r"], "error_messages": ["m"], "record_id": 7}], "s", "b")
    lake.replace_partitions(made, "quarantine_record")
    got = {r.raw_payload: (r.record_id, r.failed_rules, r.error_messages) for r in lake.read("quarantine_record").collect()}
    assert got == {'{"a": 1}': (None, ["unknown_error"], ["Unknown validation error"]), "x": ("7", ["r"], ["m"])}


def test_argument_checks():
    assert quarantine.check_limit(10000) == 10000 and quarantine.check_offset(0) == 0 and quarantine.check_ids([1, 2]) == [1, 2]
    for bad in (0, -1, 10001, 1.5, True, "5"):
        with pytest.raises(ValueError):
            quarantine.check_limit(bad)
    for bad in ([0], [-5], ["1"], [True]):
        with pytest.raises(ValueError):
            quarantine.check_ids(bad)
    with pytest.raises(ValueError):
        quarantine.check_offset(-1)


def test_retention(spark, lake):
    now = datetime.datetime(2025, 6, 15)
    ev = spark.createDataFrame([("r", "s", datetime.datetime(2024, 5, 1)), ("r", "s", datetime.datetime(2025, 6, 1))], "record_id string, source_id string, at timestamp")
    rows_ = lineage.write_events(ev, 1, record_id=F.col("record_id"), source_id=F.col("source_id"), created_at=F.col("at"))
    lake.replace_partitions(lineage.stored_form(rows_, "b"), "audit_log")
    assert expire_audit(lake, now) == ["2024-05"] and lake.read("audit_log").count() == 1
    for batch, at in (("old", datetime.datetime(2025, 1, 1)), ("new", datetime.datetime(2025, 6, 1))):
        made = quarantine.rows_from_records(spark, [{"raw_data": "x"}], "s", batch).withColumn("quarantined_at", F.lit(at))
        lake.replace_partitions(made, "quarantine_record")
    assert expire_quarantine(lake, now) == 1 and lake.read("quarantine_record").first().batch_id == "new"


# -- control tables -----------------------------------------------------------------------


def test_sources(spark, lake):
    reg = SourceRegistry(lake)
    reg.register("files", "csv_file", {"path": "/x"})
    reg.register("off", "kafka_topic", enabled=False)
    with pytest.raises(ValueError, match="already"):
        reg.register("files", "csv_file")
    with pytest.raises(ValueError):
        reg.register("x", "ftp")
    assert [r.source_id for r in reg.enabled().collect()] == ["files"]
    assert reg.all().filter("source_id = 'files'").first().connection_info["delimiter"] == ","
    rows_ = spark.createDataFrame([("files",), ("ghost",)], "source_id string")
    assert [r.source_id for r in reg.unregistered(rows_).collect()] == ["ghost"]


def test_rule_table(lake):
    table = RuleTable(lake)
    assert table.add(RULES) == 6
    with pytest.raises(ValueError, match="in use"):
        table.add([RULES[0]])
    assert table.update(5, {"min": 0, "max": 5}) == 1 and table.disable(6) == 1 and table.disable(77) == 0
    stored = table.rules()
    assert [r.rule_name for r in stored] == [r.rule_name for r in RULES]
    assert stored[4].parameters == {"min": 0, "max": 5} and not stored[5].enabled
    with pytest.raises(ValueError):
        table.update(5, {"min": 9, "max": 5})


def test_schema_registry(spark, lake):
    from pyspark.sql import types as T

    reg = SchemaRegistry(lake)
    one, two = T.StructType.fromDDL("a INT"), T.StructType.fromDDL("a STRING")
    assert reg.get("s") is None
    with pytest.raises(ValueError):
        reg.create("s", one, confidence=1.5)
    with pytest.raises(ValueError):
        reg.get_or_infer("s")
    assert reg.create("s", one, confidence=0.9) == 1
    assert reg.evolve("s", one) == 1
    assert reg.evolve("s", two) == 2  # incompatible: version 1 is retired
    assert reg.get("s") == two and reg.get("s", 1) == one
    assert [(r.version, r.deprecated_at is None) for r in reg.history("s").collect()] == [(2, True), (1, False)]
    reg.deprecate("s", 2)
    assert reg.get("s") is None
    schema, schema_id, score = reg.get_or_infer("s", sample=spark.createDataFrame([(1,)], "x int"), fraction=1.0)
    assert (schema.names, schema_id, score) == (["x"], 3, 1.0)
    assert reg.get_or_infer("s")[1] == 3
