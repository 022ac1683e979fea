import datetime
from collections import Counter

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidegate.operators import lineage
from tidegate.plans.reprocess import mark, view
from tidegate.plans.retention import expire_audit, expire_quarantine
from tidegate.session import folder_files, folders_of, path_exists
from tidegate.tables import days
from tidegate.tables.days import fold, fold_closed_days, fold_on_new_day, recover
from tidegate.tables.lake import Lake

FIRST, SECOND, LAST = (datetime.datetime(2025, 1, d, 10) for d in (1, 2, 9))


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path), buckets=2)


def alerts(lake, batch, *rows):
    made = lake.spark.createDataFrame([(r, "s", "rule", "m", at, batch) for r, at in rows], "record_id string, source_id string, rule_name string, message string, raised_at timestamp, batch_id string")
    lake.replace_partitions(made, "alert")


def stored(lake):
    return Counter((r.batch_id, r.record_id, r.raised_at) for r in lake.read("alert").collect())


@pytest.fixture
def filled(lake):
    alerts(lake, "b1", ("a", FIRST), ("b", SECOND), ("a", FIRST))
    alerts(lake, "b2", ("a", FIRST))
    alerts(lake, "b3", ("c", LAST), ("d", FIRST))  # not over, as it has a row of the last day
    alerts(lake, "b4", ("e", None), ("f", FIRST))  # nobody knows the day of e
    return lake


def test_fold_keeps_rows_and_joins_files(spark, filled):
    before = stored(filled)
    assert fold(filled, "alert", "2025-01-09") == ["2025-01-01", "2025-01-02"]
    assert stored(filled) == before
    assert folders_of(spark, filled.path("alert")) == ["batch_id=b3", "batch_id=b4"]
    closed = filled.closed_path("alert")
    assert folders_of(spark, closed) == ["day=2025-01-01", "day=2025-01-02"]
    assert all(folder_files(spark, f"{closed}/{d}") == 1 for d in folders_of(spark, closed))
    assert fold(filled, "alert", "2025-01-09") == [] and stored(filled) == before
    assert filled.read("alert", since="2025-01-02").filter("batch_id = 'b1'").count() == 1


def test_a_repeated_batch_replaces_its_folded_rows(spark, filled):
    fold(filled, "alert", "2025-01-09")
    alerts(filled, "b1", ("z", LAST))
    expected = stored(filled)
    assert [k[1] for k in expected if k[0] == "b1"] == ["z"] and expected["b2", "a", FIRST] == 1
    # folded again: its first days lose its rows, and the one that held nothing else is gone
    assert fold(filled, "alert", "2025-01-10") == ["2025-01-01", "2025-01-02", "2025-01-09"]
    assert stored(filled) == expected
    assert folders_of(spark, filled.closed_path("alert")) == ["day=2025-01-01", "day=2025-01-09"]


@pytest.mark.parametrize("broken", ["recover", "_batch_folders", "move_path"])
def test_a_broken_fold_is_finished(spark, filled, monkeypatch, broken):
    before = stored(filled)

    def stop(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if broken == "recover":
            m.setattr(days, "_commit", stop)  # all staged, but not decided
        else:
            m.setattr(days, broken, stop)
        with pytest.raises(RuntimeError):
            fold(filled, "alert", "2025-01-09")
    assert stored(filled) == before
    recover(filled, "alert")
    fold(filled, "alert", "2025-01-09")
    assert stored(filled) == before and folders_of(spark, filled.path("alert")) == ["batch_id=b3", "batch_id=b4"]
    assert not path_exists(spark, f"{filled.root}/closed/_fold_alert")


def test_a_fold_neither_sorts_nor_gathers_the_batches(spark, filled, monkeypatch):
    plans, real = {}, DataFrameWriter.parquet

    def parquet(self, path, *args, **kw):
        plans[path.rpartition("/")[2]] = self._df._jdf.queryExecution().executedPlan().toString()
        real(self, path, *args, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    assert fold(filled, "alert", "2025-01-09") == ["2025-01-01", "2025-01-02"]
    for what in ("rows", "log"):  # batches are hot keys: no row is shuffled or sorted by its batch, and no task reads them all
        assert "BroadcastHashJoin" in plans[what] and "SortMergeJoin" not in plans[what] and "Coalesce" not in plans[what]


@pytest.mark.parametrize("name", ["folded_days", "folded_day_rows", "quarantine_expired_days"])
def test_no_task_sorts_a_split_by_batch(spark, tmp_path, monkeypatch, name):
    from tidegate.catalog import QUERIES

    # all orders in one split: its rows are to be written by several tasks
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    files, real = [], Lake.replace_partitions

    def replaced(self, df, table, **kw):
        real(self, df, table, **kw)
        # a task writes one file of a batch, and names its files by its own number
        names = spark.read.parquet(self.path(table)).select(F.input_file_name().alias("f")).distinct().collect()
        files.append({r.f.rpartition("/part-")[2][:5] for r in names})

    monkeypatch.setattr(Lake, "replace_partitions", replaced)
    QUERIES[name](spark, str(tmp_path))
    assert files and len(files[0]) > 1


def test_run_log_days_are_joined(spark, lake):
    for k in range(3):
        lake.log_run(batch_id=f"r{k}", source_id="s", mode="batch", status="success", started_at=FIRST, total=k)
    lake.log_run(batch_id="r9", source_id="s", mode="batch", status="success", total=9)
    assert fold_closed_days(lake) == {"run_log": ["2025-01-01"]} and fold_closed_days(lake) == {}
    assert folder_files(spark, lake.path("run_log") + "/day=2025-01-01") == 1
    assert sorted((r.batch_id, r.total) for r in lake.read("run_log").collect()) == [("r0", 0), ("r1", 1), ("r2", 2), ("r9", 9)]
    fold_on_new_day(lake)
    lake.log_run(batch_id="r3", source_id="s", mode="batch", status="success", started_at=FIRST)
    fold_on_new_day(lake)  # once a day
    assert folder_files(spark, lake.path("run_log") + "/day=2025-01-01") == 2


def test_empty_tables(lake):
    assert fold_closed_days(lake) == {} and expire_quarantine(lake, LAST) == 0 and expire_audit(lake, LAST) == []


def test_audit_months_of_folded_days(spark, lake):
    ev = spark.createDataFrame([("r1", FIRST), ("r2", datetime.datetime(2025, 2, 3)), ("r2", datetime.datetime(2025, 2, 3))], "record_id string, at timestamp")
    rows = lineage.write_events(ev, 1, record_id=F.col("record_id"), source_id=F.lit("s"), created_at=F.col("at"))
    lake.replace_partitions(lineage.stored_form(rows, "b"), "audit_log")
    assert fold(lake, "audit_log", "2025-03-01") == ["2025-01-01", "2025-02-03"]
    february = lineage.in_months(lake.read("audit_log"), "2025-02", "2025-02")
    assert [r.record_id for r in february.collect()] == ["r2", "r2"]
    scan = february._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in scan
    assert expire_audit(lake, datetime.datetime(2026, 2, 15)) == ["2025-01"]
    assert {(r.record_id, r.month) for r in lake.read("audit_log").collect()} == {("r2", "2025-02")}


def test_quarantine_days_expire_with_their_marks(spark, lake):
    from tidegate.operators import quarantine

    for batch, at in (("b1", FIRST), ("b2", SECOND), ("b3", LAST)):
        made = quarantine.rows_from_records(spark, [{"raw_data": batch, "record_id": batch}], "a b", batch).withColumn("quarantined_at", F.lit(at))
        lake.replace_partitions(made, "quarantine_record")
    assert mark(lake, "reviewed", view(lake).filter("batch_id <> 'b2'")) == 2
    fold_closed_days(lake, datetime.datetime(2025, 1, 9, 12))
    assert {(r.batch_id, r.reviewed) for r in view(lake).collect()} == {("b1", True), ("b2", False), ("b3", True)}
    assert expire_quarantine(lake, datetime.datetime(2025, 1, 12, 12), days=10) == 1
    assert {(r.batch_id, r.reviewed) for r in view(lake).collect()} == {("b2", False), ("b3", True)}
    assert expire_quarantine(lake, datetime.datetime(2025, 1, 12, 12), days=10) == 0
