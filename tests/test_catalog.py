"""A sample of the catalog beside its SQL twins, and properties of its plans."""

import os

import pytest

from tests.check_oracle import compare, connect
from tidegate.catalog import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")

# A few of every kind; tests/check_oracle.py runs them all.
SAMPLE = """validate_status_counts error_messages is_unique custom_python nested_rule failures_by_rule dedup_latest duplicate_report
checksum upsert_table load_counts load_quarantine csv_scan kafka_values quarantine_stats reprocess_counts audit_summary audit_trace
reconciliation run_size_histogram quality_trend stream_validate stream_window_counts""".split()


@pytest.mark.parametrize("name", SAMPLE)
def test_same_as_sql(spark, name):
    result = compare(QUERIES[name](spark, FOLDER), connect(FOLDER), ORACLE[name])
    assert result.startswith("ok"), result


def test_most_queries_have_a_twin():
    assert set(ORACLE) <= set(QUERIES) and len(set(QUERIES) - set(ORACLE)) <= 3


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_counts_read_only_needed_columns(spark):
    text = plan(QUERIES["validate_status_counts"](spark, FOLDER))
    assert "o_custkey" not in text and "o_orderpriority" not in text and "Python" not in text
    assert "@" not in text  # the warning rule's pattern is pruned: nothing asks for warnings


def test_no_cartesian_products(spark):
    for name in ("reconciliation", "is_unique", "change_detection", "quarantine_reviewed_view", "duplicate_values", "audit_summary"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_dirty_view_totals(spark):
    rows = {r.status: r.n for r in QUERIES["validate_status_counts"](spark, FOLDER).collect()}
    assert rows == {"valid": 1042, "invalid": 507}
