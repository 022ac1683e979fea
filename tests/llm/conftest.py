import pytest


@pytest.fixture
def docs(spark):
    """A table of (doc_id, text) rows from a list."""
    return lambda rows, extra="": spark.createDataFrame(rows, "doc_id long, text string" + extra)
