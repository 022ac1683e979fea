"""Data-quality checking, routing and record keeping on Spark DataFrames and streams."""
