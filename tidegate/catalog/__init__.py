"""Named queries over the TPC-H-like tables, each with the same result as SQL where SQL can say it."""

from tidegate.catalog.common import ORACLE, QUERIES
from tidegate.catalog import audits, cleaning, closed_days, loads, registry, rejects, rulechecks, streams, warehousing  # noqa: F401  (register)

__all__ = ["ORACLE", "QUERIES"]
