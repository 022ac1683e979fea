"""Run catalog queries beside their SQL twins: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v)) if v % 1 else str(int(v))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return str(v)


def kind(name: str) -> str:
    name = name.lower()
    for k in ("timestamp", "decimal", "array"):
        if name.startswith(k):
            return k
    return {"varchar": "string", "integer": "int"}.get(name, name)


def compare(spark_df, con, sql) -> str:
    cols = sorted(spark_df.columns)
    types = dict(spark_df.dtypes)
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    if sorted(theirs) != cols:
        return f"columns {cols} vs {sorted(theirs)}"
    note = "".join(f" [{c}: {types[c]} vs {theirs[c]}]" for c in cols if kind(types[c]) != kind(theirs[c]))
    mine = sorted((tuple(plain(r[c]) for c in cols) for r in spark_df.collect()), key=repr)
    order = [rel.columns.index(c) for c in cols]
    other = sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    if len(mine) != len(other):
        return f"rows {len(mine)} vs {len(other)}{note}"
    for a, b in zip(mine, other):
        if a != b:
            return f"values {cols}: {a} vs {b}{note}"
    return f"ok {len(mine)}{note}"


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    folder = f"/root/testdata/sf{sf}"
    import __spark_entry__ as entry

    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sys.argv[2:] or queries:
        start = time.time()
        try:
            df = queries[name](spark, folder)
            result = compare(df, con, oracle[name]) if name in oracle else f"rows-only {len(df.collect())}"
        except Exception as e:
            result = "ERROR " + str(e)[:600]
        failed = not result.startswith(("ok", "rows-only")) or "[" in result[:40]
        bad += failed
        print(f"{'FAIL' if failed else 'pass'} {name}: {result} ({time.time() - start:.1f}s)", flush=True)
    print(f"{bad} failures; {len(set(queries) - set(oracle))} without SQL")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
