"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp): every node that occurs in a link with the smallest node it is connected to.

    Alternates two joins by node: neighbours above a node are hung on the smallest
    neighbour, then those at or below it.  Both keep the components and the number of edges does not grow;
    a chain of n nodes takes about log(n) rounds.  Edges are written each round and never collected.
    """
    edges = stored(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        # large star: each node hangs its larger neighbours on the smallest node it sees
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).withColumn("low", F.least("u", "low"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        # small star: each node hangs its smaller neighbours, and itself, on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("low"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        small = small.unionByName(low.select("u", F.col("low").alias("v"))).filter("u <> v").distinct()
        edges = stored(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(roots)
