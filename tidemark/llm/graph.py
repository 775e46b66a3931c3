"""Connected components of an edge table, with no group of edges in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.scratch import materialize


def components(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """Smallest node reachable from every node of the edges: node, root.

    Alternates two steps until nothing changes: each node's larger neighbours move
    to its smallest neighbour, then its smaller ones do. Minima are combined before
    the shuffle, so a node with very many edges is a join key, not a group. Edges
    with a null end, loops and repeats are left out.
    """
    spark = edges.sparkSession
    pairs = edges.select(F.greatest(first, second).alias("hi"), F.least(first, second).alias("lo")).where(
        F.col(first).isNotNull() & F.col(second).isNotNull() & (F.col(first) != F.col(second))
    )
    now = materialize(spark, pairs.distinct(), "edges")
    state = None
    while True:
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(now.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = materialize(spark, large, "edges")
        root = large.groupBy("hi").agg(F.min("lo").alias("m"))
        rest = large.join(root, "hi").where("lo != m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        now = materialize(spark, root.select("hi", F.col("m").alias("lo")).unionByName(rest).distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if seen == state:
            break
        state = seen
    # Every node but the roots is now a "hi" once.
    roots = now.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
