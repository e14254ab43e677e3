"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallweave.llm.tables import drop_path, stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b); the component is the smallest node reachable.

    Alternates two steps until nothing changes: every node points its larger neighbours to its smallest one, then every
    node points its smaller neighbours and itself there.  Each step is an aggregate (summed per task before it is
    shuffled) and an equi-join, so a node with very many links is split like any skewed key; a chain of n nodes takes
    O(log n) rounds.  Rounds are written to the shared folder.
    """
    spark = edges.sparkSession
    now, path = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (state["n"], state["x"]) == before or not state["n"]:
            break
        before = (state["n"], state["x"])
        both = now.union(now.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        larger = both.where("b > a").join(least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Nodes that are the largest of all their links keep one, to their smallest neighbour.
        large = larger.where("a <> b").union(least.where("u <> m").select("u", "m"))
        small_least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(small_least, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").union(small_least.select("u", "m"))
        after, after_path = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
        drop_path(spark, path)
        now, path = after, after_path
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b")).distinct()
