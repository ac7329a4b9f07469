"""Connected components of a graph whose edges are a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapstats.llm.common import discard, stored

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node reaches; nodes without an edge are absent.

    `edges` has bigint columns a and b. Every round links the larger neighbours of a node to its smallest
    neighbour, then the smaller ones, until only stars are left: a logarithmic number of rounds, each one aggregation
    (summed before the shuffle) and one equi join on the node. The smallest neighbours are stored before the join, so that it
    meets two plain shuffles and Spark can split the partition of a node with very many neighbours. They also tell when it is
    done: every node is the smallest of its neighbourhood or has one neighbour. Rounds are written to the shared folder; the
    files of a round go when the next one is stored.
    """
    now = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    for _ in range(MAX_ROUNDS):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most")), "least")
        if least.where("m < a and m < most").isEmpty():
            discard(now)
            return least.select(F.col("a").alias("node"), F.least("a", "m").alias("root"))
        large = (both.where("b > a").join(least.select("a", F.least("a", "m").alias("m")), "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        large = stored(large, "edges")
        smallest = stored(large.groupBy("a").agg(F.min("b").alias("m"), F.max("b").alias("most")), "least")
        if smallest.where("m < most").isEmpty():
            # One smaller neighbour each: the second half of the round would change nothing.
            discard(now, least, smallest)
            now = large
            continue
        small = (large.join(smallest, "a").select(F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e"))
                 .select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct())
        small = stored(small, "edges")
        discard(now, least, large, smallest)
        now = small
    raise RuntimeError("components did not settle")
