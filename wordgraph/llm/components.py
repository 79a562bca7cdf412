"""Connected components by large-star and small-star steps.

Every step hooks nodes to the least node they know; the number of steps grows
with the logarithm of the number of nodes on a path. Edges are written to the
shared folder after each pair of steps, so a lost executor costs one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.session import TableCuts


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _least(pairs: DataFrame) -> DataFrame:
    """``u, m``: the least of a node and its neighbours."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame, cuts: TableCuts, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (columns ``u, v``, long): the least node it reaches.

    Self links count for nothing; an empty table gives an empty one.
    """
    now = cuts.cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), f"{name}-0")
    before, turn = None, 0
    while True:
        turn += 1
        # Large star: the larger neighbours of a node are hooked to the least node it knows.
        pairs = _both_ways(now)
        large = pairs.where("v > u").join(_least(pairs), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours are hooked to the least of them.
        least = _least(large)
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = cuts.cut(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{turn}")
        state = nxt.agg(F.count(F.lit(1)).alias("n"), F.sum("v").alias("s"),
                        F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        cuts.drop(f"{cuts.root}/{name}-{turn - 1}")
        now = nxt
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
