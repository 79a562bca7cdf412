"""Edge placement and a report on its balance.

The reference places PageRank edges by a 2-D grid, by source, by a hash of
both ends, or by ``int(src) mod 20``. Here the part number is a plain
column (``functions.columns.placement_part``), so a placement is a
``repartition`` on it and its balance is a grouped aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.functions.columns import placement_part


def place(edges: DataFrame, strategy: str, n: int) -> DataFrame:
    """Edges with a ``part`` column, hash partitioned on it into ``n`` parts."""
    e = edges.select("src", "dst")
    if strategy == "mod":
        e = e.distinct()
    return e.withColumn("part", placement_part(strategy, n)).repartition(n, "part")


def placement_report(edges: DataFrame, strategy: str, n: int) -> DataFrame:
    """``part, n_edges, n_vertices`` (distinct ids among the part's edges)."""
    e = edges.select("src", "dst")
    if strategy == "mod":
        e = e.distinct()
    ends = e.withColumn("part", placement_part(strategy, n)).select(
        "part", F.posexplode(F.array("src", "dst")).alias("pos", "v")
    )
    return ends.groupBy("part").agg(
        F.count_if(F.col("pos") == 0).alias("n_edges"),
        F.count_distinct("v").alias("n_vertices"),
    )


def placement_summary(edges: DataFrame, strategy: str, n: int) -> DataFrame:
    """One row: ``n_parts, n_edges, max_edges, replication, edge_skew``.

    replication = Σ vertices per part / distinct vertices (how many parts a
    vertex is copied to, on average); edge_skew = largest part / mean part
    over the ``n`` parts.
    """
    per_part = placement_report(edges, strategy, n).select(
        "n_edges", "n_vertices", F.lit(None).cast("bigint").alias("n_v")
    )
    e = edges.select("src", "dst")
    if strategy == "mod":
        e = e.distinct()
    n_v = e.select(F.explode(F.array("src", "dst")).alias("v")).agg(
        F.lit(None).cast("bigint").alias("n_edges"),
        F.lit(None).cast("bigint").alias("n_vertices"),
        F.count_distinct("v").alias("n_v"),
    )
    # One part row per part plus one row with the distinct vertex count,
    # folded by a single global aggregate (no join).
    totals = per_part.unionByName(n_v).agg(
        F.count("n_edges").alias("n_parts"),
        F.sum("n_edges").alias("n_edges"),
        F.max("n_edges").alias("max_edges"),
        F.sum("n_vertices").alias("sum_vertices"),
        F.max("n_v").alias("n_v"),
    )
    return totals.select(
        "n_parts",
        "n_edges",
        "max_edges",
        F.round(F.col("sum_vertices") / F.col("n_v"), 9).alias("replication"),
        F.round(F.col("max_edges") * F.lit(n) / F.col("n_edges"), 9).alias("edge_skew"),
    )
