"""Q1-Q6: the questions the reference answers on the word-overlap graph.

Each takes DataFrames and returns a DataFrame with named columns. Top-1
answers use ``orderBy(...).limit(1)`` with a full order ending in the id,
which Spark runs as a distributed top-k (``TakeOrderedAndProject``): each
task keeps one row, nothing is collected. One-row answers that are joined
back are broadcast: their size is bounded by the ``limit``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.functions.columns import truncated_div
from wordgraph.operators.components import largest_component as _largest
from wordgraph.operators.overlap import bag_sizes


def _sized_edges(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Edges with the sizes of both ends: carried already (``overlap_graph``) or joined."""
    if {"ns", "nd"} <= set(edges.columns):
        return edges.select("src", "dst", "ns", "nd")
    ns = sizes.select(F.col("v").alias("src"), F.col("n").alias("ns"))
    nd = sizes.select(F.col("v").alias("dst"), F.col("n").alias("nd"))
    return edges.select("src", "dst").join(ns, "src").join(nd, "dst")


def larger_source_edges(edges: DataFrame, sizes: DataFrame, directed: bool = True) -> DataFrame:
    """Q1 (P5, A10): ``n_edges`` = directed edges whose source has strictly more words.

    With ``directed=False`` the edges hold each pair once (either order): of
    the two directions of a pair exactly one counts when the sizes differ,
    so the answer is the number of pairs with different sizes — the same
    number from half the rows.
    """
    sized = _sized_edges(edges, sizes)
    cond = (F.col("ns") > F.col("nd")) if directed else (F.col("ns") != F.col("nd"))
    return sized.where(cond).agg(F.count(F.lit(1)).alias("n_edges"))


def most_popular_vertex(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Q2 (A11, A12, P6, J6, T1): ``v, out_degree, n_words``.

    Largest out-degree, then most words, then smallest id; no row when the
    graph has no edge.
    """
    if "ns" in edges.columns:
        # Sizes travel with the edges: one aggregation, no join.
        ranked = edges.groupBy(F.col("src").alias("v")).agg(
            F.count(F.lit(1)).alias("out_degree"), F.max("ns").alias("n_words")
        )
    else:
        deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out_degree")).withColumnRenamed("src", "v")
        ranked = deg.join(sizes.select("v", F.col("n").alias("n_words")), "v")
    return ranked.orderBy(F.desc("out_degree"), F.desc("n_words"), F.asc("v")).limit(1)


def neighbor_average(edges: DataFrame, sizes: DataFrame) -> DataFrame:
    """Q3 (A9, A19, J8, P7): ``v, avg_words, avg_words_exact``.

    avg_words is the reference's integer average (truncated, as float);
    avg_words_exact the true mean. Vertices without a neighbour have no row.
    """
    s = _sized_edges(edges, sizes).groupBy("src").agg(
        F.sum("nd").alias("total"), F.count(F.lit(1)).alias("k")
    )
    return s.select(
        F.col("src").alias("v"),
        truncated_div("total", "k").alias("avg_words"),
        (F.col("total") / F.col("k")).alias("avg_words_exact"),
    )


def most_popular_bag(totals: DataFrame) -> DataFrame:
    """Q2 from ``overlap.neighbor_totals``, without the pairs."""
    return totals.select("v", F.col("k").alias("out_degree"), F.col("n").alias("n_words")).orderBy(
        F.desc("out_degree"), F.desc("n_words"), F.asc("v")).limit(1)


def tied_vertices(degrees: DataFrame) -> DataFrame:
    """All of ``degrees(v, out_degree, n_words)`` at the largest out-degree, with their number ``n_tied``.

    The largest degree and how many have it are one row of a partial aggregate, the vertices a filter by it;
    no ties are brought to one place.
    """
    top = degrees.groupBy("out_degree").agg(F.count(F.lit(1)).alias("n_tied")).orderBy(F.desc("out_degree")).limit(1)
    return degrees.join(F.broadcast(top), "out_degree").select("v", "out_degree", "n_words", "n_tied")


def neighbor_average_of(totals: DataFrame) -> DataFrame:
    """Q3 from ``overlap.neighbor_totals``, without the pairs."""
    return totals.select("v", truncated_div("total", "k").alias("avg_words"),
                         (F.col("total") / F.col("k")).alias("avg_words_exact"))


def word_totals(counts: DataFrame) -> DataFrame:
    """``w, c`` = occurrences of each word over all bags (stays distributed)."""
    return counts.groupBy("w").agg(F.sum("c").alias("c"))


def most_popular_word(counts: DataFrame, by: str = "count") -> DataFrame:
    """Q4: ``w, c``.

    by='count' (A15, what the reference means): most occurrences, ties to the
    smallest word. by='word' (A14, what its code does): the largest word in
    the engine's order, with its count.
    """
    t = word_totals(counts)
    if by == "count":
        return t.orderBy(F.desc("c"), F.asc("w")).limit(1)
    if by == "word":
        return t.orderBy(F.desc("w")).limit(1)
    raise ValueError("by must be 'count' or 'word'")


def word_presence(counts: DataFrame, by: str = "count") -> DataFrame:
    """Q6 (P8, A18): ``w, c, n_vertices`` — Q4's word and the number of bags holding it."""
    # ``counts`` is unique on (v, w), so one aggregate gives the word's total and its number of bags.
    t = counts.groupBy("w").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("n_vertices"))
    if by == "count":
        return t.orderBy(F.desc("c"), F.asc("w")).limit(1)
    if by == "word":
        return t.orderBy(F.desc("w")).limit(1)
    raise ValueError("by must be 'count' or 'word'")


def largest_component(labels: DataFrame) -> DataFrame:
    """Q5: ``component, n_vertices``."""
    return _largest(labels)


__all__ = [
    "bag_sizes",
    "larger_source_edges",
    "most_popular_vertex",
    "neighbor_average",
    "most_popular_bag",
    "tied_vertices",
    "neighbor_average_of",
    "word_totals",
    "most_popular_word",
    "word_presence",
    "largest_component",
]
