"""Connected components, label = smallest vertex id (A16, A17 on top).

Large-star and small-star steps: in each round every vertex and its neighbours
are hooked to the least vertex they know, so the number of rounds grows with
the logarithm of the path length, whatever the order of the ids.

On the word-overlap graph the edges are stars: each word's bags are linked
with its least bag, so their number is linear in the postings and no pair of
bags is ever formed.

Skew: minima are partial aggregates (one row per map task and key reaches the
shuffle). A component ends as a star, so its root, and a hot word, has very many
rows: keys of more than a thousandth of the rows are few, their minima are
broadcast to the rows, and only the rows of the other keys are dealt by key and
sorted. Edges are written below ``spark.checkpoint.dir`` each round; the loop
ends when a round changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.session import TableCuts


# A key of fewer rows is no hub, and at most so many keys are.
HUB_ROWS, MOST_HUBS = 10_000, 1_000
# Rows that a task of a join sorts, about.
TASK_ROWS = 1_000_000


def _hub_rows(rows: int) -> int:
    """Rows from which a key of a table of ``rows`` rows is a hub."""
    return max(HUB_ROWS, -(-rows // MOST_HUBS))


def _least(pairs: DataFrame) -> DataFrame:
    """``u, m, d``: the least of a vertex and its neighbours, and their number."""
    return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("d")).select(
        "u", F.least("u", "m").alias("m"), "d")


def _with_least(rows: DataFrame, least: DataFrame, hub_rows: int, count: int) -> DataFrame:
    """``u, v, m`` for ``rows(u, v)`` and ``least(u, m, d)``; the rows of keys with d > ``hub_rows`` stay where they are.

    Both are written tables, as they are read twice if there are hubs. ``d`` is at least the number of the key's
    ``rows``, of which there are ``count`` or fewer; parts grow in number with them, not in size.
    """
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // TASK_ROWS))
    hubs = least.where(F.col("d") > hub_rows).select("u", F.col("m").alias("hub_m"))
    if hubs.isEmpty():
        return rows.select("u", "v").repartition(parts, "u").join(least.select("u", "m"), "u")
    marked = rows.select("u", "v").join(F.broadcast(hubs), "u", "left")
    others = marked.where(F.col("hub_m").isNull()).select("u", "v").repartition(parts, "u").join(
        least.where(F.col("d") <= hub_rows).select("u", "m"), "u")
    return others.union(marked.where(F.col("hub_m").isNotNull()).select("u", "v", F.col("hub_m").alias("m")))


def contract(edges: DataFrame, cuts: TableCuts, max_rounds: int | None = None,
             hub_rows: int | None = None) -> tuple[DataFrame, int]:
    """Stars ``u, v`` (v the least vertex that u reaches, u > v) of ``edges(u, v)``, and the rounds taken.

    ``hub_rows``: a vertex of more neighbours is a hub; without it at most ``MOST_HUBS`` are.
    """
    now = cuts.cut(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                   .distinct(), "edges-0")
    before, rounds, count = None, 0, now.count()
    while max_rounds is None or rounds < max_rounds:
        rounds += 1
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hub = _hub_rows(2 * count) if hub_rows is None else hub_rows
        least = cuts.cut(_least(both), f"least-{rounds}")
        large = cuts.cut(_with_least(both.where("v > u"), least, hub, count).select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), f"large-{rounds}")
        least = cuts.cut(_least(large), f"least-large-{rounds}")
        small = _with_least(large, least, hub, count).where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = cuts.cut(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"edges-{rounds}")
        cuts.drop_all_but_last()
        # Equal edges twice in a row: count and two digests of all of them.
        state = tuple(now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                              F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())
        if state == before:
            break
        before, count = state, state[0]
    return now, rounds


def _labels(vertices: DataFrame, stars: DataFrame) -> DataFrame:
    found = stars.select(F.col("u").alias("v"), F.col("v").alias("l"))
    return vertices.select("v").distinct().join(found, "v", "left").select("v", F.coalesce("l", "v").alias("component"))


def components_from_postings(vertices: DataFrame, postings: DataFrame, max_rounds: int | None = None,
                             hub_rows: int | None = None) -> DataFrame:
    """``v, component`` of the overlap graph, computed on ``postings(v, w)``.

    Bags without words (or only with words of their own) are components of
    their own. The postings are written once below the checkpoint folder, so
    the work that made them (e.g. tokenising) is done once.
    """
    cuts = TableCuts(vertices.sparkSession, "components")
    post = cuts.cut(postings.select(F.col("w").alias("u"), "v"), "postings")
    lead = cuts.cut(post.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("d")), "leads")
    count = post.count()
    hub = _hub_rows(count) if hub_rows is None else hub_rows
    linked = _with_least(post, lead, hub, count).select(F.col("v").alias("u"), F.col("m").alias("v"))
    stars, _ = contract(linked, cuts, max_rounds, hub_rows)
    return _labels(vertices, stars)


def components_from_edges(vertices: DataFrame, edges: DataFrame, max_rounds: int | None = None,
                          hub_rows: int | None = None) -> DataFrame:
    """``v, component`` of a general graph; edges are taken in both directions."""
    cuts = TableCuts(vertices.sparkSession, "components")
    stars, _ = contract(edges.select(F.col("src").alias("u"), F.col("dst").alias("v")), cuts, max_rounds,
                        hub_rows)
    return _labels(vertices.select("v").union(edges.select("src")).union(edges.select("dst")), stars)


def component_sizes(labels: DataFrame) -> DataFrame:
    """``component, n_vertices``."""
    return labels.groupBy("component").agg(F.count(F.lit(1)).alias("n_vertices"))


def largest_component(labels: DataFrame) -> DataFrame:
    """The component with most vertices; ties to the smallest label."""
    return component_sizes(labels).orderBy(F.desc("n_vertices"), F.asc("component")).limit(1)
