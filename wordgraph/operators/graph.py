"""Property graph as two DataFrames, and the graph-level operators.

Vertices carry an id column ``v``; edges carry ``src`` and ``dst``. Every
operator is a plain DataFrame transformation: joins are equi joins on the
vertex id (Catalyst / AQE pick broadcast, shuffled-hash or sort-merge from
runtime sizes), aggregations run partial + final, so a hot vertex adds one
row per map task to the shuffle, never its whole group.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Graph:
    """A property graph. ``vertices(v, ...)``, ``edges(src, dst, ...)``.

    Every vertex is kept, also one without edges.
    """

    vertices: DataFrame
    edges: DataFrame


def vertices_of(edges: DataFrame) -> DataFrame:
    """Every id seen as source or target, once."""
    return edges.select(F.col("src").alias("v")).union(edges.select(F.col("dst").alias("v"))).distinct()


def out_degrees(edges: DataFrame) -> DataFrame:
    """``src, deg``; parallel edges count each, vertices without out-edges absent."""
    return edges.groupBy("src").agg(F.count(F.lit(1)).alias("deg"))


def in_degrees(edges: DataFrame) -> DataFrame:
    return edges.groupBy("dst").agg(F.count(F.lit(1)).alias("deg"))


def degrees(edges: DataFrame) -> DataFrame:
    """``v, deg`` = in + out degree; a self loop counts twice."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("v"))
    return ends.groupBy("v").agg(F.count(F.lit(1)).alias("deg"))


def with_degrees(vertices: DataFrame, edges: DataFrame, kind: str = "out") -> DataFrame:
    """Every vertex with its degree, 0 if it has none."""
    if kind == "out":
        deg = out_degrees(edges).withColumnRenamed("src", "v")
    elif kind == "in":
        deg = in_degrees(edges).withColumnRenamed("dst", "v")
    elif kind == "total":
        deg = degrees(edges)
    else:
        raise ValueError(f"unknown degree kind {kind!r}")
    return vertices.join(deg, "v", "left").select(
        "v", F.coalesce(F.col("deg"), F.lit(0).cast("bigint")).alias("deg")
    )


def edge_weights(edges: DataFrame) -> DataFrame:
    """P10: ``src, dst, weight`` with weight = 1 / out-degree of the source."""
    degree = out_degrees(edges).withColumnRenamed("src", "v")
    return map_triplets(edges.select("src", "dst"), degree, {"weight": F.lit(1.0) / F.col("src_deg")})


def map_triplets(edges: DataFrame, attrs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """``edges`` with the columns ``new``, computed from edge columns and attributes of the ends.

    ``attrs(v, ...)`` has one row per vertex; its column x is ``src_x`` and ``dst_x`` in the expressions. Only
    an end that they use is joined, and only with the columns that they use. An edge whose used end has no row
    in ``attrs`` is left out.
    """
    names = [c for c in attrs.columns if c != "v"]
    given = [f.dataType for f in attrs.select(*names).schema]
    ends = T.StructType([T.StructField(f"{end}_{n}", t) for end in ("src", "dst") for n, t in zip(names, given)])
    # Analysed against the schemas alone, the expressions tell what they refer to.
    probe = edges.sparkSession.createDataFrame([], T.StructType(edges.schema.fields + ends.fields)).select(
        *[c.alias(n) for n, c in new.items()])
    used = {x.split("#")[0] for x in probe._jdf.queryExecution().analyzed().references().toSeq().mkString(",").split(",")}
    out = edges
    for end in ("src", "dst"):
        wanted = [n for n in names if f"{end}_{n}" in used]
        if wanted:
            out = out.join(attrs.select(F.col("v").alias(end), *[F.col(n).alias(f"{end}_{n}") for n in wanted]), end)
    return out.select(*edges.columns, *[c.alias(n) for n, c in new.items()])


def triplets(edges: DataFrame, attrs: DataFrame, value: str, src_name: str | None = None,
             dst_name: str | None = None) -> DataFrame:
    """Each edge with the attribute ``value`` of both ends.

    ``attrs(v, value)``, one row per vertex; the output has ``src_<value>`` and ``dst_<value>``
    unless names are given. Edges that are formed by a join of what their ends hold (``overlap_edges``) take the
    attributes from there: they are joined to both sides before the edges are formed, so that no edge is shuffled.
    Elsewhere the attributes are hashed, so that the edges, which are many more, are not sorted for
    either join: sorts of all edges go to disk.
    """
    sname = src_name or f"src_{value}"
    dname = dst_name or f"dst_{value}"
    names = [*edges.columns, sname, dname]
    if "with_ends" in vars(edges) and not {sname, dname, "ends", "endd"} & set(edges.columns):
        attrs = attrs.select("v", value)
        joined, edges = edges.with_ends(attrs, value)
        if joined is not None:
            joined = joined.withColumnsRenamed({"ends": sname, "endd": dname}).select(*names)
            return joined if edges is None else joined.unionByName(triplets(edges, attrs, value, sname, dname))
    a_src = attrs.select(F.col("v").alias("src"), F.col(value).alias(sname)).hint("shuffle_hash")
    a_dst = attrs.select(F.col("v").alias("dst"), F.col(value).alias(dname)).hint("shuffle_hash")
    return edges.join(a_src, "src").join(a_dst, "dst").select(*names)


def update_join(old: DataFrame, new: DataFrame, key: str, value: str, update: Column) -> DataFrame:
    """Rows of ``old`` whose key is in ``new`` take ``update``; the others keep their value.

    ``new(key, value_new)`` holds at most one row per key; ``update`` may refer
    to ``new_value`` (the matched value) and ``value`` (the old one).
    """
    n = new.select(F.col(key), F.col(value).alias("new_value"))
    return old.join(n, key, "left").select(
        key,
        F.when(F.col("new_value").isNotNull(), update).otherwise(F.col(value)).alias(value),
        *[c for c in old.columns if c not in (key, value)],
    )


def aggregate_neighbors(edges: DataFrame, values: DataFrame, message: Column, to: str = "dst",
                        agg: str = "sum", sides: tuple[str, ...] = ("src",), name: str = "total") -> DataFrame:
    """Send ``message`` along every edge and combine at one end.

    ``values(v, value)``; the message may use ``src_value``, ``dst_value``
    (only the ends listed in ``sides`` are joined) and any edge column.
    Returns ``<to>, <name>``; a vertex that gets no message has no row.
    """
    df = edges
    for side in sides:
        df = df.join(values.select(F.col("v").alias(side), F.col("value").alias(f"{side}_value")), side)
    fn = {"sum": F.sum, "min": F.min, "max": F.max, "count": F.count}[agg]
    return df.groupBy(to).agg(fn(message).alias(name))


def aggregate_messages(edges: DataFrame, values: DataFrame, messages: dict[str, Column],
                       aggregates: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """U3 / A8 / A9 in one pass: ``v`` and one column per aggregate, over all messages a vertex gets.

    ``messages``: what an edge sends to its ``src`` and to its ``dst`` (either may be missing); they may use edge
    columns and ``src_x`` / ``dst_x`` for a column x of ``values(v, ...)``. Both are made in one row and the edge
    is exploded once; the aggregates are partial, so a hub adds one row per task. A null message is not sent.
    """
    unknown = set(messages) - {"src", "dst"}
    if unknown or not messages:
        raise ValueError("messages go to 'src' or 'dst'")
    made = map_triplets(edges, values, {f"_to_{end}": m for end, m in messages.items()})
    sent = F.array(*[F.struct(F.col(end).alias("v"), F.col(f"_to_{end}").alias("message")) for end in messages])
    rows = made.select(F.explode(sent).alias("m")).select("m.v", "m.message").where(F.col("message").isNotNull())
    return rows.groupBy("v").agg(*[f(F.col("message")).alias(name) for name, f in aggregates.items()])


def adjacency(edges: DataFrame) -> DataFrame:
    """A3 + A4: distinct edges grouped by source, as ``src, n_targets``.

    The adjacency itself stays in long form (the distinct edge table); no
    per-source list is collected, so a source with a third of all edges is
    never held in one row or one task.
    """
    return edges.select("src", "dst").distinct().groupBy("src").agg(F.count(F.lit(1)).alias("n_targets"))


def adjacency_targets(edges: DataFrame) -> DataFrame:
    """A4 in long form: ``src, dst, n_targets``, each distinct edge with its source's number of targets."""
    return edges.select("src", "dst").distinct().join(adjacency(edges), "src").select("src", "dst", "n_targets")


def adjacency_lists(edges: DataFrame, max_targets: int = 10_000, salt_edges: int = 1 << 20) -> DataFrame:
    """A4 as lists: ``src, piece, targets, n_targets``, the distinct targets of a source in pieces from 0 of at most
    ``max_targets`` ids.

    A source of more than ``salt_edges`` targets is first dealt to salts by a hash of the target, so that a hub
    is many groups, which are numbered and cut apart in tasks of their own; ``n_targets`` counts all of the source.
    """
    distinct = edges.select("src", "dst").distinct()
    counted = distinct.join(adjacency(edges), "src")
    salts = F.ceil(F.col("n_targets") / F.lit(salt_edges))
    salted = counted.withColumn("salt", F.pmod(F.xxhash64("dst"), salts))
    group = Window.partitionBy("src", "salt").orderBy("dst")
    cut = salted.withColumn("chunk", F.floor((F.row_number().over(group) - 1) / F.lit(max_targets)))
    pieces = cut.groupBy("src", "salt", "chunk").agg(
        F.sort_array(F.collect_list("dst")).alias("targets"), F.max("n_targets").alias("n_targets"))
    # One row per salt of a source: where its pieces begin.
    per_salt = salted.groupBy("src", "salt").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_targets)).alias("pieces"))
    before = F.sum("pieces").over(Window.partitionBy("src").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = per_salt.select("src", "salt", F.coalesce(before, F.lit(0)).alias("start"))
    return pieces.join(starts, ["src", "salt"]).select(
        "src", (F.col("start") + F.col("chunk")).cast("bigint").alias("piece"), "targets", "n_targets")
