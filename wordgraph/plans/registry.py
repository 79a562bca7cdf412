"""Every operator as a named query over the driver's tables, with its SQL oracle.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (DuckDB,
views named like the tables) return the same columns; doubles are rounded
to 9 digits on both sides, DuckDB's 128-bit sums are cast to BIGINT.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.functions.columns import doc_tokens, hour_key
from wordgraph.operators import components as C
from wordgraph.operators import graph as G
from wordgraph.operators import overlap as O
from wordgraph.operators import placement as PL
from wordgraph.operators.numbering import number_rows
from wordgraph.operators.pagerank import pagerank
from wordgraph.plans import fixtures as FX
from wordgraph.plans import questions as Q
from wordgraph.session import TableCuts
from wordgraph.sources import text as T
from wordgraph.sources.sinks import write_tuples
from wordgraph.sources.tables import bags_from_events
from wordgraph.streaming.intervals import append_closed_intervals, run_interval_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

ROUND = 9
# Fixed value: the reference's part count, for the placement reports only. The
# iterative queries take the session's number of shuffle partitions.
PLACEMENT_PARTS = 20


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


def r9(col: str) -> F.Column:
    return F.round(F.col(col), ROUND).alias(col)


# --- graph operators on F_EDGE ------------------------------------------------


@register("edge_out_degree", f"select src, count(*) deg from {FX.F_EDGE_SQL} group by src")
def edge_out_degree(spark, d):
    return G.out_degrees(FX.f_edge(spark, d))


PART_V_SQL = "(select p_partkey v from part)"


def _parts(spark, d):
    return FX.table(spark, d, "part").select(F.col("p_partkey").alias("v"))


@register(
    "vertex_out_degree",
    f"""select p.v, coalesce(k.deg, 0) deg from {PART_V_SQL} p
    left join (select src v, count(*) deg from {FX.F_EDGE_SQL} group by src) k using (v)""",
)
def vertex_out_degree(spark, d):
    return G.with_degrees(_parts(spark, d), FX.f_edge(spark, d), "out")


@register(
    "vertex_total_degree",
    f"""with e as {FX.F_EDGE_SQL},
    k as (select v, count(*) deg from (select src v from e union all select dst v from e) group by v)
    select p.v, coalesce(k.deg, 0) deg from {PART_V_SQL} p left join k using (v)""",
)
def vertex_total_degree(spark, d):
    return G.with_degrees(_parts(spark, d), FX.f_edge(spark, d), "total")


@register(
    "edge_weights",
    f"""with e as {FX.F_EDGE_SQL}, k as (select src, count(*) deg from e group by src)
    select src, dst, round(1.0::double / deg, {ROUND}) weight from e join k using (src)""",
)
def edge_weights(spark, d):
    return G.edge_weights(FX.f_edge(spark, d)).select("src", "dst", r9("weight"))


@register("edge_distinct", f"select distinct src, dst from {FX.F_EDGE_SQL}")
def edge_distinct(spark, d):
    return FX.f_edge(spark, d).distinct()


@register(
    "edge_adjacency",
    f"select src, count(*) n_targets from (select distinct src, dst from {FX.F_EDGE_SQL}) group by src",
)
def edge_adjacency(spark, d):
    return G.adjacency(FX.f_edge(spark, d))


@register(
    "neighbor_sum_to_dst",
    f"""with e as {FX.F_EDGE_SQL}, k as (select src, count(*) deg from e group by src)
    select dst, cast(sum(deg) as bigint) total from e join k using (src) group by dst""",
)
def neighbor_sum_to_dst(spark, d):
    e = FX.f_edge(spark, d)
    values = G.with_degrees(G.vertices_of(e), e, "out").withColumnRenamed("deg", "value")
    return G.aggregate_neighbors(e, values, F.col("src_value"), to="dst", sides=("src",))


@register("adjacency_lists", f"""with e as (select distinct src, dst from {FX.F_EDGE_SQL})
    select src, dst, count(*) over (partition by src) n_targets from e""")
def adjacency_lists(spark, d):
    """Pieces of 4 targets from salts of 8, exploded again: every target once, with its source's number of targets."""
    pieces = G.adjacency_lists(FX.f_edge(spark, d), max_targets=4, salt_edges=8)
    return pieces.select("src", F.explode("targets").alias("dst"), "n_targets")


@register("adjacency_list_sizes", f"""with k as (select src, count(*) n from (select distinct src, dst from {FX.F_EDGE_SQL}) group by src)
    select src, unnest(range((n + 15) // 16)) piece, n n_targets from k""")
def adjacency_list_sizes(spark, d):
    """Pieces are numbered from 0 without gaps, and full but for the last."""
    pieces = G.adjacency_lists(FX.f_edge(spark, d), max_targets=16)
    return pieces.where((F.size("targets") == 16) | (F.size("targets") == F.col("n_targets") - 16 * F.col("piece"))).drop("targets")


@register(
    "neighbor_sums_both",
    f"""with e as {FX.F_EDGE_SQL}, s as (select p_partkey v, p_size x from part),
    m as (select e.src v, b.x from e join s a on a.v = e.src join s b on b.v = e.dst
      union all select e.dst, a.x from e join s a on a.v = e.src join s b on b.v = e.dst)
    select v, cast(sum(x) as bigint) total, count(*) n, min(x) least, max(x) largest from m group by v""",
)
def neighbor_sums_both(spark, d):
    values = FX.table(spark, d, "part").select(F.col("p_partkey").alias("v"), F.col("p_size").alias("size"))
    return G.aggregate_messages(
        FX.f_edge(spark, d), values, {"src": F.col("dst_size"), "dst": F.col("src_size")},
        {"total": F.sum, "n": F.count, "least": F.min, "largest": F.max})


@register("triplet_differences", f"""select e.src, e.dst, a.p_size - b.p_size size_step, b.p_retailprice price
    from {FX.F_EDGE_SQL} e join part a on a.p_partkey = e.src join part b on b.p_partkey = e.dst""")
def triplet_differences(spark, d):
    attrs = FX.table(spark, d, "part").select(F.col("p_partkey").alias("v"), F.col("p_size").alias("size"),
                                              F.col("p_retailprice").alias("price"), "p_name")
    return G.map_triplets(FX.f_edge(spark, d), attrs, {"size_step": F.col("src_size") - F.col("dst_size"),
                                                       "price": F.col("dst_price")})


@register("adjacency_targets", f"""with e as (select distinct src, dst from {FX.F_EDGE_SQL})
    select src, dst, count(*) over (partition by src) n_targets from e""")
def adjacency_targets(spark, d):
    return G.adjacency_targets(FX.f_edge(spark, d))


@register(
    "update_join",
    f"""select p.v, coalesce(0.5::double + k.deg, 1.0::double) as value from {PART_V_SQL} p
    left join (select dst v, count(*) deg from {FX.F_EDGE_SQL} group by dst) k using (v)""",
)
def update_join(spark, d):
    new = G.in_degrees(FX.f_edge(spark, d)).select(F.col("dst").alias("v"), F.col("deg").cast("double").alias("value"))
    return G.update_join(_parts(spark, d).withColumn("value", F.lit(1.0)), new, "v", "value", F.lit(0.5) + F.col("new_value"))


# --- text files: written below the checkpoint folder, then read by the library's readers ---


def _written_lines(lines: DataFrame, name: str) -> str:
    path = f"{TableCuts(lines.sparkSession, name).root}/lines"
    lines.write.text(path)
    return path


@register("edge_list_file", f"select src, dst from {FX.F_EDGE_SQL}")
def edge_list_file(spark, d):
    lines = FX.f_edge(spark, d).select(F.concat_ws("\t", "src", "dst").alias("value"))
    return T.edge_list(spark, _written_lines(lines, "edge-list"))


@register("url_pairs_file", f"select distinct cast(src as varchar) src, cast(dst as varchar) dst from {FX.F_EDGE_SQL}")
def url_pairs_file(spark, d):
    lines = FX.f_edge(spark, d).select(F.concat_ws(" ", "src", "dst", F.lit("more")).alias("value"))
    return T.url_pairs(spark, _written_lines(lines, "url-pairs"))


@register("write_tuples_file", f"""select '(' || src || ',' || count(*) || ')' line from {FX.F_EDGE_SQL} group by src""")
def write_tuples_file(spark, d):
    path = f"{TableCuts(spark, 'tuples').root}/lines"
    write_tuples(G.out_degrees(FX.f_edge(spark, d)), path, "src", "deg")
    return spark.read.text(path).withColumnRenamed("value", "line")


DOCS_PER_FILE = 64


def _written_bags(spark, d) -> str:
    """Files of the words of 64 documents each, one word a line, and an empty first file.

    A row holds the lines of a document, and a task writes as many files as fall to its part: the number of tasks
    does not grow with the number of files.
    """
    cuts = TableCuts(spark, "bag-files")
    docs = number_rows(FX.table(spark, d, "documents").select("doc_id", "text"), [F.col("doc_id").asc()], cuts)
    number = F.floor(F.col("v") / F.lit(DOCS_PER_FILE)).cast("int") + 1
    # Of equal width, so that the folders are in the order of the bags.
    bag = F.lpad(number.cast("string"), 10, "0").alias("bag")
    path = f"{cuts.root}/bags"
    # The empty first file: a job without rows writes one.
    spark.createDataFrame([], "value string").write.text(f"{path}/bag={'0' * 10}")
    dealt = docs.select(bag, "text").repartition("bag")
    words = dealt.select("bag", doc_tokens("text").alias("words")).where(F.size("words") > 0)
    lines = words.select("bag", F.concat_ws("\n", "words").alias("value"))
    lines.write.mode("append").partitionBy("bag").text(path)
    return path


_BAG_FILES_SQL = f"""(select v, w, count(*) c from (select (n - 1) // {DOCS_PER_FILE} + 1 v,
    unnest(regexp_extract_all(lower(text), '[a-zà-ÿ0-9]+')) w
    from (select text, row_number() over (order by doc_id) n from documents)) group by all)"""


@register("bag_files_counts", f"select v, w, c from {_BAG_FILES_SQL}")
def bag_files_counts(spark, d):
    return T.bag_files(spark, _written_bags(spark, d), counts=True)[1]


@register("bag_files_words", f"select v, w from {_BAG_FILES_SQL}")
def bag_files_words(spark, d):
    return T.bag_files(spark, _written_bags(spark, d))[1]


@register("bag_files_sizes", f"""select v, count(w) n from (select unnest(range((count(*) + {DOCS_PER_FILE - 1}) // {DOCS_PER_FILE} + 1)) v
    from documents) left join {_BAG_FILES_SQL} using (v) group by v""")
def bag_files_sizes(spark, d):
    """The empty file is a vertex too."""
    return O.bag_sizes(*T.bag_files(spark, _written_bags(spark, d)))


# --- PageRank -------------------------------------------------------------------


def _pagerank_keep_sql(rounds: int) -> str:
    parts = [
        f"e as materialized ({FX.F_EDGE_SQL[1:-1]})",
        "d as (select src, count(*) k from e group by 1)",
        "w as materialized (select e.src, e.dst, 1.0::double / k x from e join d using (src))",
        "r0 as (select id, 1.0::double rank from (select src id from e union select dst from e))",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} as materialized (select r.id, coalesce(0.15::double + 0.85::double * c.c, r.rank) rank "
            f"from r{i-1} r left join (select w.dst id, sum(p.rank * w.x) c from w join r{i-1} p "
            f"on p.id = w.src group by 1) c using (id))"
        )
    return "with " + ",\n ".join(parts) + f"\nselect id, round(rank, {ROUND}) rank from r{rounds}"


def _pagerank_drop_sql(rounds: int) -> str:
    parts = [
        f"e as materialized (select distinct src, dst from {FX.F_EDGE_SQL})",
        "d as (select src, count(*) k from e group by 1)",
        "w as materialized (select e.src, e.dst, 1.0::double / k x from e join d using (src))",
        "r0 as (select distinct src id, 1.0::double rank from e)",
    ]
    for i in range(1, rounds + 1):
        parts.append(
            f"r{i} as materialized (select w.dst id, 0.15::double + 0.85::double * sum(p.rank * w.x) rank "
            f"from w join r{i-1} p on p.id = w.src group by 1)"
        )
    return "with " + ",\n ".join(parts) + f"\nselect id, round(rank, {ROUND}) rank from r{rounds}"


def _pagerank_drop_strings_sql(rounds: int) -> str:
    sql = _pagerank_drop_sql(rounds)
    return sql.replace(
        f"e as materialized (select distinct src, dst from {FX.F_EDGE_SQL})",
        f"e as materialized (select distinct cast(src as varchar) src, cast(dst as varchar) dst from {FX.F_EDGE_SQL})",
        1,
    )


def _pr(spark, d, **kw):
    return pagerank(FX.f_edge(spark, d), **kw).select("id", r9("rank"))


@register("rank_update_join", _pagerank_keep_sql(1))
def rank_update_join(spark, d):
    return _pr(spark, d, iterations=1, missing="keep", placement="src")


@register("pagerank_keep", _pagerank_keep_sql(10))
def pagerank_keep(spark, d):
    return _pr(spark, d, iterations=10, missing="keep", placement="grid")


@register("pagerank_keep_by_source", _pagerank_keep_sql(10))
def pagerank_keep_by_source(spark, d):
    return _pr(spark, d, iterations=10, missing="keep", placement="src")


@register("pagerank_keep_by_pair", _pagerank_keep_sql(10))
def pagerank_keep_by_pair(spark, d):
    return _pr(spark, d, iterations=10, missing="keep", placement="pair")


@register("pagerank_keep_salted", _pagerank_keep_sql(10))
def pagerank_keep_salted(spark, d):
    """Sources of more than 8 out-edges are salted, so salting runs on small tables too."""
    return _pr(spark, d, iterations=10, missing="keep", placement="src", salt_edges=8)


@register("pagerank_keep_resumed", _pagerank_keep_sql(10))
def pagerank_keep_resumed(spark, d):
    """A run of four rounds, and one under the same name that goes on from its tables."""
    name = f"resumed-{uuid.uuid4().hex}"
    pagerank(FX.f_edge(spark, d), iterations=4, missing="keep", name=name)
    return _pr(spark, d, iterations=10, missing="keep", name=name)


@register("pagerank_drop", _pagerank_drop_sql(10))
def pagerank_drop(spark, d):
    return _pr(spark, d, iterations=10, missing="drop", placement="mod")


@register("pagerank_drop_string_ids", _pagerank_drop_strings_sql(10))
def pagerank_drop_string_ids(spark, d):
    e = FX.f_edge(spark, d).select(F.col("src").cast("string").alias("src"), F.col("dst").cast("string").alias("dst"))
    return pagerank(e, iterations=10, missing="drop").select("id", r9("rank"))


# --- placement ------------------------------------------------------------------

_PART_SQL = {
    "grid": "cast((src % 5) * 4 + dst % 4 as integer)",
    "src": "cast(src % 20 as integer)",
    "pair": "cast((src * 31 + dst) % 20 as integer)",
    "mod": "cast(src % 20 as integer)",
}


def _placement_sql(strategy: str) -> str:
    e = f"(select distinct src, dst from {FX.F_EDGE_SQL})" if strategy == "mod" else FX.F_EDGE_SQL
    return f"""with pe as (select src, dst, {_PART_SQL[strategy]} part from {e}),
    ends as (select part, src v from pe union all select part, dst v from pe)
    select a.part, a.n_edges, b.n_vertices
    from (select part, count(*) n_edges from pe group by part) a
    join (select part, count(distinct v) n_vertices from ends group by part) b using (part)"""


def _placement_query(strategy: str) -> Query:
    def q(spark, d):
        return PL.placement_report(FX.f_edge(spark, d), strategy, PLACEMENT_PARTS)

    return q


for _s, _name in (("grid", "placement_grid"), ("src", "placement_src"), ("pair", "placement_pair"), ("mod", "placement_mod")):
    register(_name, _placement_sql(_s))(_placement_query(_s))


@register(
    "placement_summary_grid",
    f"""with pe as (select src, dst, {_PART_SQL['grid']} part from {FX.F_EDGE_SQL}),
    ends as (select part, src v from pe union all select part, dst v from pe),
    pp as (select part, count(*) n_edges from pe group by part),
    pv as (select part, count(distinct v) n_vertices from ends group by part),
    nv as (select count(distinct v) n_v from ends)
    select count(*) n_parts, cast(sum(n_edges) as bigint) n_edges, max(n_edges) max_edges,
      round(sum(n_vertices) / max(n_v), {ROUND}) replication,
      round(max(n_edges) * {PLACEMENT_PARTS} / sum(n_edges), {ROUND}) edge_skew
    from pp join pv using (part), nv""",
)
def placement_summary_grid(spark, d):
    return PL.placement_summary(FX.f_edge(spark, d), "grid", PLACEMENT_PARTS)


# --- bags -----------------------------------------------------------------------


@register("bag_words", f"select v, w from {FX.F_BAG_ORDER_SQL}")
def bag_words(spark, d):
    return FX.f_bag_order(spark, d)[1]


@register("bag_word_counts", f"select v, w, c from {FX.F_BAG_HOUR_COUNTS_SQL}")
def bag_word_counts(spark, d):
    return FX.f_bag_hour_counts(spark, d)[1]


@register(
    "bag_sizes",
    f"""select v.v, coalesce(n.n, 0) n from {FX.F_BAG_DOC_V_SQL} v
    left join (select v, count(*) n from {FX.F_BAG_DOC_SQL} group by v) n using (v)""",
)
def bag_sizes(spark, d):
    vertices, postings = FX.f_bag_doc(spark, d)
    return O.bag_sizes(vertices, postings)


@register("interval_bags", f"select v, w, c from {FX.F_INTERVAL_SQL}")
def interval_bags(spark, d):
    return FX.f_interval(spark, d)[1]


@register("interval_bags_day",
          "select date_diff('day', date '1970-01-01', cast(ts as date)) as v, event_type as w, count(*) as c"
          " from events where event_type is not null group by all")
def interval_bags_day(spark, d):
    return bags_from_events(spark.read.parquet(f"{d}/events.parquet"), "ts", "event_type", "1 day")[1]


@register("interval_bags_stream", f"select v, w, c from {FX.F_INTERVAL_SQL}")
def interval_bags_stream(spark, d):
    return run_interval_counts(spark, d, "events.parquet", "ts", "event_type", "1 hour")


@register("interval_bags_watermark", f"""with t as (select ts, event_type w, {FX.HOUR_SQL} v from events),
    m as (select min(ts) a, max(ts) b from events)
    select v, w, count(*) c from t, m where w is not null
      and timestamp '1970-01-01' + to_hours(cast(v + 1 as integer)) <= b - interval 10 minutes group by v, w""")
def interval_bags_watermark(spark, d):
    """Two batches in event order, then the first half's events once more, all of them late.

    Rule: an hour's counts come once the latest event is 10 minutes past its end; the events that come again
    belong to closed hours and are dropped. Hours that no event closes are not returned.
    """
    events = FX.table(spark, d, "events").select("ts", "event_type")
    ends = events.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    hour = hour_key("ts")
    half = ends.select(((hour_key("a") + hour_key("b")) / 2).cast("long").alias("half")).first()["half"]
    root = TableCuts(spark, "watermark").root
    found = None
    for batch in (events.where(hour <= half), events.where(hour > half), events.where(hour <= half)):
        batch.write.mode("append").parquet(f"{root}/events")
        found = append_closed_intervals(spark, f"{root}/events", events.schema, "ts", "event_type", "1 hour", "10 minutes", root)
    return found


# --- overlap graph --------------------------------------------------------------


def _pairs_sql(bag_sql: str) -> str:
    return f"(select distinct a.v src, b.v dst from {bag_sql} a join {bag_sql} b using (w) where a.v <> b.v)"


def _sizes_sql(bag_sql: str) -> str:
    return f"(select v, count(*) n from {bag_sql} group by v)"


@register("overlap_edges", f"select src, dst, 0 attr from {_pairs_sql(FX.F_BAG_ORDER_SQL)}")
def overlap_edges(spark, d):
    _, p = FX.f_bag_order(spark, d)
    return O.overlap_edges(p, attr=0)


@register("overlap_edges_hybrid", f"select src, dst, 0 attr from {_pairs_sql(FX.F_BAG_DOC_SQL)}")
def overlap_edges_hybrid(spark, d):
    _, p = FX.f_bag_doc(spark, d)
    return O.overlap_edges(p, attr=0)


@register("overlap_edges_blocks", f"select src, dst, 1 attr from {_pairs_sql(FX.F_BAG_DOC_SQL)}")
def overlap_edges_blocks(spark, d):
    """Cells of 64 rows, so that words of a small table have several blocks."""
    return O.overlap_edges(FX.f_bag_doc(spark, d)[1], cell_rows=64, attr=1)


@register(
    "edge_triplets",
    f"""with s as {_sizes_sql(FX.F_BAG_ORDER_SQL)}
    select g.src, g.dst, a.n ns, b.n nd from {_pairs_sql(FX.F_BAG_ORDER_SQL)} g
    join s a on a.v = g.src join s b on b.v = g.dst""",
)
def edge_triplets(spark, d):
    g = O.overlap_graph(*FX.f_bag_order(spark, d))
    return g.edges.select("src", "dst", "ns", "nd")


@register(
    "edge_triplets_joined",
    f"""with s as {_sizes_sql(FX.F_BAG_ORDER_SQL)}
    select g.src, g.dst, a.n ns, b.n nd from {_pairs_sql(FX.F_BAG_ORDER_SQL)} g
    join s a on a.v = g.src join s b on b.v = g.dst""",
)
def edge_triplets_joined(spark, d):
    v, p = FX.f_bag_order(spark, d)
    sizes = O.bag_sizes(v, p).withColumnRenamed("n", "value")
    return G.triplets(O.overlap_edges(p), sizes, "value", "ns", "nd").select("src", "dst", "ns", "nd")


@register(
    "neighbor_sum_to_src",
    f"""with s as {_sizes_sql(FX.F_BAG_ORDER_SQL)}
    select g.src, cast(sum(b.n) as bigint) total from {_pairs_sql(FX.F_BAG_ORDER_SQL)} g
    join s b on b.v = g.dst group by g.src""",
)
def neighbor_sum_to_src(spark, d):
    return O.neighbor_totals(FX.f_bag_order(spark, d)[1]).select(F.col("v").alias("src"), "total")


def _q1_sql(bag_sql: str) -> str:
    return f"""with s as {_sizes_sql(bag_sql)}
    select count(*) n_edges from {_pairs_sql(bag_sql)} g
    join s a on a.v = g.src join s b on b.v = g.dst where a.n > b.n"""


def _q1(fixture):
    def q(spark, d):
        return O.larger_source_count(fixture(spark, d)[1])

    return q


register("q1_larger_source", _q1_sql(FX.F_BAG_DOC_SQL))(_q1(FX.f_bag_doc))
register("q1_larger_source_orders", _q1_sql(FX.F_BAG_ORDER_SQL))(_q1(FX.f_bag_order))
register("q1_larger_source_hours", _q1_sql(FX.F_BAG_HOUR_SQL))(_q1(FX.f_bag_hour))


def _q2_sql(bag_sql: str) -> str:
    return f"""with s as {_sizes_sql(bag_sql)}
    select g.src v, count(*) out_degree, max(s.n) n_words from {_pairs_sql(bag_sql)} g
    join s on s.v = g.src group by g.src order by out_degree desc, n_words desc, v limit 1"""


def _q2(fixture):
    def q(spark, d):
        return Q.most_popular_bag(O.neighbor_totals(fixture(spark, d)[1]))

    return q


register("q2_popular_vertex", _q2_sql(FX.F_BAG_ORDER_SQL))(_q2(FX.f_bag_order))
register("q2_popular_vertex_docs", _q2_sql(FX.F_BAG_DOC_SQL))(_q2(FX.f_bag_doc))
register("q2_popular_vertex_customers", _q2_sql(FX.F_BAG_CUST_SQL))(_q2(FX.f_bag_cust))


def _q2_tied_sql(bag_sql: str) -> str:
    return f"""with s as {_sizes_sql(bag_sql)},
    k as (select g.src v, count(*) out_degree, max(s.n) n_words from {_pairs_sql(bag_sql)} g join s on s.v = g.src group by g.src)
    select v, out_degree, n_words, count(*) over () n_tied from k where out_degree = (select max(out_degree) from k)"""


def _q2_tied(fixture):
    def q(spark, d):
        # Read twice: for the largest degree, and for those that have it.
        totals = TableCuts(spark, "tied").cut(O.neighbor_totals(fixture(spark, d)[1]), "totals")
        return Q.tied_vertices(totals.select("v", F.col("k").alias("out_degree"), F.col("n").alias("n_words")))

    return q


register("q2_tied_vertices", _q2_tied_sql(FX.F_BAG_CUST_SQL))(_q2_tied(FX.f_bag_cust))
register("q2_tied_vertices_hours", _q2_tied_sql(FX.F_BAG_HOUR_SQL))(_q2_tied(FX.f_bag_hour))


def _q3_sql(bag_sql: str) -> str:
    return f"""with s as {_sizes_sql(bag_sql)},
    t as (select g.src v, sum(b.n) total, count(*) k from {_pairs_sql(bag_sql)} g join s b on b.v = g.dst group by g.src)
    select v, cast(total // k as float) avg_words, round(total / k, {ROUND}) avg_words_exact from t"""


def _q3(fixture):
    def q(spark, d):
        out = Q.neighbor_average_of(O.neighbor_totals(fixture(spark, d)[1]))
        return out.select("v", "avg_words", r9("avg_words_exact"))

    return q


register("q3_neighbor_average", _q3_sql(FX.F_BAG_HOUR_SQL))(_q3(FX.f_bag_hour))
register("q3_neighbor_average_orders", _q3_sql(FX.F_BAG_ORDER_SQL))(_q3(FX.f_bag_order))


def _q4_sql(counts_sql: str, by: str) -> str:
    order = "c desc, w" if by == "count" else "w desc"
    return f"select w, cast(sum(c) as bigint) c from {counts_sql} group by w order by {order} limit 1"


def _q4(fixture, by):
    def q(spark, d):
        return Q.most_popular_word(fixture(spark, d)[1], by)

    return q


def _doc_counts(spark, d):
    return FX.f_bag_doc(spark, d, counts=True)


register("q4_popular_word", _q4_sql(FX.F_BAG_DOC_COUNTS_SQL, "count"))(_q4(_doc_counts, "count"))
register("q4_last_word", _q4_sql(FX.F_BAG_DOC_COUNTS_SQL, "word"))(_q4(_doc_counts, "word"))
register("q4_popular_user_hours", _q4_sql(FX.F_BAG_HOUR_COUNTS_SQL, "count"))(_q4(FX.f_bag_hour_counts, "count"))


def _q6_sql(counts_sql: str, by: str) -> str:
    return f"""with t as ({_q4_sql(counts_sql, by)})
    select t.w, t.c, (select count(*) from {counts_sql} x where x.w = t.w) n_vertices from t"""


def _q6(fixture, by):
    def q(spark, d):
        return Q.word_presence(fixture(spark, d)[1], by)

    return q


register("q6_word_presence", _q6_sql(FX.F_BAG_DOC_COUNTS_SQL, "count"))(_q6(_doc_counts, "count"))
register("q6_last_word_presence", _q6_sql(FX.F_BAG_DOC_COUNTS_SQL, "word"))(_q6(_doc_counts, "word"))


# --- components -------------------------------------------------------------------


def _components_sql(vertex_sql: str, pair_sql: str) -> str:
    return f"""with recursive g(s, d) as materialized ({pair_sql[1:-1]}),
    r(v, l) using key (v) as (
      select v, v from {vertex_sql}
      union
      select g.d, min(r.l) from r join g on g.s = r.v join recurring.r cur on cur.v = g.d
      where r.l < cur.l group by g.d)
    select v, l component from r"""


ORDER_COMPONENTS_SQL = _components_sql(FX.F_BAG_ORDER_V_SQL, _pairs_sql(FX.F_BAG_ORDER_SQL))


@register("components", ORDER_COMPONENTS_SQL)
def components(spark, d):
    v, p = FX.f_bag_order(spark, d)
    return C.components_from_postings(v, p)


@register(
    "component_sizes",
    f"select component, count(*) n_vertices from ({ORDER_COMPONENTS_SQL}) group by component",
)
def component_sizes(spark, d):
    v, p = FX.f_bag_order(spark, d)
    return C.component_sizes(C.components_from_postings(v, p))


@register(
    "q5_largest_component",
    f"""select component, count(*) n_vertices from ({ORDER_COMPONENTS_SQL}) group by component
    order by n_vertices desc, component limit 1""",
)
def q5_largest_component(spark, d):
    v, p = FX.f_bag_order(spark, d)
    return Q.largest_component(C.components_from_postings(v, p))


EDGE_COMPONENTS_SQL = _components_sql(
    f"(select src v from {FX.F_EDGE_SQL} union select dst from {FX.F_EDGE_SQL})",
    f"(select src, dst from {FX.F_EDGE_SQL} where src <> dst union select dst, src from {FX.F_EDGE_SQL} where src <> dst)",
)


@register("components_edges", EDGE_COMPONENTS_SQL)
def components_edges(spark, d):
    e = FX.f_edge(spark, d)
    return C.components_from_edges(G.vertices_of(e), e)


CUST_COMPONENTS_SQL = _components_sql(FX.F_BAG_CUST_V_SQL, _pairs_sql(FX.F_BAG_CUST_SQL))


@register("components_customer_orders", CUST_COMPONENTS_SQL)
def components_customer_orders(spark, d):
    v, p = FX.f_bag_cust(spark, d)
    return C.components_from_postings(v, p)


@register(
    "component_sizes_customer_orders",
    f"select component, count(*) n_vertices from ({CUST_COMPONENTS_SQL}) group by component",
)
def component_sizes_customer_orders(spark, d):
    v, p = FX.f_bag_cust(spark, d)
    return C.component_sizes(C.components_from_postings(v, p))


@register(
    "q5_largest_component_customers",
    f"""select component, count(*) n_vertices from ({CUST_COMPONENTS_SQL}) group by component
    order by n_vertices desc, component limit 1""",
)
def q5_largest_component_customers(spark, d):
    v, p = FX.f_bag_cust(spark, d)
    return Q.largest_component(C.components_from_postings(v, p))
