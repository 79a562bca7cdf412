"""Graphs and bags derived from the driver's tables, in Spark and in SQL.

Each fixture reads whole tables (no id subsets, no row caps):

* ``F_EDGE`` — part → next part of the same order (line order), every
  order line; lines of quantity 50 are given twice, so parallel edges exist.
* ``F_BAG_ORDER`` — one bag per order, its words the parts it holds.
* ``F_BAG_CUST`` — one bag per order, its word the customer (many
  components, one per customer).
* ``F_BAG_HOUR`` — one bag per hour of ``events``, its words the users
  active in it (with counts for the multiset form).
* ``F_BAG_DOC`` — one bag per document, its words the tokens of the whole
  text (lower case, split at anything outside a-z, U+00E0..U+00FF, 0-9).
* ``F_INTERVAL`` — one bag per hour of ``events``, its words the event types.

The ``*_SQL`` strings are the same definitions for DuckDB, used by the
oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordgraph.functions.columns import hour_key
from wordgraph.sources.tables import bags_from_events, bags_from_rows, bags_from_text, counts_from_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def f_edge(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    # Window groups are single orders (a handful of lines each).
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    e0 = li.select(
        F.col("l_partkey").alias("src"),
        F.lead("l_partkey").over(w).alias("dst"),
        F.col("l_quantity").alias("q"),
    ).where(F.col("dst").isNotNull())
    twice = F.explode(F.when(F.col("q") == 50, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return e0.select("src", "dst", twice.alias("copy")).select("src", "dst")


def f_bag_order(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return bags_from_rows(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_partkey")


def f_bag_cust(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """One bag per order, its word the customer: components = customers' orders."""
    return bags_from_rows(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey")


def f_bag_hour(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events").select(hour_key("ts").alias("hour"), "user_id")
    return bags_from_rows(ev, "hour", "user_id")


def f_bag_hour_counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    ev = table(spark, sf_dir, "events").select(hour_key("ts").alias("hour"), "user_id")
    return counts_from_rows(ev, "hour", "user_id")


def f_bag_doc(spark: SparkSession, sf_dir: str, counts: bool = False) -> tuple[DataFrame, DataFrame]:
    return bags_from_text(table(spark, sf_dir, "documents"), "doc_id", "text", counts=counts)


def f_interval(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return bags_from_events(table(spark, sf_dir, "events"), "ts", "event_type", "1 hour", counts=True)


# --- DuckDB forms (views named like the driver's tables) -------------------

F_EDGE_SQL = """(with base as (select l_partkey src, l_quantity q,
    lead(l_partkey) over (partition by l_orderkey
      order by l_linenumber, l_partkey, l_suppkey, l_quantity) dst from lineitem),
  e0 as (select src, dst, q from base where dst is not null)
select src, dst from e0 union all select src, dst from e0 where q = 50)"""

F_BAG_ORDER_SQL = "(select distinct l_orderkey v, l_partkey w from lineitem where l_partkey is not null)"
F_BAG_ORDER_V_SQL = "(select distinct l_orderkey v from lineitem)"

F_BAG_CUST_SQL = "(select distinct o_orderkey v, o_custkey w from orders where o_custkey is not null)"
F_BAG_CUST_V_SQL = "(select distinct o_orderkey v from orders)"

HOUR_SQL = "date_diff('hour', timestamp '1970-01-01', ts)"
F_BAG_HOUR_SQL = f"(select distinct {HOUR_SQL} v, user_id w from events where user_id is not null)"
F_BAG_HOUR_V_SQL = f"(select distinct {HOUR_SQL} v from events)"
F_BAG_HOUR_COUNTS_SQL = (
    f"(select {HOUR_SQL} v, user_id w, count(*) c from events where user_id is not null group by all)"
)

DOC_TOKENS_SQL = """(select v, w from (select doc_id v,
    unnest(regexp_split_to_array(lower(text), '[^a-zà-ÿ0-9]+')) w from documents) where w <> '')"""
F_BAG_DOC_SQL = f"(select distinct v, w from {DOC_TOKENS_SQL})"
F_BAG_DOC_V_SQL = "(select distinct doc_id v from documents)"
F_BAG_DOC_COUNTS_SQL = f"(select v, w, count(*) c from {DOC_TOKENS_SQL} group by all)"

F_INTERVAL_SQL = (
    f"(select {HOUR_SQL} v, event_type w, count(*) c from events where event_type is not null group by all)"
)
