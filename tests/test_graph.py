import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wordgraph import (
    adjacency,
    aggregate_neighbors,
    components_from_edges,
    degrees,
    edge_weights,
    out_degrees,
    place,
    placement_report,
    placement_summary,
    triplets,
    update_join,
    vertices_of,
    with_degrees,
)

E = [(0, 0), (0, 1), (1, 2), (1, 2), (3, 1)]


@pytest.fixture()
def edges(spark):
    return spark.createDataFrame(E, "src bigint, dst bigint")


def test_degrees(spark, edges):
    assert rows(out_degrees(edges)) == [(0, 2), (1, 2), (3, 1)]
    # A self loop counts twice in the total degree.
    assert rows(degrees(edges)) == [(0, 3), (1, 4), (2, 2), (3, 1)]
    vs = spark.createDataFrame([(0,), (1,), (2,), (3,), (9,)], "v bigint")
    assert rows(with_degrees(vs, edges, "out")) == [(0, 2), (1, 2), (2, 0), (3, 1), (9, 0)]
    assert rows(with_degrees(vs, edges, "total"))[-1] == (9, 0)
    assert rows(vertices_of(edges)) == [(0,), (1,), (2,), (3,)]


def test_weights_and_adjacency(spark, edges):
    w = {(s, d): x for s, d, x in rows(edge_weights(edges))}
    assert w[(1, 2)] == pytest.approx(0.5)
    assert w[(3, 1)] == pytest.approx(1.0)
    assert rows(adjacency(edges)) == [(0, 2), (1, 1), (3, 1)]


def test_triplets_and_neighbours(spark, edges):
    attrs = spark.createDataFrame([(0, 10), (1, 20), (2, 30), (3, 40)], "v bigint, value bigint")
    t = rows(triplets(edges, attrs, "value"))
    assert (3, 1, 40, 20) in t and len(t) == 5
    to_dst = aggregate_neighbors(edges, attrs, F.col("src_value"), to="dst")
    assert rows(to_dst) == [(0, 10), (1, 50), (2, 40)]
    to_src = aggregate_neighbors(edges, attrs, F.col("dst_value"), to="src", sides=("dst",))
    assert rows(to_src) == [(0, 30), (1, 60), (3, 20)]


def test_update_join(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 1.0), (3, 5.0)], "id bigint, rank double")
    new = spark.createDataFrame([(2, 4.0)], "id bigint, rank double")
    out = update_join(old, new, "id", "rank", F.lit(0.15) + F.lit(0.85) * F.col("new_value"))
    assert rows(out) == [(1, 1.0), (2, pytest.approx(3.55)), (3, 5.0)]


def test_components_from_edges(spark):
    e = spark.createDataFrame([(5, 6), (6, 7), (10, 11), (12, 12)], "src bigint, dst bigint")
    vs = spark.createDataFrame([(5,), (6,), (7,), (10,), (11,), (12,), (99,)], "v bigint")
    assert rows(components_from_edges(vs, e)) == [(5, 5), (6, 5), (7, 5), (10, 10), (11, 10), (12, 12), (99, 99)]


def test_long_chain_components(spark):
    n = 64
    e = spark.createDataFrame([(i + 1, i) for i in range(n - 1)], "src bigint, dst bigint")
    vs = spark.createDataFrame([(i,) for i in range(n)], "v bigint")
    got = rows(components_from_edges(vs, e))
    assert got == [(i, 0) for i in range(n)]


def test_rounds_of_an_unlucky_path(spark):
    # The path 0, 63, 62, ..., 1: without hooking its rounds grow with its length.
    from wordgraph.operators.components import contract
    from wordgraph.session import TableCuts

    path = [0, *range(63, 0, -1)]
    e = spark.createDataFrame(list(zip(path, path[1:])), "u bigint, v bigint")
    stars, rounds = contract(e, TableCuts(spark, "path"))
    assert rows(stars, "u", "v") == [(i, 0) for i in range(1, 64)]
    assert rounds <= 12


@pytest.mark.parametrize("strategy", ["grid", "src", "pair", "mod"])
def test_placement(spark, strategy):
    e = spark.createDataFrame([(i, (i * 7) % 13) for i in range(40)] + [(1, 7)], "src bigint, dst bigint")
    rep = placement_report(e, strategy, 6)
    total = sum(r["n_edges"] for r in rep.collect())
    assert total == (40 if strategy == "mod" else 41)
    assert all(0 <= r["part"] < 6 for r in rep.collect())
    s = placement_summary(e, strategy, 6).first()
    assert s["n_edges"] == total and s["replication"] >= 1.0 and s["edge_skew"] >= 1.0
    placed = place(e, strategy, 6)
    assert placed.rdd.getNumPartitions() == 6


def test_checkpoint_dir_and_release(spark):
    import os

    from wordgraph.session import TableCuts, checkpoint_dir, release_cuts

    d = checkpoint_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert d.replace("file:", "").startswith(configured.replace("file:", "").rstrip("/"))
    cuts = TableCuts(spark, "test")
    df = cuts.cut(spark.range(10), "t")
    assert df.count() == 10
    root = cuts.root.replace("file:", "")
    assert os.path.isdir(root)
    assert release_cuts(spark) >= 1
    assert not os.path.exists(root)


def test_spread_only_small_inputs(spark):
    from wordgraph.session import spread

    one = spark.range(100).coalesce(1)
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(spark.sparkContext.defaultParallelism * 2)
    assert spread(many, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2


def test_triplets_sort_no_edges(spark):
    """Neither join sorts the edges, which are many more than the vertices."""
    edges = spark.range(50).selectExpr("id as src", "id + 1 as dst")
    attrs = spark.range(40).selectExpr("id as v", "id * 2 as value")
    found = triplets(edges, attrs, "value")
    assert rows(found) == [(k, k + 1, 2 * k, 2 * k + 2) for k in range(39)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
