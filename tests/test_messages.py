"""Messages to both ends, triplet mapping, target lists, the tied set, resumed PageRank, bag ids."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wordgraph import adjacency_lists, aggregate_messages, bag_files, map_triplets, pagerank, tied_vertices
from wordgraph.operators import pagerank as PR
from wordgraph.operators.numbering import number_rows
from wordgraph.session import TableCuts, checkpoint_dir, is_complete

EDGES = [(1, 2), (1, 2), (2, 3), (3, 3), (4, 1), (9, 1)]
VALUES = [(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, None, "d")]


@pytest.fixture(scope="module")
def graph(spark):
    return spark.createDataFrame(EDGES, "src long, dst long"), spark.createDataFrame(VALUES, "v long, x int, name string")


def test_messages_to_both_ends(graph):
    edges, values = graph
    got = aggregate_messages(edges, values, {"src": F.col("dst_x"), "dst": F.col("src_x")},
                             {"total": F.sum, "n": F.count, "least": F.min})
    # 9 has no value, so its edge sends nothing; 4's value is null, so 1 gets nothing from it.
    assert rows(got) == [(1, 40, 2, 20), (2, 50, 3, 10), (3, 80, 3, 20), (4, 10, 1, 10)]
    to_dst = aggregate_messages(edges, values, {"dst": F.lit(1)}, {"n": F.count})
    assert rows(to_dst) == [(1, 2), (2, 2), (3, 2)]
    with pytest.raises(ValueError):
        aggregate_messages(edges, values, {"both": F.lit(1)}, {"n": F.count})


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def test_triplets_join_only_used_ends(graph):
    edges, values = graph
    one = map_triplets(edges, values, {"y": F.col("src_x") + F.col("dst")})
    none = map_triplets(edges, values, {"y": F.col("dst") * 2})
    both = map_triplets(edges, values, {"y": F.concat("src_name", "dst_name")})
    assert (joins(none), joins(one), joins(both)) == (0, 1, 2)
    assert "name" not in one._jdf.queryExecution().optimizedPlan().toString().split("LogicalRDD")[0]
    assert rows(both) == [(1, 2, "ab"), (1, 2, "ab"), (2, 3, "bc"), (3, 3, "cc"), (4, 1, "da")]
    assert rows(none) == sorted((s, d, 2 * d) for s, d in EDGES)


def test_lists_of_a_hub(spark):
    hub = spark.range(5_000).selectExpr("cast(7 as bigint) as src", "id as dst")
    edges = hub.union(hub.limit(10)).union(spark.createDataFrame([(8, 1), (8, 1), (8, None)], "src long, dst long"))
    lists = adjacency_lists(edges, max_targets=100, salt_edges=700).collect()
    of_hub = sorted((r["piece"], r["targets"]) for r in lists if r["src"] == 7)
    assert [p for p, _ in of_hub] == list(range(len(of_hub))) and max(len(t) for _, t in of_hub) <= 100
    assert sorted(x for _, t in of_hub for x in t) == list(range(5_000)) and len(of_hub) <= 58
    assert {r["n_targets"] for r in lists if r["src"] == 7} == {5_000}


def test_all_tied_vertices(spark):
    degrees = spark.createDataFrame([(1, 3, 5), (2, 3, 4), (3, 2, 9), (4, 3, 5)], "v long, out_degree long, n_words long")
    assert rows(tied_vertices(degrees)) == [(1, 3, 5, 3), (2, 3, 4, 3), (4, 3, 5, 3)]
    assert tied_vertices(degrees.where("false")).count() == 0


def test_run_goes_on_from_its_last_round(spark, monkeypatch):
    edges = spark.createDataFrame([(i, (i * 7 + 3) % 40) for i in range(60)], "src long, dst long")
    for missing in ("keep", "drop"):
        want = dict(rows(pagerank(edges, iterations=10, missing=missing)))
        name = f"again-{missing}"
        pagerank(edges, iterations=4, missing=missing, name=name)
        with monkeypatch.context() as m:
            # The edges are not derived again.
            m.setattr(PR, "weighted_edges", None)
            got = dict(rows(pagerank(edges, iterations=10, missing=missing, name=name)))
            assert dict(rows(pagerank(edges, iterations=10, missing=missing, name=name))) == got
        assert got == pytest.approx(want)


def test_a_half_written_round_does_not_count(spark):
    edges = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src long, dst long")
    pagerank(edges, iterations=2, name="half")
    import glob
    import os

    base = checkpoint_dir(spark).replace("file:", "")
    (done,) = glob.glob(f"{base}/wordgraph-pagerank-half-*/ranks-2")
    assert is_complete(spark, done)
    os.remove(f"{done}/_SUCCESS")
    got, want = (dict(rows(pagerank(edges, iterations=3, name=n))) for n in ("half", None))
    assert got == pytest.approx(want)


def test_edges_are_not_exchanged_in_a_round(spark):
    edges = spark.range(4000).selectExpr("id % 100 as src", "id as dst")
    cuts = TableCuts(spark, "test")
    weights = PR.bucketed_edges(spark, cuts, "test_edges", 8, lambda: PR.weighted_edges(edges, False))
    sent = spark.range(100).selectExpr("id", "explode(array(0, 1)) as salt", "1.0D as rank")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        round_ = weights.join(sent, (weights.src == sent.id) & (weights.salt == sent.salt))
        plan = round_._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Bucketed: true" in plan
        assert round_.count() == 4000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table test_edges")


def test_row_numbers(spark):
    cuts = TableCuts(spark, "test")
    df = spark.range(1000).selectExpr("id * 7 % 1000 as x")
    assert [r["v"] for r in number_rows(df, [F.col("x").desc()], cuts).orderBy(F.desc("x")).collect()] == list(range(1000))
    assert number_rows(df.where("x < 0"), [F.col("x").asc()], cuts).count() == 0


def test_bag_ids_without_the_driver(spark, tmp_path, monkeypatch):
    folder = tmp_path / "bags"
    folder.mkdir()
    data = {"a b.txt": ["x", "y", "x"], "b": [], "c": ["y", ""], "d": ["x"] * 1000, "e": []}
    for name, lines in data.items():
        (folder / name).write_text("".join(f"{w}\n" for w in lines))
    made = spark.createDataFrame
    monkeypatch.setattr(type(spark), "createDataFrame", lambda *a, **k: pytest.fail("a table made on the driver"))
    vertices, counts = bag_files(spark, str(folder), counts=True)
    assert [r["path"].split("/")[-1].replace("%20", " ") for r in vertices.orderBy("v").collect()] == sorted(data)
    assert rows(counts) == [(0, "x", 2), (0, "y", 1), (2, "", 1), (2, "y", 1), (3, "x", 1000)]
    monkeypatch.setattr(type(spark), "createDataFrame", made)
    only_empty = tmp_path / "none"
    only_empty.mkdir()
    (only_empty / "z").write_text("")
    vertices, words = bag_files(spark, str(only_empty))
    assert vertices.count() == 1 and words.count() == 0
