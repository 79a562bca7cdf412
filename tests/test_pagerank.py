import pytest

from wordgraph import pagerank
from wordgraph.operators.pagerank import weighted_edges

# T_WEB: the nine edges of the reference's sample file.
WEB = [(1, 2), (1, 5), (1, 7), (1, 8), (2, 5), (7, 8), (7, 2), (7, 1), (5, 8)]
WEB_GOLD = {
    1: {1: 0.433333, 2: 0.645833, 5: 1.2125, 7: 0.3625, 8: 1.495833},
    2: {1: 0.252708, 2: 0.344792, 5: 0.791042, 7: 0.242083, 8: 1.375417},
    10: {1: 0.204833, 2: 0.248361, 5: 0.404638, 7: 0.193528, 8: 0.592316},
}
# T_ERODE: parallel edge, self loop, a vertex without in-edge.
ERODE = [(1, 2), (2, 3), (3, 3), (1, 2), (4, 1)]


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "src bigint, dst bigint")


def ranks(df):
    return {r["id"]: r["rank"] for r in df.collect()}


@pytest.mark.parametrize("missing", ["keep", "drop"])
@pytest.mark.parametrize("rounds", [1, 2, 10])
def test_web_goldens(spark, missing, rounds):
    got = ranks(pagerank(edges(spark, WEB), iterations=rounds, missing=missing))
    assert set(got) == set(WEB_GOLD[rounds])
    for k, v in WEB_GOLD[rounds].items():
        assert got[k] == pytest.approx(v, abs=1e-6)


def test_zero_rounds(spark):
    keep = ranks(pagerank(edges(spark, WEB), iterations=0, missing="keep"))
    drop = ranks(pagerank(edges(spark, WEB), iterations=0, missing="drop"))
    assert keep == {1: 1.0, 2: 1.0, 5: 1.0, 7: 1.0, 8: 1.0}
    assert drop == {1: 1.0, 2: 1.0, 5: 1.0, 7: 1.0}


@pytest.mark.parametrize(
    "rounds,keep,drop",
    [
        (1, {1: 1.0, 2: 1.0, 3: 1.85, 4: 1.0}, {1: 1.0, 2: 1.0, 3: 1.85}),
        (2, {1: 1.0, 2: 1.0, 3: 2.5725, 4: 1.0}, {2: 1.0, 3: 2.5725}),
        (3, {1: 1.0, 2: 1.0, 3: 3.186625, 4: 1.0}, {3: 3.186625}),
    ],
)
def test_erosion(spark, rounds, keep, drop):
    k = ranks(pagerank(edges(spark, ERODE), iterations=rounds, missing="keep"))
    d = ranks(pagerank(edges(spark, ERODE), iterations=rounds, missing="drop"))
    assert k == pytest.approx(keep)
    assert d == pytest.approx(drop)


def test_parallel_edges_count_in_keep_form(spark):
    # 1->2 twice and 1->3 once: vertex 2 gets 2/3 of 1's rank.
    e = edges(spark, [(1, 2), (1, 2), (1, 3)])
    k = ranks(pagerank(e, iterations=1, missing="keep"))
    assert k[2] == pytest.approx(0.15 + 0.85 * 2 / 3)
    d = ranks(pagerank(e, iterations=1, missing="drop"))
    assert d[2] == pytest.approx(0.15 + 0.85 * 0.5)


@pytest.mark.parametrize("placement", ["src", "grid", "pair", "mod"])
def test_placement_changes_no_rank(spark, placement):
    base = ranks(pagerank(edges(spark, WEB + ERODE), iterations=5, missing="keep"))
    other = ranks(pagerank(edges(spark, WEB + ERODE), iterations=5, missing="keep", placement=placement,
                           num_partitions=6))
    assert other == pytest.approx(base, abs=1e-12)


def test_salting_changes_no_rank(spark):
    # A hub with many out-edges, split over several salt values.
    hub = [(0, i) for i in range(1, 40)] + [(i, 0) for i in range(1, 40, 3)] + [(5, 7), (7, 9)]
    plain = ranks(pagerank(edges(spark, hub), iterations=4, missing="keep"))
    salted = ranks(pagerank(edges(spark, hub), iterations=4, missing="keep", salt_edges=4))
    assert salted == pytest.approx(plain, abs=1e-12)
    w = weighted_edges(edges(spark, hub), dedupe=False, salt_edges=4)
    assert w.where("src = 0").select("salt").distinct().count() > 1
    plain_d = ranks(pagerank(edges(spark, hub), iterations=4, missing="drop"))
    salted_d = ranks(pagerank(edges(spark, hub), iterations=4, missing="drop", salt_edges=4))
    assert salted_d == pytest.approx(plain_d, abs=1e-12)


def test_string_ids(spark):
    e = spark.createDataFrame([(str(a), str(b)) for a, b in WEB], "src string, dst string")
    got = ranks(pagerank(e, iterations=10, missing="drop"))
    assert got["8"] == pytest.approx(0.592316, abs=1e-6)


def test_empty_and_self_loop_only(spark):
    empty = spark.createDataFrame([], "src bigint, dst bigint")
    assert pagerank(empty, iterations=3).count() == 0
    assert pagerank(empty, iterations=3, missing="drop").count() == 0
    loop = edges(spark, [(1, 1)])
    assert ranks(pagerank(loop, iterations=3, missing="keep")) == pytest.approx({1: 1.0})


@pytest.mark.parametrize("placement", ["src", "pair"])
def test_rounds_hash_the_ranks(spark, monkeypatch, placement):
    # Small ranks were broadcast with all their copies, large ones were sorted with the edges.
    from wordgraph.session import TableCuts

    plans, cut = [], TableCuts.cut

    def seen(self, df, name, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(self, df, name, **options)

    monkeypatch.setattr(TableCuts, "cut", seen)
    pagerank(edges(spark, WEB), iterations=2, placement=placement)
    assert len(plans) == 2
    for plan in plans:
        assert "ShuffledHashJoin" in plan and "BroadcastHashJoin" not in plan and "SortMergeJoin" not in plan
