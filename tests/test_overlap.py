import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wordgraph import (
    bag_sizes,
    component_sizes,
    components_from_edges,
    components_from_postings,
    largest_component,
    larger_source_edges,
    most_popular_vertex,
    most_popular_word,
    neighbor_average,
    overlap_edges,
    word_presence,
)

# T_BAGS8: lines per file, ids 0-7 by name order.
BAGS8 = {
    0: ["apple", "banana", "apple", "cherry"],
    1: ["apple", "date"],
    2: ["date", "egg", "fig", "egg"],
    3: ["zebra"],
    4: [],
    5: ["kiwi lime", "kiwi"],
    6: ["kiwi", ""],
    7: ["apple", "Apple"],
}
BAGS4 = {0: ["a", "b"], 1: ["a"], 2: ["c", "d", "e"], 3: ["c"]}


def bags(spark, data):
    vertices = spark.createDataFrame([(v,) for v in data], "v bigint")
    lines = spark.createDataFrame([(v, w) for v, ws in data.items() for w in ws], "v bigint, w string")
    postings = lines.distinct()
    counts = lines.groupBy("v", "w").agg(F.count(F.lit(1)).alias("c"))
    return vertices, postings, counts


def brute_edges(data):
    out = set()
    for a, b in itertools.permutations(data, 2):
        if set(data[a]) & set(data[b]):
            out.add((a, b))
    return out


STRATS = [
    dict(strategy="plain"),
    dict(strategy="hybrid"),
    dict(strategy="hybrid", hot_words=2, cell_rows=1, key_bits=1),
    dict(strategy="hybrid", hot_words=3, cell_rows=2, key_bits=0),
]


@pytest.mark.parametrize("kw", STRATS)
def test_edges_equal_brute_force(spark, kw):
    for data in (BAGS8, BAGS4):
        _, p, _ = bags(spark, data)
        got = set(rows(overlap_edges(p, **kw)))
        assert got == brute_edges(data)


def test_bags8_goldens(spark):
    v, p, c = bags(spark, BAGS8)
    e = overlap_edges(p)
    sizes = bag_sizes(v, p)
    assert e.count() == 10
    assert larger_source_edges(e, sizes).first()["n_edges"] == 3
    assert dict(rows(e.groupBy("src").count())) == {0: 2, 1: 3, 2: 1, 5: 1, 6: 1, 7: 2}
    assert rows(most_popular_vertex(e, sizes)) == [(1, 3, 2)]
    avg = {r["v"]: (r["avg_words"], r["avg_words_exact"]) for r in neighbor_average(e, sizes).collect()}
    assert {k: a for k, (a, _) in avg.items()} == {0: 2.0, 1: 2.0, 2: 2.0, 5: 2.0, 6: 2.0, 7: 2.0}
    assert avg[1][1] == pytest.approx(8 / 3)
    assert avg[7][1] == pytest.approx(2.5)
    assert rows(most_popular_word(c, "count")) == [("apple", 4)]
    assert rows(most_popular_word(c, "word")) == [("zebra", 1)]
    assert rows(word_presence(c, "count"), "w", "n_vertices") == [("apple", 3)]
    assert rows(word_presence(c, "word"), "w", "n_vertices") == [("zebra", 1)]
    labels = components_from_postings(v, p)
    assert dict(rows(component_sizes(labels))) == {0: 4, 5: 2, 3: 1, 4: 1}
    assert rows(largest_component(labels)) == [(0, 4)]
    assert dict(rows(sizes))[4] == 0


@pytest.mark.parametrize("hub_rows", [0, 2, 3, 5])
def test_hubs_change_no_component(spark, hub_rows):
    # A word of many bags, a hub of the least and one of the greatest id, and paths between.
    pairs = [(0, i) for i in range(1, 20)] + [(100, i) for i in range(30, 50)] + [(i, i + 1) for i in range(60, 70)]
    pairs += [(20, 19), (100, 60), (80, 81), (81, 82)]
    e = spark.createDataFrame(pairs, "src bigint, dst bigint")
    v = spark.createDataFrame([(90,), (0,)], "v bigint")
    want = dict(rows(components_from_edges(v, e, hub_rows=10**6)))
    assert dict(rows(components_from_edges(v, e, hub_rows=hub_rows))) == want
    assert {want[x] for x in (0, 19, 20)} == {0} and {want[x] for x in (30, 49, 60, 70, 100)} == {30}
    assert want[82] == 80 and want[90] == 90
    data = [(i, w) for i in range(40) for w in (f"a{i // 20}", f"b{i % 7}" if i < 20 else "c")]
    p = spark.createDataFrame(data + [(50, "d"), (51, "d")], "v bigint, w string")
    got = dict(rows(components_from_postings(p.select("v"), p, hub_rows=hub_rows)))
    assert got == {**{i: 0 for i in range(20)}, **{i: 20 for i in range(20, 40)}, 50: 50, 51: 50}


def test_rows_of_a_hub_are_not_dealt_by_key(spark, monkeypatch):
    from wordgraph.operators import components as C

    rows_of = spark.range(1, 1001).selectExpr("id % 4 * (id % 2) as u", "id as v")
    monkeypatch.setattr(C, "HUB_ROWS", 10)
    hub = C._hub_rows(1000)
    joined = C._with_least(rows_of, C._least(rows_of), hub, 1000)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan and joined.count() == 1000
    assert joined.groupBy("u").agg(F.max("m")).count() == 3
    assert C._hub_rows(10**8) == 10**5


def test_bags4_ties(spark):
    v, p, c = bags(spark, BAGS4)
    e = overlap_edges(p)
    sizes = bag_sizes(v, p)
    assert e.count() == 4
    assert larger_source_edges(e, sizes).first()["n_edges"] == 2
    assert rows(most_popular_vertex(e, sizes)) == [(2, 1, 3)]
    avg = {r["v"]: r["avg_words"] for r in neighbor_average(e, sizes).collect()}
    assert avg == {0: 1.0, 1: 2.0, 2: 1.0, 3: 3.0}
    assert rows(most_popular_word(c, "count")) == [("a", 2)]
    assert rows(most_popular_word(c, "word")) == [("e", 1)]
    assert rows(word_presence(c, "count"), "n_vertices") == [(2,)]
    assert rows(largest_component(components_from_postings(v, p))) == [(0, 2)]


def test_edges_symmetric_and_undirected(spark):
    _, p, _ = bags(spark, BAGS8)
    e = set(rows(overlap_edges(p)))
    assert e == {(b, a) for a, b in e}
    und = set(rows(overlap_edges(p, directed=False)))
    assert und == {(a, b) for a, b in e if a < b}


def test_no_edges_gives_empty_answers(spark):
    v, p, c = bags(spark, {0: ["x"], 1: ["y"]})
    e = overlap_edges(p)
    sizes = bag_sizes(v, p)
    assert e.count() == 0
    assert larger_source_edges(e, sizes).first()["n_edges"] == 0
    assert most_popular_vertex(e, sizes).count() == 0
    assert neighbor_average(e, sizes).count() == 0


@pytest.mark.parametrize("kw", STRATS[:4])
def test_carried_sizes_equal_joined_sizes(spark, kw):
    from wordgraph import overlap_graph, triplets

    for data in (BAGS8, BAGS4):
        v, p, _ = bags(spark, data)
        sizes = bag_sizes(v, p)
        carried = overlap_edges(p, with_sizes=True, **kw)
        joined = triplets(overlap_edges(p, **kw), sizes.withColumnRenamed("n", "x"), "x", "ns", "nd")
        assert rows(carried, "src", "dst", "ns", "nd") == rows(joined, "src", "dst", "ns", "nd")
        g = overlap_graph(v, p, **kw)
        assert rows(g.edges, "src", "dst", "ns", "nd") == rows(joined, "src", "dst", "ns", "nd")


@pytest.mark.parametrize("strategy", ["plain", "hybrid"])
def test_empty_postings(spark, strategy):
    p = spark.createDataFrame([], "v bigint, w string")
    assert overlap_edges(p, strategy=strategy).count() == 0
    assert overlap_edges(p, strategy=strategy, with_sizes=True).count() == 0


def test_single_word_everywhere_hybrid(spark):
    # One word in every bag: all pairs, each exactly once, over several cells.
    data = {i: ["w"] for i in range(12)}
    _, p, _ = bags(spark, data)
    got = rows(overlap_edges(p, strategy="hybrid", cell_rows=3))
    assert len(got) == 12 * 11 and set(got) == brute_edges(data)


def test_totals_without_hot_pairs(spark):
    """Counts by masks equal the brute force, with ties, single words, and an empty table."""
    import random

    from wordgraph.operators.overlap import larger_source_count, neighbor_totals

    rng = random.Random(5)
    for n_bags, bits in ((14, 2), (14, 8), (1, 8), (0, 2)):
        bags = {v: {min(int(rng.expovariate(0.3)), 9) for _ in range(rng.randint(1, 4))} for v in range(n_bags)}
        p = spark.createDataFrame([(v, w) for v, ws in bags.items() for w in ws], "v bigint, w bigint")
        near = {v: [u for u in bags if u != v and bags[u] & bags[v]] for v in bags}
        want = sorted((v, len(bags[v]), len(us), sum(len(bags[u]) for u in us)) for v, us in near.items() if us)
        assert rows(neighbor_totals(p, count_bits=bits, hot_words=3, cell_rows=3, key_bits=1), "v", "n", "k", "total") == want
        larger = sum(len(bags[v]) > len(bags[u]) for v, us in near.items() for u in us)
        assert rows(larger_source_count(p, count_bits=bits, hot_words=3, cell_rows=3, key_bits=1)) == [(larger,)]


@pytest.mark.parametrize("prefix", [0, 3])
@pytest.mark.parametrize("share", [0.0, 2.0])
def test_each_pair_once_whatever_the_prefix(spark, prefix, share):
    """Bags longer and shorter than the prefix, with and without words that get a bit."""
    import random

    from wordgraph.operators import overlap as O
    from wordgraph.session import TableCuts

    rng = random.Random(prefix)
    data = {v: {f"w{min(int(rng.expovariate(0.2)), 25)}" for _ in range(rng.randint(0, 9))} for v in range(40)}
    _, p, _ = bags(spark, data)
    cuts = TableCuts(spark, "test")
    prepared = O._prepared(p, p.select("v"), cuts, 5, 7, 2, 3, share, share)
    got = rows(O._pairs(prepared, cuts, [], 7, prefix))
    assert len(got) == len(set(got)) and set(got) == brute_edges(data)


def test_no_distinct_over_pairs(spark):
    _, p, _ = bags(spark, {v: [f"w{v % 7}", f"x{v % 5}", f"y{v % 3}"] for v in range(60)})
    plan = overlap_edges(p)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Distinct" not in plan


def test_equal_bags_form_no_pairs(spark):
    """10,000 equal bags are one class: their neighbours are counted, the pair set is that of the classes."""
    from wordgraph.operators import overlap as O
    from wordgraph.session import TableCuts

    same = spark.range(10_000).selectExpr("id as v", "explode(array('a', 'b', 'c')) as w")
    more = spark.createDataFrame([(20_000, "a"), (20_001, "z"), (20_002, "z"), (20_003, "alone")], "v bigint, w string")
    p = same.union(more)
    want = {(3, 10_000, 9_999 * 3 + 1): 10_000, (1, 10_000, 30_000): 1, (1, 1, 1): 2}
    for share in (0.0, 2.0):
        got = O.neighbor_totals(p, key_share=share, hot_share=share)
        assert {(r["n"], r["k"], r["total"]): r["count"] for r in got.groupBy("n", "k", "total").count().collect()} == want
        assert rows(O.larger_source_count(p, key_share=share, hot_share=share)) == [(10_000,)]
    cuts = TableCuts(spark, "test")
    _, classes, post = O._classes(p, cuts)
    prepared = O._prepared(post, classes, cuts, 62, 4096, 4)
    assert O._pairs(prepared, cuts, [], 4096, 32).count() == 2 and classes.count() == 4


def _long_and_short_bags():
    """Long bags of rare words, short ones, words that most bags hold, and a bag alone."""
    import random

    rng = random.Random(11)
    data = {v: {f"w{rng.randrange(9000)}" for _ in range(60)} | {f"c{k}" for k in range(5) if rng.random() < 0.3} for v in range(110)}
    data |= {v: {f"w{rng.randrange(300)}" for _ in range(rng.randint(1, 4))} | {"c0"} for v in range(110, 170)}
    # Words of two bags, so that most of a long bag's words count.
    for v in range(0, 100, 2):
        data[v] |= {f"x{v}-{k}" for k in range(40)}
        data[v + 1] |= {f"x{v}-{k}" for k in range(40)}
    return data | {170: {"alone"}}


def test_pairs_of_long_bags_are_not_shuffled(spark):
    """Only bags cross the network: no pair is made unique."""
    _, p, _ = bags(spark, _long_and_short_bags())
    plan = overlap_edges(p)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Distinct" not in plan


@pytest.mark.parametrize("group, share", [(1 << 15, 1 / 512), (40, 1 / 512), (40, 2.0)])
def test_tiles_equal_brute_force(spark, monkeypatch, group, share):
    """One tile and many, with and without words that get a bit; each pair comes once in each direction."""
    from wordgraph.operators import overlap as O
    from wordgraph.operators import tiles

    monkeypatch.setattr(tiles, "GROUP_BAGS", group)
    data = _long_and_short_bags()
    _, p, _ = bags(spark, data)
    want = brute_edges(data)
    got = rows(overlap_edges(p, with_sizes=True))
    assert len(got) == len(want) and set(got) == {(a, b, len(data[a]), len(data[b])) for a, b in want}
    near = {v: [b for b in data if (v, b) in want] for v in data}
    totals = sorted((v, len(data[v]), len(us), sum(len(data[u]) for u in us)) for v, us in near.items() if us)
    kw = dict(hot_share=share, key_share=share)
    assert rows(O.neighbor_totals(p, **kw), "v", "n", "k", "total") == totals
    larger = sum(len(data[a]) > len(data[b]) for a, b in want)
    assert rows(O.larger_source_count(p, **kw)) == [(larger,)]


def test_blocks_of_a_word_are_bounded(spark):
    """A posting is copied once per block: copies must not grow with the square of a word's bags."""
    from wordgraph.operators.overlap import hot_word_table

    p = spark.range(20_000).selectExpr("id as v", "'a' as w")
    assert hot_word_table(p, cell_rows=1).first()["blocks"] <= 32


def test_repeated_postings_of_long_bags(spark):
    """A pair comes as often as the postings of its first word with a bit say."""
    data = _long_and_short_bags()
    _, p, _ = bags(spark, data)
    twice = p.union(p.where("v in (3, 4, 120)"))
    got = rows(overlap_edges(twice, hot_words=5))
    assert set(got) == brute_edges(data)
    hot = {f"c{k}" for k in range(5)}
    held = {w: sum(w in ws for ws in data.values()) + sum(w in data[v] for v in (3, 4, 120)) for w in hot}
    for a, b in ((3, 4), (3, 5), (120, 3)):
        if data[a] & data[b] & hot:
            assert max(held.values()) > 40 and got.count((a, b)) == (4 if {a, b} <= {3, 4, 120} else 2)


def test_lists_are_compared_only_with_a_common_mark(spark):
    """Pairs of bags that share several words come once, and the lists are looked at behind the marks."""
    draw = random.Random(5)
    bags = {v: set(draw.sample(range(40), draw.randint(1, 6))) for v in range(60)}
    p = spark.createDataFrame([(v, w) for v, ws in bags.items() for w in ws], "v long, w long")
    found = overlap_edges(p, hot_words=0)
    want = sorted((a, b) for a in bags for b in bags if a != b and bags[a] & bags[b])
    assert sorted((r["src"], r["dst"]) for r in found.collect()) == want
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"marks#\d+L? & marks2#\d+L?\) = 0\) OR NOT arrays_overlap", plan)


@pytest.mark.parametrize("group, share", [(1 << 15, 2.0), (50, 1 / 512)])
def test_dense_bags_are_formed_in_tiles(spark, monkeypatch, group, share):
    """All pairs in tiles: the same pairs, sums and, where postings repeat, the same repeats as from the joins."""
    from wordgraph.operators import overlap as O
    from wordgraph.operators import tiles

    monkeypatch.setattr(tiles, "GROUP_BAGS", group)
    rng = random.Random(3)
    data = {v: {min(int(rng.expovariate(0.05)), 90) for _ in range(rng.randint(1, 45))} for v in range(150)}
    once = [(v, w) for v, ws in data.items() for w in ws] + [(None, 1), (None, 2)]
    twice = once + [(v, w) for v, w in once if v is not None and v % 5 == 0]
    kw = dict(hot_share=share, key_share=share)
    for rows_of in (once, twice):
        p = spark.createDataFrame(rows_of, "v long, w long")
        found = []
        for least in (1 << 60, 0):
            monkeypatch.setattr(O, "DENSE_BAGS", least)
            edges = overlap_edges(p, with_sizes=True, prefix_words=12, cell_rows=30)
            assert ("arrays_overlap" in edges._jdf.queryExecution().optimizedPlan().toString()) == (least > 0)
            found.append((rows(edges), rows(O.neighbor_totals(p, prefix_words=12, **kw), "v", "n", "k", "total"),
                          rows(O.larger_source_count(p, prefix_words=12, **kw))))
        assert found[0] == found[1]
        assert {(a, b) for a, b, *_ in found[1][0]} == brute_edges(data)


def test_a_group_is_shuffled_once(spark, monkeypatch):
    """However many tiles there are, a bag's words cross the network once for each side."""
    from wordgraph.operators import overlap as O
    from wordgraph.operators import tiles

    monkeypatch.setattr(tiles, "GROUP_BAGS", 20)
    monkeypatch.setattr(O, "DENSE_BAGS", 0)
    data = {v: {0, 1 + v % 2} for v in range(200)}
    data |= {v: {v} for v in range(200, 203)}
    _, p, _ = bags(spark, {v: [f"w{w}" for w in ws] for v, ws in data.items()})
    edges = overlap_edges(p)
    plan = edges._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert edges.rdd.getNumPartitions() >= 55
    assert set(rows(edges)) == brute_edges(data)


def test_triplets_of_overlaps_shuffle_no_edge(spark):
    """Attributes go to the postings; missing ones drop edges, repeated ones repeat them, as after the edges."""
    from wordgraph import triplets

    data = {v: [f"w{v % 9}", f"x{v % 4}", f"y{v}", f"y{v + 1}"] for v in range(40)}
    _, p, _ = bags(spark, data)
    attrs = spark.createDataFrame([(v, v * 10) for v in range(38)] + [(5, 7), (None, 3), (99, 1)], "v long, x long")
    for kw in (dict(attr=1, hot_words=0), dict(hot_words=2, cell_rows=5, directed=False, with_sizes=True), dict(prefix_words=1)):
        edges = overlap_edges(p, **kw)
        got = triplets(edges, attrs, "x")
        want = edges.join(attrs.select(F.col("v").alias("src"), F.col("x").alias("src_x")), "src").join(
            attrs.select(F.col("v").alias("dst"), F.col("x").alias("dst_x")), "dst").select(*edges.columns, "src_x", "dst_x")
        assert got.columns == want.columns and rows(got) == rows(want)
        if "prefix_words" not in kw:
            plan = got._jdf.queryExecution().optimizedPlan().toString()
            assert "shuffle_hash" not in plan and not re.search(r"Join Inner, \((src|dst)#", plan)
