"""Laws on random bags: every overlap strategy equals brute force; components = union-find."""

import itertools

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import rows
from wordgraph import bag_sizes, components_from_postings, larger_source_edges, neighbor_average, overlap_edges

BAGS = st.dictionaries(
    st.integers(0, 40),
    st.lists(st.sampled_from("abcdefghij") | st.text("xyz", min_size=1, max_size=2), max_size=6),
    min_size=1,
    max_size=14,
)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, data):
    v = spark.createDataFrame([(k,) for k in data], "v bigint")
    p = spark.createDataFrame(sorted({(k, w) for k, ws in data.items() for w in ws}), "v bigint, w string")
    return v, p


def brute(data):
    return {(a, b) for a, b in itertools.permutations(data, 2) if set(data[a]) & set(data[b])}


@SETTINGS
@given(BAGS, st.integers(1, 5), st.integers(0, 3), st.integers(1, 3))
def test_hybrid_equals_brute_force(spark, data, hot, key_bits, cell_rows):
    _, p = frame(spark, data)
    want = brute(data)
    got = set(rows(overlap_edges(p, strategy="hybrid", hot_words=hot, key_bits=key_bits,
                                 cell_rows=cell_rows)))
    assert got == want
    assert set(rows(overlap_edges(p, strategy="plain"))) == want


@SETTINGS
@given(BAGS)
def test_questions_and_components(spark, data):
    v, p = frame(spark, data)
    e = overlap_edges(p)
    sizes = bag_sizes(v, p)
    n = {k: len(set(ws)) for k, ws in data.items()}
    pairs = brute(data)
    assert larger_source_edges(e, sizes).first()["n_edges"] == sum(1 for a, b in pairs if n[a] > n[b])
    und = overlap_edges(p, directed=False)
    assert larger_source_edges(und, sizes, directed=False).first()["n_edges"] == sum(
        1 for a, b in pairs if n[a] > n[b]
    )
    avg = {r["v"]: r["avg_words_exact"] for r in neighbor_average(e, sizes).collect()}
    for a in data:
        nb = [b for x, b in pairs if x == a]
        if nb:
            assert abs(avg[a] - sum(n[b] for b in nb) / len(nb)) < 1e-9
        else:
            assert a not in avg
    parent = {k: k for k in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    want = {k: min(x for x in data if find(x) == find(k)) for k in data}
    got = dict(rows(components_from_postings(v, p)))
    assert got == want


def reference_ranks(pairs, rounds, missing):
    """Plain-Python statement of the two forms (the rules of SURVEY §2.J)."""
    if missing == "drop":
        pairs = sorted(set(pairs))
    out = {}
    for s, _ in pairs:
        out[s] = out.get(s, 0) + 1
    if missing == "keep":
        ranks = {v: 1.0 for e in pairs for v in e}
    else:
        ranks = {s: 1.0 for s, _ in pairs}
    for _ in range(rounds):
        c = {}
        for s, d in pairs:
            if s in ranks:
                c[d] = c.get(d, 0.0) + ranks[s] / out[s]
        if missing == "keep":
            ranks = {v: (0.15 + 0.85 * c[v]) if v in c else r for v, r in ranks.items()}
        else:
            ranks = {v: 0.15 + 0.85 * x for v, x in c.items()}
    return ranks


EDGES = st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), min_size=1, max_size=30)


@SETTINGS
@given(EDGES, st.integers(0, 4), st.sampled_from(["keep", "drop"]), st.sampled_from([None, "grid", "pair", "mod"]),
       st.sampled_from([1, 3, 1 << 20]))
def test_pagerank_equals_reference(spark, pairs, rounds, missing, placement, salt_edges):
    from wordgraph import pagerank

    e = spark.createDataFrame(pairs, "src bigint, dst bigint")
    got = {r["id"]: r["rank"] for r in pagerank(e, iterations=rounds, missing=missing, placement=placement,
                                               num_partitions=6, salt_edges=salt_edges).collect()}
    want = reference_ranks(pairs, rounds, missing)
    assert set(got) == set(want)
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9
