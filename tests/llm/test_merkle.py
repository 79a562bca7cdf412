"""The Merkle manifest against a tree made by hand, level by level."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from wordgraph.llm import merkle

COLUMNS = ["doc_id", "source", "text"]
ROWS = ([(i, f"s{i % 3}", f"text {i}\nline two\n" if i % 5 else f"text {i}") for i in range(60)]
        + [(i, None, None if i % 2 else "a\nb") for i in range(100, 104)] + [(None, "s1", "no id\n"), (7, "s1", "same id"),
           (7, "s1", "same id"), (200, "é", ""), (201, "only", "x" * 100_000 + "\n"), (202, "", "empty name\n")])


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(field(row[0]), field(row[1]), field(text))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def beside(tree, place):
    out = []
    for level in tree[:-1]:
        first = place // 3 * 3
        out.append((level[first:place], level[place + 1:first + 3]))
        place //= 3
    return out


def tampered(row):
    return zlib.crc32((str(row[0]) if row[0] is not None else "").encode()) % 2 == 0


def brute(rows):
    groups = collections.defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees, ordered = {}, {}
    for name in names:
        ordered[name] = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[2])))
        trees[name] = levels([leaf(r, r[2]) for r in ordered[name]])
    top, out = levels([trees[n][-1][0] for n in names]), []
    for k, name in enumerate(names):
        for i, row in enumerate(ordered[name]):
            steps = beside(trees[name], i) + beside(top, k)
            now = leaf(row, row[2].replace("\n", "") if tampered(row) and row[2] is not None else row[2])
            for left, right in steps:
                now = h(*left, now, *right)
            out.append((row[0], name, trees[name][0][i], trees[name][-1][0], top[-1][0],
                        [x for left, right in steps for x in left + right], now))
    return out, {n: sum(map(len, trees[n])) for n in names}


def leaves(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("pos", F.lit("clash"))
    change = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    odd = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 2 == 0
    return docs.select(F.col("doc_id").alias("key"), F.col("source").alias("tree"), "pos",
                       merkle.leaf_digest(*map(F.col, COLUMNS)).alias("leaf"), F.when(odd, change).alias("changed"))


@pytest.mark.parametrize("height", [1, 2, 6])
def test_proofs_and_versions(spark, height):
    manifest = merkle.build(leaves(spark, ROWS), height=height)
    want, sizes = brute(ROWS)
    got = [tuple(r) for r in manifest.proofs().collect()]
    order = lambda r: (str(r[0]), str(r[1]), r[2], r[5])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert [r["root"] for r in manifest.root().collect()] == [want[0][4]]
    assert {r["tree"]: r["count"] for r in manifest.nodes().groupBy("tree").count().collect()} == sizes
    # A version copies one node per level: its leaf, every ancestor, the last of which is its root.
    copies = collections.defaultdict(list)
    for r in manifest.versions().collect():
        copies[(r["tree"], r["key"])].append((r["level"], r["digest"]))
    folded = {(r[1], r[0]): (r[6], r[5]) for r in want}
    assert set(copies) == {(r[1], r[0]) for r in ROWS if tampered(r)}
    for key in copies:
        nodes = sorted(copies[key])
        if key != ("s1", 7):
            assert nodes[-1][1] == folded[key][0] and [n for n, _ in nodes] == list(range(len(nodes)))


def test_nodes_are_hashes_of_their_children(spark):
    nodes = merkle.build(leaves(spark, ROWS), height=1).nodes()
    held = {(r["tree"], r["level"], r["pos"]): r["digest"] for r in nodes.collect()}
    for (tree, level, pos), value in held.items():
        if level:
            children = [held[(tree, level - 1, 3 * pos + i)] for i in range(3) if (tree, level - 1, 3 * pos + i) in held]
            assert value == h(*children)


def test_lone_leaf_and_empty_table(spark):
    one = merkle.build(leaves(spark, [(5, None, None)]))
    row = one.proofs().first()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["siblings"] == []
    none = merkle.build(leaves(spark, []))
    assert none.proofs().count() == none.nodes().count() == none.versions().count() == none.root().count() == 0
