"""Merkle dataset manifest: one persistent tree per group of rows, one root over all.

Leaves of a tree are in the order of their keys; runs of three consecutive
nodes become their parent until one node is left, the tree's subroot. The
subroots, in the order of the trees' names (null first, by UTF-8 bytes), make
one more tree: its last node is the root.

The trees are built in rounds of aligned blocks of 3**6 nodes: a task folds the
blocks it is dealt, and the blocks' tops are the nodes of the next round. A
changed leaf makes a version of its tree by path copying: only its ancestors
are copied, first within its block, then through the upper rounds, where a
version meets nothing but the path above its block. All other nodes are shared
with the base tree, and no two versions meet in one task because they share an
ancestor.

Rows: a null key comes first; rows that repeat a key are leaves of their own,
ordered by their digest; rows of a null tree name are a tree of their own. An
empty table has no leaves, no nodes and no root.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordgraph.llm.order import numbered
from wordgraph.session import TableCuts

FANOUT = 3
#: Levels of a block, which so holds 729 nodes: the most that meet in one row.
BLOCK_LEVELS = 6

_PATH = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values: each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    def written(value: Column) -> Column:
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[written(v) for v in values]), 256)


def fold(nodes: list[str], levels: int | None) -> list[list[str]]:
    """All levels from ``nodes`` up: to a single node, or so many levels up."""
    out = [nodes]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([digest("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
    return out


def path(levels: list[list[str]], place: int) -> list[tuple[str, str]]:
    """Per level below the top, the siblings to the left and to the right of a leaf's ancestor, joined."""
    out = []
    for level in levels[:-1]:
        at, first = place % FANOUT, place - place % FANOUT
        out.append(("".join(level[first:place]), "".join(level[place + 1:first + FANOUT])))
        place = first // FANOUT
    return out


def copied(leaf: str, above: list[tuple[str, str]]) -> list[str]:
    """A version's own nodes: the leaf and its ancestors along a path."""
    out = [leaf]
    for left, right in above:
        out.append(digest(left + out[-1] + right))
    return out


def _pairs(column) -> list:
    return [[(x["left"], x["right"]) for x in p or []] for p in column.to_pylist()]


def _fold_blocks(nodes: DataFrame, height: int) -> DataFrame:
    """``nodes(tree, n, pos, digest, key, changed)``, n nodes in its tree, folded in aligned blocks.

    One row per block: ``tree, n, block, keys, changed, levels, copies, top``; ``copies`` holds, for every
    changed node, its place and the nodes copied for it within the block.
    """
    size = FANOUT**height

    def run(batches):
        for batch in batches:
            out = {name: [] for name in ("keys", "changed", "levels", "copies", "top")}
            for n, members in zip(batch.column("n").to_pylist(), batch.column("members").to_pylist()):
                levels = fold([m["digest"] for m in members], height if n > size else None)
                out["keys"].append([m["key"] for m in members])
                out["changed"].append([m["changed"] for m in members])
                out["levels"].append(levels)
                out["copies"].append([{"place": i, "digests": copied(m["changed"], path(levels, i))}
                                      for i, m in enumerate(members) if m["changed"] is not None])
                out["top"].append(levels[-1][0])
            strings, copies = pa.list_(pa.string()), pa.struct([("place", pa.int32()), ("digests", pa.list_(pa.string()))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("n"), batch.column("block"), pa.array(out["keys"], pa.list_(pa.int64())),
                 pa.array(out["changed"], strings), pa.array(out["levels"], pa.list_(strings)),
                 pa.array(out["copies"], pa.list_(copies)), pa.array(out["top"], pa.string())],
                names=["tree", "n", "block", "keys", "changed", "levels", "copies", "top"])

    # At most ``size`` members per row.
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", "key", "changed"))).alias("members")
    grouped = nodes.groupBy("tree", "n", F.expr(f"pos div {size}").alias("block")).agg(members)
    return grouped.mapInArrow(run, "tree string, n long, block long, keys array<long>, changed array<string>, "
                                   "levels array<array<string>>, "
                                   "copies array<struct<place:int,digests:array<string>>>, top string")


def _climb(nodes: DataFrame, cuts: TableCuts, name: str, height: int) -> list[DataFrame]:
    """The written blocks of every round until each tree has one node."""
    rounds, size = [], FANOUT**height
    while True:
        blocks = cuts.cut(_fold_blocks(nodes, height), f"{name}-{len(rounds)}")
        rounds.append(blocks)
        open_trees = blocks.where(F.col("n") > size)
        if open_trees.isEmpty():
            return rounds
        nodes = open_trees.select("tree", F.expr(f"(n + {size - 1}) div {size}").alias("n"), F.col("block").alias("pos"),
                                  F.col("top").alias("digest"), F.lit(None).cast("long").alias("key"),
                                  F.lit(None).cast("string").alias("changed"))


def _paths_of_nodes(blocks: DataFrame, size: int) -> DataFrame:
    """``tree, pos, path, subroot, root`` of every node of a round whose blocks carry the path above them."""
    def run(batches):
        for batch in batches:
            out = []
            for tree, block, levels, above, subroot, root in zip(
                    *(batch.column(c).to_pylist() for c in ("tree", "block", "levels")), _pairs(batch.column("path")),
                    batch.column("subroot").to_pylist(), batch.column("root").to_pylist()):
                for i in range(len(levels[0])):
                    steps = [{"left": x, "right": y} for x, y in path(levels, i) + above]
                    out.append((tree, block * size + i, steps, subroot, root))
            step = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
            kinds = [pa.string(), pa.int64(), step, pa.string(), pa.string()]
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                             names=["tree", "pos", "path", "subroot", "root"])

    wanted = blocks.select("tree", "block", "levels", "path", "subroot", "root")
    return wanted.mapInArrow(run, f"tree string, pos long, path {_PATH}, subroot string, root string")


class Manifest:
    """A built manifest: the written blocks of all rounds, and what is read from them.

    ``trees``: ``tree, n, subroot`` per tree. ``rounds`` / ``upper``: the blocks of the trees and of the tree
    of subroots, lowest round first.
    """

    def __init__(self, rounds: list[DataFrame], upper: list[DataFrame], trees: DataFrame, height: int = BLOCK_LEVELS):
        self.rounds, self.upper, self.trees, self.height = rounds, upper, trees, height
        self.size = FANOUT**height

    def root(self) -> DataFrame:
        """``root``: one row, none for an empty table."""
        return self.upper[-1].where(F.col("n") <= self.size).select(F.col("top").alias("root"))

    def nodes(self) -> DataFrame:
        """``tree, level, pos, digest``: every node of every tree, leaves at level 0."""
        parts = []
        for i, blocks in enumerate(self.rounds):
            levels = blocks.select("tree", "block", F.posexplode("levels").alias("level", "row"))
            # A block's top is the next round's leaf, unless it is the subroot.
            inner = levels.select("tree", "block", "level", F.posexplode("row").alias("i", "digest"))
            per_block = F.expr(f"cast(power({FANOUT}, {self.height} - level) as long)")
            parts.append(inner.where((F.lit(i) == 0) | (F.col("level") > 0)).select(
                "tree", (F.col("level") + self.height * i).alias("level"),
                (F.col("block") * per_block + F.col("i")).alias("pos"), "digest"))
        return reduce(DataFrame.unionByName, parts)

    def _above(self) -> list[DataFrame]:
        """Per round of the trees, its blocks with the path above their tops, the subroot and the root."""
        above = self.upper[-1].select("*", F.lit(None).cast(_PATH).alias("path"), F.col("top").alias("subroot"),
                                      F.col("top").alias("root"))
        for blocks in reversed(self.upper[:-1]):
            found = _paths_of_nodes(above, self.size).select(F.col("pos").alias("block"), "path", "subroot", "root")
            above = blocks.join(found, "block")
        tops = _paths_of_nodes(above, self.size).select(F.col("pos").alias("tree_no"), F.col("path"), "root")
        ends = self.trees.join(tops, "tree_no").select(F.col("tree").alias("t"), F.lit(0).cast("long").alias("b"), "path", "subroot", "root")
        out: list[DataFrame] = []
        for i, blocks in reversed(list(enumerate(self.rounds))):
            found = ends
            # Blocks of trees that go on lie below nodes of the next round.
            if out:
                lower = _paths_of_nodes(out[0], self.size).select(F.col("tree").alias("t"), F.col("pos").alias("b"), "path", "subroot", "root")
                found = lower.unionByName(ends.join(blocks.where(F.col("n") <= self.size).select(F.col("tree").alias("u")),
                                                    F.expr("t <=> u"), "left_semi"))
            out.insert(0, blocks.join(found, F.expr("tree <=> t and block = b")).drop("t", "b"))
        return out

    def proofs(self) -> DataFrame:
        """``key, tree, leaf, subroot, root, siblings, folded_root`` per leaf.

        ``siblings``: the digests beside the leaf's ancestors, level by level from the leaf to the root, left to
        right. ``folded_root``: the root of the version of a changed leaf; the root for the others.
        """
        def run(batches):
            for batch in batches:
                out = []
                for tree, keys, levels, copies, above, subroot, root in zip(
                        *(batch.column(c).to_pylist() for c in ("tree", "keys", "levels", "copies")),
                        _pairs(batch.column("path")), batch.column("subroot").to_pylist(), batch.column("root").to_pylist()):
                    versions = {c["place"]: c["digests"][-1] for c in copies}
                    for i, key in enumerate(keys):
                        own = path(levels, i)
                        siblings = [s for pair in own + above for s in pair]
                        start, rest = (versions[i], above) if i in versions else (levels[0][i], own + above)
                        out.append((key, tree, levels[0][i], subroot, root, siblings, copied(start, rest)[-1]))
                columns = list(zip(*out)) or [()] * 7
                kinds = [pa.int64(), *[pa.string()] * 4, pa.list_(pa.string()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                    names=["key", "tree", "leaf", "subroot", "root", "joined", "folded_root"])

        wanted = self._above()[0].select("tree", "keys", "levels", "copies", "path", "subroot", "root")
        found = wanted.mapInArrow(run, "key long, tree string, leaf string, subroot string, root string, "
                                       "joined array<string>, folded_root string")
        # Siblings of one side come joined: cut them into digests of 64 characters.
        return found.select("key", "tree", "leaf", "subroot", "root",
                            F.expr("regexp_extract_all(array_join(joined, ''), '.{64}', 0)").alias("siblings"), "folded_root")

    def versions(self) -> DataFrame:
        """``key, tree, level, digest``: the nodes copied for each changed leaf, the leaf at level 0, the last the
        version's root; levels go on through the tree of subroots."""
        def run(batches):
            for batch in batches:
                out = []
                for tree, keys, copies, above in zip(*(batch.column(c).to_pylist() for c in ("tree", "keys", "copies")),
                                                     _pairs(batch.column("path"))):
                    for c in copies:
                        nodes = c["digests"][:-1] + copied(c["digests"][-1], above)
                        out += [(keys[c["place"]], tree, level, node) for level, node in enumerate(nodes)]
                columns = list(zip(*out)) or [()] * 4
                kinds = [pa.int64(), pa.string(), pa.int32(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                                 names=["key", "tree", "level", "digest"])

        return self._above()[0].select("tree", "keys", "copies", "path").mapInArrow(
            run, "key long, tree string, level int, digest string")


def build(leaves: DataFrame, cuts: TableCuts | None = None, height: int = BLOCK_LEVELS) -> Manifest:
    """The manifest of ``leaves(key, tree, leaf, changed)``.

    ``key``: a 64-bit number; ``tree``: the name of the row's tree; ``leaf``: its digest; ``changed``: the
    digest that takes its place in a version of the tree, or null. Other columns are not read. ``height``: the
    levels of a block.
    """
    spark = leaves.sparkSession
    cuts = cuts or TableCuts(spark, "merkle")
    given = leaves.select(F.col("tree").cast("string").alias("tree"), F.col("key").cast("long").alias("key"), "leaf", "changed")
    placed, _ = numbered(given, [F.col("tree").asc(), F.col("key").asc(), F.col("leaf").asc()], cuts, "leaves")
    sizes = placed.groupBy("tree").agg(F.min("row_no").alias("first"), F.count(F.lit(1)).alias("n"))
    # Trees in order: one row per tree, numbered like the rows.
    trees, _ = numbered(sizes, [F.col("tree").asc()], cuts, "trees")
    trees = cuts.cut(trees.withColumnRenamed("row_no", "tree_no"), "tree-numbers")
    named = trees.select(F.col("tree").alias("t"), "first", "n")
    nodes = placed.join(named, F.expr("tree <=> t")).select(
        "tree", "n", (F.col("row_no") - F.col("first")).alias("pos"), F.col("leaf").alias("digest"), "key", "changed")
    rounds = _climb(nodes, cuts, "blocks", height)

    ends = reduce(DataFrame.unionByName, [b.where(F.col("n") <= FANOUT**height).select(F.col("tree").alias("t"), F.col("top").alias("subroot"))
                                          for b in rounds])
    trees = cuts.cut(trees.join(ends, F.expr("tree <=> t")).drop("t", "first"), "subroots")
    number = trees.agg(F.count(F.lit(1))).first()[0]
    tops = trees.select(F.lit(None).cast("string").alias("tree"), F.lit(number).cast("long").alias("n"), F.col("tree_no").alias("pos"),
                        F.col("subroot").alias("digest"), F.lit(None).cast("long").alias("key"), F.lit(None).cast("string").alias("changed"))
    return Manifest(rounds, _climb(tops, cuts, "upper", height), trees, height)
