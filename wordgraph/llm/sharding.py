"""Sharding by a keyed permutation of row numbers (a Feistel network with cycle walking).

Rows are numbered 0 to n-1 in a fixed order. A Feistel network over the grid
``a x a`` with ``a = ceil(sqrt(n))`` permutes the numbers below ``a*a``; a
number that lands at or above n is sent through the network again until it
falls below n (cycle walking), which leaves a permutation of 0 to n-1. The
position decides everything: shard = position mod shards, slot = position
div shards. So the shuffle can be repeated from (seed, n) alone, the place of
a row can be computed without the other rows, and ``row_at`` inverts it.

Only DataFrame functions are used. The law is ``rows``: shard sizes differ by
one row at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordgraph.llm.order import numbered
from wordgraph.session import TableCuts

ROUNDS = 6
#: A Mersenne prime: the round function is an affine map modulo it, twice.
PRIME = 2147483647


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Multipliers and offsets per round, from a small congruential sequence."""
    x, out = (seed * 2654435761 + 12345) % PRIME, []
    for _ in range(rounds):
        three = []
        for _ in range(3):
            x = (x * 48271 + 11) % PRIME
            three.append(x % (PRIME - 2) + 1)
        out.append(tuple(three))
    return out


def _round_value(half: Column, key: Column, side: Column) -> Column:
    """A number below ``side`` from one half and a round's key; all products stay below 2**62."""
    x = (half % PRIME) * key["a"] + key["b"]
    x = (x % PRIME).bitwiseXOR(F.shiftright(x % PRIME, 13))
    return ((x % PRIME) * key["c"] % PRIME) % side


def _keys(seed: int) -> Column:
    return F.array(*[F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).cast("long").alias("b"),
                              F.lit(c).cast("long").alias("c")) for a, b, c in round_keys(seed)])


def _network(x: Column, side: Column, seed: int, inverse: bool) -> Column:
    start = F.struct((x % side).alias("r"), F.floor(x / side).cast("long").alias("l"))
    if not inverse:
        step = lambda s, k: F.struct(
            ((s["l"] + _round_value(s["r"], k, side)) % side).alias("r"), s["r"].alias("l"))
        keys = _keys(seed)
    else:
        step = lambda s, k: F.struct(
            s["l"].alias("r"), ((s["r"] - _round_value(s["l"], k, side) + side) % side).alias("l"))
        keys = F.reverse(_keys(seed))
    return F.aggregate(keys, start, step, lambda s: s["l"] * side + s["r"])


def _side(n: int) -> int:
    return max(1, math.isqrt(max(n - 1, 0)) + 1)


def walk(x: Column, n: int, seed: int, steps: int, inverse: bool = False) -> Column:
    """Up to ``steps`` passes through the network; a number at or above n needs more."""
    side = F.lit(_side(n)).cast("long")
    again = lambda acc, _: F.when(acc < n, acc).otherwise(_network(acc, side, seed, inverse))
    return F.aggregate(F.sequence(F.lit(2), F.lit(max(2, steps))), _network(x, side, seed, inverse), again)


def permuted(df: DataFrame, n: int, seed: int, source: str, target: str, inverse: bool = False,
             steps: int = 8) -> DataFrame:
    """``df`` with ``target``: the permuted ``source``, a number from 0 to n-1.

    Walks longer than ``steps`` are rare (a fraction of about 2/sqrt(n) of the
    numbers needs a second pass at all); whether one is left is checked, and
    then the walks go on from where they were.
    """
    out = df.withColumn(target, walk(F.col(source), n, seed, steps, inverse))
    while out.where(F.col(target) >= n).limit(1).count():
        out = out.withColumn(target, F.when(F.col(target) < n, F.col(target)).otherwise(
            walk(F.col(target), n, seed, steps, inverse)))
    return out


def shard_rows(df: DataFrame, order: list[Column], shards: int, seed: int = 0,
               cuts: TableCuts | None = None) -> DataFrame:
    """``df`` with ``row_no``, ``position``, ``shard`` (int) and ``slot`` (long).

    ``order`` fixes the row numbers; rows equal in it are interchangeable. An
    empty table gives an empty result; repeated rows get places of their own.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    cuts = cuts or TableCuts(df.sparkSession, "shards")
    rows, n = numbered(df, order, cuts)
    placed = permuted(rows, n, seed, "row_no", "position")
    return placed.withColumn("shard", (F.col("position") % shards).cast("int")).withColumn(
        "slot", F.floor(F.col("position") / shards).cast("long"))


def row_at(places: DataFrame, n: int, shards: int, seed: int = 0) -> DataFrame:
    """``row_no`` for each (shard, slot): the inverse of the placement."""
    at = places.withColumn("position", F.col("slot") * shards + F.col("shard"))
    return permuted(at, n, seed, "position", "row_no", inverse=True)
