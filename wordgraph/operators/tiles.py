"""Pairs of bags that share a word, formed tile by tile, so that no pair crosses the network to be made unique.

Bags are dealt to groups; a group is one row, which holds its bags' words and the words' bags. A tile is a group and
itself or a later one, and every pair that is formed here belongs to one tile. A tile's task reads its two groups,
holds nothing of the pairs: a bag's row of the tile is the OR of one bit row per word (lists for words of few bags),
made for ``CHUNK`` bags at a time and given on as pairs, or as sums over them, which are counted from the bits. What is
shuffled are the groups, each once, however many tiles there are: a task fetches the two that it needs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.operators.numbering import number_rows
from wordgraph.session import TableCuts

# Bags (at most 1 << 16) and words of a group at most; bags of a tile's side whose rows are made at once.
GROUP_BAGS, GROUP_WORDS, CHUNK = 1 << 15, 1 << 24, 64
# A word of so many bags of a group gets a bit row, as long as the rows take no more than this.
LIST_BAGS, BITS_BYTES = 64, 1 << 28
# What a tile reads of its first group and of its second.
FORWARD, INDEX = ["sizes", "words"], ["known", "held", "bag"]


def tiled_bags(postings: DataFrame, freq: DataFrame, bags: DataFrame | None, bits: int, prefix_words: int, every: bool,
               carry: list[str], cuts: TableCuts, group_bags: int | None = None) -> DataFrame:
    """One row per tile: what its two groups hold, ``x_...`` and ``y_...``.

    ``postings(v, w)``, ``freq(w, d)`` the words to look at, of which the first ``bits`` have one in the masks ``m``
    of ``bags(v, m, carry...)`` (None: no masks, nothing carried). A table ``postings`` of ``cuts`` is dropped when it was read. Words are numbered like the bits, the most
    frequent first. A long bag has more than ``prefix_words`` words behind them. The tiles have all pairs with a long
    bag, or with ``every`` all pairs.
    """
    spark = postings.sparkSession
    ids = number_rows(freq.select("w", "d"), [F.desc("d"), F.asc("w")], cuts, "word-ids", "id").select("w", F.col("id").cast("int").alias("id"))
    # A word crosses the network once per part of the postings, not with every bag. With many parts hardly two words of a
    # bag are in one, so lists of them are made behind the shuffle only.
    by_word = postings.select("v", "w").where("v is not null").groupBy("w").agg(F.collect_list("v").alias("bags"))
    by_word = cuts.cut(by_word.join(ids, "w").select("id", "bags"), "by-word")
    cuts.drop_named("word-ids", "postings")
    packed = by_word.select("id", F.explode("bags").alias("v")).repartition("v").groupBy("v").agg(
        F.sort_array(F.collect_list("id")).alias("words"))
    packed = packed.withColumn("long", F.size(F.filter("words", lambda x: x >= bits)) > prefix_words)
    zero = F.lit(0).cast("bigint")
    packed = packed.withColumn("m", zero) if bags is None else packed.join(bags, "v", "left").fillna(0, ["m"])
    packed = cuts.cut(packed.select("v", "m", "long", *carry, "words"), "packed")
    cuts.drop_named("by-word")
    first = F.lit(True) if every else F.col("long")
    # Two rows: bags and words, of those of the first groups and of others.
    held = {r["first"]: (r["bags"], r["words"]) for r in packed.groupBy(first.alias("first")).agg(
        F.count(F.lit(1)).alias("bags"), F.sum(F.size("words")).alias("words")).collect()}
    if group_bags is None:
        # Enough tiles for all cores, where there are bags enough.
        apart = (16 * spark.sparkContext.defaultParallelism) ** 0.5
        group_bags = int(min(GROUP_BAGS, max(256, -(-sum(n for n, _ in held.values()) // apart))))
    groups = {k: max(-(-n // group_bags), -(-words // GROUP_WORDS)) for k, (n, words) in held.items()}
    firsts, others = groups.get(True, 0), groups.get(False, 0)
    hashed = F.xxhash64("v")
    group = F.when(first, F.pmod(hashed, F.lit(max(firsts, 1)))).otherwise(F.lit(firsts) + F.pmod(hashed, F.lit(max(others, 1))))
    dealt = packed.withColumn("grp", group.cast("int")).repartitionById(max(firsts + others, 1), F.col("grp"))
    kind = {f.name: f.dataType.simpleString() for f in packed.schema.fields}
    names = ["v", "m", "long", *carry]
    schema = ", ".join(["grp int", *[f"`{c}` array<{kind[c]}>" for c in names], *[f"{c} binary" for c in FORWARD + INDEX]])
    made = cuts.cut(dealt.mapInArrow(_packer(names), schema), "groups")
    cuts.drop_named("packed")
    # A group is one partition, a tile one task with one row.
    x, y = (made.select(*[F.col(c).alias(f"{end}_{c}") for c in ["grp", *names, *parts]]).repartitionById(
        max(firsts + others, 1), F.col(f"{end}_grp")) for end, parts in (("x", FORWARD), ("y", INDEX)))
    return x.where(F.col("x_grp") < firsts).join(
        y.hint("shuffle_replicate_nl"), F.col("x_grp") <= F.col("y_grp"))


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions starts[k], starts[k] + 1, ... (sizes[k] of them), one stretch after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _packer(names: list[str]):
    """All bags of a task as one row: columns as lists, the words by bag and the bags by word as plain numbers."""

    def run(batches):
        read = [b for b in batches if b.num_rows]
        if not read:
            return
        t = pa.Table.from_batches(read)
        if "n" in names:
            t = t.take(pa.array(np.argsort(_plain(t["n"]), kind="stable")))
        n, lists = t.num_rows, t["words"].combine_chunks()
        sizes, words = lists.value_lengths().to_numpy().astype(np.int32), lists.flatten().to_numpy().astype(np.int32)
        order = np.argsort(words, kind="stable")
        known, held = np.unique(words, return_counts=True)
        bag = np.repeat(np.arange(n, dtype=np.uint16), sizes)[order]
        parts = {"sizes": sizes, "words": words, "known": known, "held": held.astype(np.int32), "bag": bag}
        row = [pa.array([t["grp"][0].as_py()], pa.int32())]
        row += [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), t[c].combine_chunks()) for c in names]
        row += [pa.array([parts[c].tobytes()], pa.binary()) for c in FORWARD + INDEX]
        yield pa.RecordBatch.from_arrays(row, ["grp", *names, *FORWARD, *INDEX])

    return run


def _plain(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.to_numpy(zero_copy_only=False).astype(np.int64)


class _Side:
    """A group of a tile: Arrow columns by name, and the parts of its words that were read."""

    def __init__(self, batch: pa.RecordBatch, row: int, end: str):
        of = {c[2:]: batch[c] for c in batch.schema.names if c.startswith(f"{end}_")}
        self.group = of["grp"][row].as_py()
        self.columns = {c: x[row].values for c, x in of.items() if pa.types.is_list(x.type)}
        self.n, self.m = len(self.columns["m"]), _plain(self.columns["m"])
        for c in FORWARD + INDEX:
            if c in of:
                setattr(self, c, np.frombuffer(of[c][row].as_buffer(), np.uint16 if c == "bag" else np.int32))

    def __getitem__(self, name: str) -> np.ndarray:
        return _plain(self.columns[name])


def _tiles(batches) -> Iterator[tuple[_Side, _Side, bool]]:
    """The two sides of each tile, and whether they are the same group."""
    for batch in batches:
        for k in range(batch.num_rows):
            a, b = _Side(batch, k, "x"), _Side(batch, k, "y")
            yield a, b, a.group == b.group


def _times(words: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
    """How often each bag holds each of the words that can have a bit."""
    can = words < 62
    return np.bincount(bag[can].astype(np.int64) * 62 + words[can], minlength=bags * 62).reshape(bags, 62)


def _hot_repeats(m_a: np.ndarray, m_b: np.ndarray, times_a: np.ndarray, times_b: np.ndarray) -> np.ndarray:
    """How often a pair comes where postings repeat: by the postings of the first bit that both have, else once."""
    shared = m_a[:, None] & m_b
    lowest, out = shared & -shared, np.ones(shared.shape, np.int64)
    for bit in np.flatnonzero((times_a > 1).any(0) | (times_b > 1).any(0)):
        out = np.where(lowest == 1 << int(bit), times_a[:, bit, None] * times_b[:, bit], out)
    return out


def _repeats(a: _Side, b: _Side, bits: int):
    """None, or where postings repeat a function of first and last that says how often their pairs come."""
    owner = np.repeat(np.arange(a.n), a.sizes)
    word = np.repeat(np.arange(len(b.known)), b.held)
    twice_a = (a.words[1:] == a.words[:-1]) & (owner[1:] == owner[:-1])
    twice_b = (b.bag[1:] == b.bag[:-1]) & (word[1:] == word[:-1])
    if not (twice_a.any() or twice_b.any()):
        return None
    times_a, times_b = _times(a.words, owner, a.n), _times(b.known[word], b.bag, b.n)
    edge, starts = np.searchsorted(owner, np.arange(a.n + 1)), np.cumsum(b.held) - b.held
    short_a, short_b = a["long"] == 0, b["long"] == 0

    def of(first: int, last: int) -> np.ndarray:
        out = _hot_repeats(a.m[first:last], b.m, times_a[first:last], times_b)
        # Short bags without a common bit come by the first other word that both have, the most frequent first: once
        # for each posting of it that either has, the first of both counted once.
        for k in np.flatnonzero(short_a[first:last]) + first:
            free = short_b & ((a.m[k] & b.m) == 0)
            words, often = np.unique(a.words[edge[k] : edge[k + 1]], return_counts=True)
            for w, x in zip(words[words >= bits], often[words >= bits]):
                at = np.searchsorted(b.known, w)
                if at < len(b.known) and b.known[at] == w:
                    bag, y = np.unique(b.bag[starts[at] : starts[at] + b.held[at]], return_counts=True)
                    new = free[bag]
                    out[k - first, bag[new]] = x + y[new] - 1
                    free[bag] = False
        return out

    return of


def _rows(a: _Side, b: _Side, same: bool, skip: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``first, last, met``: for bags first to last of ``a`` one bit per bag of ``b`` (64 to a number), set if they
    share a word and no bit of ``skip``."""
    width = -(-b.n // 64)
    bag, held = b.bag.astype(np.int64), b.held.astype(np.int64)
    starts = np.cumsum(held) - held
    heavy = np.flatnonzero(held >= LIST_BAGS)
    heavy = heavy[np.argsort(-held[heavy], kind="stable")][: max(BITS_BYTES // (width * 8), 1)]
    bits = np.zeros((len(heavy), width), np.uint64)
    one = np.left_shift(np.uint8(1), np.arange(8, dtype=np.uint8))
    for k in range(0, len(heavy), 1024):
        part = heavy[k : k + 1024]
        at = bag[_ragged(starts[part], held[part])]
        row = np.repeat(np.arange(k, k + len(part)), held[part])
        np.bitwise_or.at(bits.view(np.uint8).reshape(-1), row * (width * 8) + (at >> 3), one[at & 7])

    # Where b has each word of a: a row of bits (from 0) or a list (below).
    place = np.full(max(a.words.max(initial=0), b.known.max(initial=0)) + 1, len(b.known), np.int32)
    place[b.known] = np.arange(len(b.known))
    row_of = np.full(len(b.known) + 1, -1, np.int32)
    row_of[heavy] = np.arange(len(heavy))
    at = place[a.words]
    row = row_of[at]
    owner = np.repeat(np.arange(a.n, dtype=np.int32), a.sizes)
    by_row, listed = row >= 0, (row < 0) & (at < len(b.known))
    rows, row_owner, lists, list_owner = row[by_row], owner[by_row], at[listed], owner[listed]
    edge = np.arange(a.n + 1)
    row_at, list_at = np.searchsorted(row_owner, edge), np.searchsorted(list_owner, edge)
    low_a, low_b, apart = a.m & skip, b.m & skip, {}
    for first in range(0, a.n, CHUNK):
        last = min(first + CHUNK, a.n)
        met = np.zeros((last - first, width), np.uint64)
        for k in range(first, last):
            if row_at[k] < row_at[k + 1]:
                np.bitwise_or.reduce(bits[rows[row_at[k] : row_at[k + 1]]], axis=0, out=met[k - first])
        flat = met.view(np.uint8).reshape(-1)
        few = slice(list_at[first], list_at[last])
        size = held[lists[few]]
        at = bag[_ragged(starts[lists[few]], size)]
        np.bitwise_or.at(flat, np.repeat((list_owner[few] - first).astype(np.int64) * (width * 8), size) + (at >> 3), one[at & 7])
        if skip:
            for k, low in enumerate(low_a[first:last].tolist()):
                if low not in apart:
                    apart[low] = _packed((low & low_b) == 0)
                met[k] &= apart[low]
        if same:
            own = np.arange(first, last)
            flat.reshape(last - first, -1)[own - first, own >> 3] &= ~one[own & 7]
        yield first, last, met


def _packed(flags: np.ndarray) -> np.ndarray:
    """One bit per flag, 64 to a number."""
    out = np.zeros(-(-len(flags) // 64) * 8, np.uint8)
    bits = np.packbits(flags, bitorder="little")
    out[: len(bits)] = bits
    return out.view(np.uint64)


def _unpacked(met: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(met.view(np.uint8), axis=1, bitorder="little", count=n)


def _digits(weight: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Powers of two, and the bags whose weight has them."""
    return [(1 << k, _packed((weight >> k) & 1)) for k in range(int(weight.max(initial=0)).bit_length())]


def _weighed(met: np.ndarray, digits: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Per row the sum of the weights of the bits that are set."""
    out = np.zeros(len(met), np.int64)
    for power, flags in digits:
        out += power * np.bitwise_count(met & flags).sum(axis=1, dtype=np.int64)
    return out


def tiled_pairs(tiles: DataFrame, carry: list[str], skip: int, once: bool, bits: int) -> DataFrame:
    """``src, dst`` and the carried columns of both ends, in both directions or ``once`` per pair."""
    names = ["v", *carry]
    kind = {f.name: f.dataType.elementType.simpleString() for f in tiles.schema.fields if hasattr(f.dataType, "elementType")}
    out = [("src", "dst"), *[(f"{c}s", f"{c}d") for c in carry]]
    heads = [c for both in out for c in both]

    def run(batches):
        for a, b, same in _tiles(batches):
            ends, often = [(a.columns[c], b.columns[c]) for c in names], _repeats(a, b, bits)
            for first, last, met in _rows(a, b, same, skip):
                met = _unpacked(met, b.n)
                i, j = np.nonzero(met)
                if often is not None:
                    times = often(first, last)[i, j]
                    i, j = np.repeat(i, times), np.repeat(j, times)
                if same and once:
                    up = first + i < j
                    i, j = i[up], j[up]
                i, j = pa.array(i + first), pa.array(j)
                taken = [(x.take(i), y.take(j)) for x, y in ends]
                yield pa.RecordBatch.from_arrays([x for both in taken for x in both], heads)
                if not (same or once):
                    yield pa.RecordBatch.from_arrays([x for both in taken for x in both[::-1]], heads)

    schema = ", ".join(f"{x} {kind[f'x_{c}']}" for c, both in zip(names, out) for x in both)
    return tiles.mapInArrow(run, schema)


def tiled_totals(tiles: DataFrame, skip: int, bits: int) -> DataFrame:
    """``v, k2, total2`` per bag and tile: its neighbours there (``c`` of each), and their words (``n``)."""
    kind = {f.name: f.dataType for f in tiles.schema.fields}["x_v"].elementType.simpleString()

    def run(batches):
        for a, b, same in _tiles(batches):
            weights = [np.stack([x["c"], x["c"] * x["n"]], 1) for x in (a, b)]
            of_a, of_b = np.zeros((a.n, 2), np.int64), np.zeros((b.n, 2), np.int64)
            often, digits = _repeats(a, b, bits), [_digits(weights[1][:, k]) for k in (0, 1)]
            # Sums of so many whole numbers are exact in a float of that size.
            exact = np.float32 if CHUNK * weights[0].max(initial=0) < 1 << 24 else np.float64
            for first, last, met in _rows(a, b, same, skip):
                if often is None:
                    for k in (0, 1):
                        of_a[first:last, k] = _weighed(met, digits[k])
                    if not same:
                        of_b += (weights[0][first:last].T.astype(exact) @ _unpacked(met, b.n).astype(exact)).T.astype(np.int64)
                else:
                    met = _unpacked(met, b.n) * often(first, last)
                    of_a[first:last] = met @ weights[1]
                    if not same:
                        of_b += met.T @ weights[0][first:last]
            for side, sums in ((a, of_a), (b, of_b)):
                some = np.flatnonzero(sums[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [side.columns["v"].take(pa.array(some)), *[pa.array(sums[some, k]) for k in (0, 1)]], ["v", "k2", "total2"])

    return tiles.mapInArrow(run, f"v {kind}, k2 bigint, total2 bigint")


def tiled_differing(tiles: DataFrame, skip: int, bits: int) -> DataFrame:
    """``x`` per tile: the pairs (``c`` times ``c`` of each) whose ``n`` differ."""

    def run(batches):
        for a, b, same in _tiles(batches):
            weight, own, n_a, n_b = b["c"], a["c"], a["n"], b["n"]
            often, digits, other, x = _repeats(a, b, bits), _digits(weight), {}, 0
            for first, last, met in _rows(a, b, same, skip):
                for k, n in enumerate(n_a[first:last].tolist()):
                    if n not in other:
                        other = {n: _packed(n_b != n)}  # bags come by their size
                    met[k] &= other[n]
                sums = _weighed(met, digits) if often is None else (_unpacked(met, b.n) * often(first, last)) @ weight
                x += int(sums @ own[first:last])
            yield pa.RecordBatch.from_arrays([pa.array([x // 2 if same else x], pa.int64())], ["x"])

    return tiles.mapInArrow(run, "x bigint")
