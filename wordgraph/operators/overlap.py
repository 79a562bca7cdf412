"""The word-overlap graph — bags that share at least one word.

The reference forms every pair of bags and intersects their word sets. Here
the graph comes from the postings ``(v, w)`` through an inverted-index equi
join on the word, so only bags that really share a word meet.

Two exact strategies:

* ``plain`` — self join of the postings on ``w`` and ``distinct``. A pair
  that shares k words is produced k times before ``distinct``; the cost is
  Σ df² joined rows (df = bags per word).
* ``hybrid`` — every pair is emitted at one word only, the first it shares in
  one order of all words (most bags first), so no pair crosses the network to
  be made unique.

  - hot branch: words with a large share of Σ df² (``hot_share``; at most 62,
    none where words are even) each get one bit; a bag's mask is the OR of
    the bits of its hot words. A pair is kept at its *lowest* shared bit. The
    postings of a hot word are split into B blocks by a hash of the bag id
    (B grows with df), and a pair of blocks is one cell: a word held by a
    third of all bags is spread over B² tasks instead of one.
  - rare branch: the remaining words (df >= 2), block split the same way.
    A posting carries the rare words that its bag has before it in the order;
    a pair is kept if no hot word is shared and these lists have nothing in
    common.
  - long bags: bags of more than ``prefix_words`` rare words carry no lists
    (they would grow with the square of the bag) and stay out of the other
    branches: all pairs with such a bag are formed in tiles of bags
    (``tiles.py``), of which only the bags are shuffled, never the pairs.
  - dense bags: where the joins would look at more pairs than there are pairs
    of bags (Σ df² of at least n², as in texts), all pairs are formed in tiles and there
    are no other branches.
  - key bits: hot words of a still larger share (``key_share``) are part of
    the join key — one side keys a row by its own bits, the other emits every
    subset of the bits it lacks — so pairs that share one of those words
    never meet in the branch that must drop them.

  The branches are disjoint, so their union is the edge set.

``hybrid`` is the default at every size; ``plain`` is a plain statement for
tests. With ``with_sizes`` both end sizes travel with each pair (taken from the postings
before the join), so questions on sizes aggregate pairs where they are formed.

``neighbor_totals`` and ``larger_source_count`` answer from fewer pairs still:
bags with equal words are one class with a count, and neighbours through the
words of the largest shares are counted by masks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from math import isqrt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordgraph.operators.graph import Graph
from wordgraph.operators.tiles import tiled_bags, tiled_differing, tiled_pairs, tiled_totals
from wordgraph.session import TableCuts

MAX_BITS = 62  # bits 0..61 keep every mask a non-negative bigint
# Shares of the sum of df² from which a word gets a bit, and a place in the
# join key or the counts by mask.
HOT_SHARE, KEY_SHARE = 1 / 512, 1 / 64
PREFIX_WORDS = 32
# Fewer bags are joined, however dense they are.
DENSE_BAGS = 1 << 12


def _bit(col: str) -> F.Column:
    """``1L << col`` for a column holding the bit number."""
    return F.expr(f"shiftleft(cast(1 as bigint), `{col}`)")


def bag_sizes(vertices: DataFrame, postings: DataFrame) -> DataFrame:
    """``v, n`` = distinct words per bag; 0 for an empty bag."""
    n = postings.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    return vertices.select("v").join(n, "v", "left").select(
        "v", F.coalesce(F.col("n"), F.lit(0).cast("bigint")).alias("n")
    )


def word_frequencies(postings: DataFrame) -> DataFrame:
    """``w, d`` = number of bags that hold the word (postings are unique on (v, w))."""
    return postings.groupBy("w").agg(F.count(F.lit(1)).alias("d"))


def _plain(postings: DataFrame, with_sizes: bool = False) -> DataFrame:
    if with_sizes:
        n = postings.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        postings = postings.join(n, "v")
        a = postings.select(F.col("w"), F.col("v").alias("src"), F.col("n").alias("ns"))
        b = postings.select(F.col("w"), F.col("v").alias("dst"), F.col("n").alias("nd"))
        cols = ["src", "dst", "ns", "nd"]
    else:
        a = postings.select(F.col("w"), F.col("v").alias("src"))
        b = postings.select(F.col("w"), F.col("v").alias("dst"))
        cols = ["src", "dst"]
    return a.join(b, "w").where(F.col("src") != F.col("dst")).select(*cols).distinct()


def hot_word_table(postings: DataFrame, hot_words: int = MAX_BITS, cell_rows: int = 4096) -> DataFrame:
    """``w, bit, d, blocks``: the most frequent words (df >= 2), at most ``hot_words`` <= 62 rows.

    ``bit`` 0 is the most frequent word (ties by word). ``blocks`` =
    ceil(df / cell_rows), up to a number that hangs on the shuffle partitions:
    each hot word's postings are split in that many blocks per side of the join.
    The table is bounded by construction (``limit``), so it is broadcast.
    """
    return _hot_from_freq(word_frequencies(postings).where("d >= 2"), hot_words, cell_rows)


def _hot_from_freq(freq: DataFrame, hot_words: int, cell_rows: int) -> DataFrame:
    k = min(int(hot_words), MAX_BITS)
    top = freq.orderBy(F.desc("d"), F.asc("w")).limit(k)
    # At most k rows: one window partition over them is bounded.
    ranked = top.withColumn("bit", F.row_number().over(Window.orderBy(F.desc("d"), F.asc("w"))) - 1)
    return ranked.select(
        "w",
        F.col("bit").cast("int").alias("bit"),
        "d",
        _blocks(F.col("d"), cell_rows).alias("blocks"),
    )


def bag_masks(postings: DataFrame, hot: DataFrame) -> DataFrame:
    """``v, m``: OR of the bits of the hot words in each bag (bags without one are absent)."""
    return (
        postings.join(F.broadcast(hot.select("w", "bit")), "w")
        .groupBy("v")
        .agg(F.bit_or(_bit("bit")).alias("m"))
    )


def _low(col: str, nbits: str) -> F.Column:
    return F.expr(f"`{col}` & (shiftleft(cast(1 as bigint), `{nbits}`) - 1)")


def _subsets_avoiding(col: str, nbits: str) -> F.Column:
    return F.expr(
        f"filter(sequence(cast(0 as bigint), shiftleft(cast(1 as bigint), `{nbits}`) - 1), "
        f"x -> (x & `{col}`) = 0)"
    )


def _blocks(d: F.Column, cell_rows: int) -> F.Column:
    """Blocks of about ``cell_rows`` bags. A posting is copied once per block, and a word is B² cells: of these no more
    are made than some for every shuffle partition, or the copies would grow with the square of a word's bags."""
    parts = int(SparkSession.active().conf.get("spark.sql.shuffle.partitions"))
    most = max(16, 2 * isqrt(parts))
    return F.least(F.greatest(F.ceil(d / F.lit(cell_rows)), F.lit(1)), F.lit(most)).cast("int")


def _grid_sides(df: DataFrame, carry: list[str], extra_left: list, extra_right: list) -> tuple[DataFrame, DataFrame]:
    """Both sides of a block-split self join on ``w``.

    ``df`` has ``w, v, m, blocks`` and the ``carry`` columns, which come out with an s or d behind their names. A
    row in block ``b`` of a word with B blocks goes to cells ``(b, 0..B-1)`` on the left and
    ``(0..B-1, b)`` on the right, so every pair of rows of the word meets in
    exactly one cell (a B x B grid of tasks instead of one).
    """
    blk = F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int")
    spread = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    base = df.withColumn("blk", blk)
    lk, rk = [f"{c}s" for c in carry], [f"{c}d" for c in carry]
    left = base.select(
        "w", F.col("v").alias("src"), F.col("m").alias("ms"), *[F.col(c).alias(f"{c}s") for c in carry], *extra_left,
        "blk", "blocks", spread.alias("j")
    ).select("w", "src", "ms", *lk, *extra_left, (F.col("blk").cast("bigint") * F.col("blocks") + F.col("j")).alias("cell"))
    right = base.select(
        F.col("w").alias("w2"), F.col("v").alias("dst"), F.col("m").alias("md"), *[F.col(c).alias(f"{c}d") for c in carry],
        *extra_right, "blk", "blocks", spread.alias("i")
    ).select("w2", "dst", "md", *rk, *extra_right,
             (F.col("i").cast("bigint") * F.col("blocks") + F.col("blk")).alias("cell2"))
    return left, right


@dataclass(frozen=True)
class _Prepared:
    """Written once, used by all branches. ``freq(w, d)``: words of two bags or more; ``squares``: their Σ d²; ``hot``: words with a bit;
    ``bags(v, m, ...)``: hot-word masks (if nothing else goes with a bag, only of bags with a hot word); ``postings(v, w)``. ``bits`` words are hot, the first ``keyed`` of
    them have ``key_share``, the first ``counted`` too, up to their own limits."""

    freq: DataFrame
    squares: float
    hot: DataFrame
    bags: DataFrame
    postings: DataFrame
    bits: int
    keyed: int
    counted: int


def _prepared(postings: DataFrame, bags: DataFrame, cuts: TableCuts, hot_words: int, cell_rows: int, key_bits: int,
              count_bits: int = 0, hot_share: float = HOT_SHARE, key_share: float = KEY_SHARE) -> _Prepared:
    """``postings(v, w)`` and ``bags(v, ...)``, whose further columns go with the postings."""
    freq = cuts.cut(word_frequencies(postings).where("d >= 2"), "freq")
    squares = F.col("d").cast("double") * F.col("d")
    total = freq.agg(F.sum(squares)).first()[0] or 0.0
    heavy = freq.where(squares >= F.lit(hot_share * total))
    hot = cuts.cut(_hot_from_freq(heavy, hot_words, cell_rows), "hot")
    # At most 62 rows.
    shares = [r["d"] * r["d"] / total for r in hot.select("d").collect()]
    large = sum(x >= key_share for x in shares)
    extra = [c for c in bags.columns if c != "v"]
    if shares:
        masked = postings.join(F.broadcast(hot.select("w", "bit")), "w").groupBy("v").agg(F.bit_or(_bit("bit")).alias("m"))
        held = bags.join(masked, "v", "left").select("v", *extra, "m") if extra else masked
        bags = cuts.cut(held.fillna(0, ["m"]), "bags")
    else:
        bags = bags.select("v", *extra, F.lit(0).cast("bigint").alias("m"))
    return _Prepared(freq, total, hot, bags, postings, len(shares), min(int(key_bits), large), min(int(count_bits), large))


def _masked(p: _Prepared, carry: list[str], cuts: TableCuts) -> _Prepared:
    """``postings(v, w, m, carry...)``, as the joins need them."""
    if not (p.bits or carry):
        return replace(p, postings=p.postings.withColumn("m", F.lit(0).cast("bigint")))
    # The left join (same rows as an inner one) lets only the per-bag side
    # be broadcast, so the postings keep streaming in their own partitions.
    return replace(p, postings=cuts.cut(p.postings.join(p.bags, "v", "left").fillna(0, ["m"]), "postings_masked"))


def _dense(p: _Prepared, carry: list[str]) -> bool:
    """Whether the joins would look at more pairs than there are."""
    bags = p.bags.count() if carry else p.postings.agg(F.approx_count_distinct("v")).first()[0]
    return bags >= DENSE_BAGS and p.squares >= float(bags) ** 2


def _apart_ends(once: bool) -> F.Column:
    """No bag with itself; with ``once`` a pair in one direction only."""
    return F.col("src") < F.col("dst") if once else F.col("src") != F.col("dst")


def _hot_pairs(p: _Prepared, carry: list[str], skip_bits: int, once: bool = False) -> DataFrame:
    """Pairs that share a hot word, kept at their lowest shared bit only. The first min(bit, keyed) lower bits are
    part of the join key (pairs sharing one of them never meet), the rest are checked in the join condition."""
    hp = p.postings.join(F.broadcast(p.hot.where(F.col("bit") >= skip_bits).select("w", "bit", "blocks")), "w").withColumn(
        "kb", F.least(F.col("bit"), F.lit(p.keyed))
    )
    left, right = _grid_sides(hp, carry, ["bit", "kb"], ["kb"])
    left = left.withColumn("key", _low("ms", "kb"))
    right = right.withColumn("key2", F.explode(_subsets_avoiding("md", "kb")))
    lower_bits = _bit("bit") - 1
    return left.join(
        right,
        (left.w == right.w2)
        & (left.cell == right.cell2)
        & (left.key == right.key2)
        & _apart_ends(once)
        & ((left.ms.bitwiseAND(right.md)).bitwiseAND(lower_bits) == 0),
    ).select("src", "dst", *[f"{c}{e}" for c in carry for e in "sd"])


def _rare_postings(p: _Prepared, cuts: TableCuts, cell_rows: int, prefix_words: int) -> tuple[DataFrame, bool, DataFrame | None]:
    """Postings of the words without a bit that two bags hold, whether a word of them has several blocks, and the bags
    with more than ``prefix_words`` of them, if there are any. The postings are those of the other bags, each with
    ``earlier``: the rare words that its bag has earlier in the order (most bags first, then the word), and ``flags``: 64
    bits, of which each of them sets one. They are written only if both sides of a join would make them, else dealt by bag:
    the word is ``word``, as Spark shuffles both sides at once only if each has names of its own for all columns."""
    # A rare word can still be large at scale: it is block split like a hot one
    # (the frequency table is joined, not broadcast: it grows with the data).
    rare = p.postings.join(F.broadcast(p.hot.select("w")), "w", "left_anti") if p.bits else p.postings
    rare = rare.join(p.freq.select("w", "d", _blocks(F.col("d"), cell_rows).alias("blocks")), "w")
    rare = cuts.cut(rare.withColumnRenamed("w", "word"), "rare")
    long = rare.groupBy("v").agg(F.count(F.lit(1)).alias("words")).where(F.col("words") > prefix_words).select("v")
    long = cuts.cut(long, "long-bags")
    some = not long.isEmpty()
    short = rare.join(long, "v", "left_anti") if some else rare
    bag = Window.partitionBy("v").orderBy(F.desc("d"), F.asc("word")).rowsBetween(-prefix_words, -1)
    mark = F.expr("shiftleft(cast(1 as bigint), cast(pmod(xxhash64(word), 64) as int))")
    # Marks are random bits, which no shuffle makes smaller: they are made behind it.
    short = short.where("v is not null").repartition("v").withColumn("mark", mark).withColumn("earlier", F.collect_list("word").over(bag)).withColumn(
        "flags", F.coalesce(F.bit_or("mark").over(bag), F.lit(0).cast("bigint")))
    short = short.drop("d", "mark")
    split = (rare.agg(F.max("blocks")).first()[0] or 1) > 1
    if split or p.keyed:
        short = cuts.cut(short, "rare-short")
        cuts.drop_named("rare")
    return short, split, long if some else None


def _rare_pairs(p: _Prepared, short: DataFrame, split: bool, carry: list[str], once: bool = False) -> DataFrame:
    """Pairs of the postings ``short`` that share a word without a bit and none with one."""
    ends = [f"{c}{e}" for c in carry for e in "sd"]
    on = F.col("w") == F.col("w2")
    if split:
        sides = short.withColumnsRenamed({"word": "w", "earlier": "before", "flags": "marks"}).withColumn("kb", F.lit(p.keyed))
        a, _ = _grid_sides(sides, carry, ["kb", "before", "marks"], [])
        _, b = _grid_sides(sides.withColumnsRenamed({"before": "before2", "marks": "marks2"}), carry, [], ["kb", "before2", "marks2"])
        on &= F.col("cell") == F.col("cell2")
    else:
        # Without blocks both sides are the same rows, which are shuffled once.
        a, b = (short.select(
            F.col("word").alias(f"w{k}"), F.col("v").alias(v), F.col("m").alias(f"m{e}"), *[F.col(c).alias(f"{c}{e}") for c in carry],
            F.col("earlier").alias(f"before{k}"), F.col("flags").alias(f"marks{k}")) for k, v, e in (("", "src", "s"), ("2", "dst", "d")))
        if p.keyed:
            a, b = a.withColumn("kb", F.lit(p.keyed)), b.withColumn("kb", F.lit(p.keyed))
    if p.keyed:
        a = a.withColumn("key", _low("ms", "kb"))
        b = b.withColumn("key2", F.explode(_subsets_avoiding("md", "kb")))
        on &= F.col("key") == F.col("key2")
    on &= _apart_ends(once)
    if p.bits:
        on &= F.col("ms").bitwiseAND(F.col("md")) == 0
    # Lists without a common mark have no common word: few pairs need a look at the lists themselves.
    on &= (F.col("marks").bitwiseAND(F.col("marks2")) == 0) | ~F.arrays_overlap("before", "before2")
    return a.drop("kb").join(b.drop("kb"), on).select("src", "dst", *ends)


@dataclass(frozen=True)
class _Branches:
    """What the pairs are formed from: the postings of short bags and ``p`` with their hot ones (None where all pairs are
    in tiles), and the tiles of the pairs with a long bag, if there is any."""

    p: _Prepared
    short: DataFrame | None
    split: bool
    tiles: DataFrame | None

    def joined(self, carry: list[str], skip_bits: int = 0, once: bool = False, ends: DataFrame | None = None) -> DataFrame | None:
        """The pairs outside the tiles; those that share one of the first ``skip_bits`` hot words are left out. With
        ``once`` one row per pair, in either direction. ``ends(v, ...)``: more columns, taken to the postings; they
        have to be among ``carry``."""
        if self.short is None:
            return None
        p, short = self.p, self.short
        if ends is not None:
            short = short.join(ends, "v")
        rare = _rare_pairs(p, short, self.split, carry, once)
        if p.bits <= skip_bits:
            return rare
        if ends is not None:
            p = replace(p, postings=p.postings.join(ends, "v"))
        return _hot_pairs(p, carry, skip_bits, once).unionByName(rare)


def _branches(p: _Prepared, cuts: TableCuts, carry: list[str], cell_rows: int, prefix_words: int) -> _Branches:
    def tiled(every: bool) -> DataFrame:
        bags = p.bags.select("v", "m", *carry) if p.bits or carry else None
        return tiled_bags(p.postings, p.freq, bags, p.bits, prefix_words, every, carry, cuts)

    if _dense(p, carry):
        out = _Branches(p, None, False, tiled(True))
        cuts.drop_named("hot")
    else:
        masked = _masked(p, carry, cuts)
        short, split, long = _rare_postings(masked, cuts, cell_rows, prefix_words)
        out = _Branches(masked, short, split, None)
        if long is not None:
            hot = replace(masked, postings=masked.postings.join(long, "v", "left_anti"))
            out = _Branches(hot, short, split, tiled(False))
    # All that is still to be read was written anew.
    cuts.drop_named("postings", "freq", *[] if p.bits else ["postings_masked"])
    return out


def _mask(bits: int) -> int:
    return (1 << bits) - 1


def _pairs(p: _Prepared, cuts: TableCuts, carry: list[str], cell_rows: int, prefix_words: int, skip_bits: int = 0,
           once: bool = False) -> DataFrame:
    """The pairs of all branches; pairs that share one of the first ``skip_bits`` hot words are left out. With
    ``once`` one row per pair, in either direction."""
    branches = _branches(p, cuts, carry, cell_rows, prefix_words)
    return _all_pairs(branches, carry, skip_bits, once)


def _all_pairs(branches: _Branches, carry: list[str], skip_bits: int = 0, once: bool = False) -> DataFrame:
    parts = [branches.joined(carry, skip_bits, once)]
    if branches.tiles is not None:
        parts.append(tiled_pairs(branches.tiles, carry, _mask(skip_bits), once, branches.p.bits))
    return reduce(DataFrame.unionByName, [x for x in parts if x is not None])


def overlap_edges(postings: DataFrame, strategy: str = "hybrid", directed: bool = True,
                  hot_words: int = MAX_BITS, cell_rows: int = 4096,
                  key_bits: int = 4, materialize: bool = True,
                  with_sizes: bool = False, attr: int | None = None, prefix_words: int = PREFIX_WORDS) -> DataFrame:
    """J1 + P4: ``src, dst`` for every ordered pair of distinct bags sharing a word.

    ``postings(v, w)`` must be unique on ``(v, w)``. ``directed=False`` keeps
    one row per pair (``src < dst``). ``with_sizes=True`` adds ``ns, nd``
    (distinct words of each end, J7): they are carried through the pair join
    from the postings, so questions on sizes need no join of the pairs back
    to the bags, and pairs of the hot branch are aggregated in the task that
    forms them. ``attr`` adds the edge attribute: 0 (P2), or 1 = min(shared
    words, 1) (P3, F6), which every pair that shares a word has.

    The hybrid's result has ``with_ends(attrs, value)``: the edges whose ends take the attribute with them (``ends``,
    ``endd``), joined to the postings, and those that are formed in tiles, without it (None where there are none).
    """
    if attr not in (None, 0, 1):
        raise ValueError("attr must be None, 0 or 1")
    p = postings.select("v", "w")
    cuts = TableCuts(p.sparkSession, "overlap", release_shuffles=True)
    if materialize and strategy != "plain":
        # The postings are read several times (frequencies, masks, both
        # branches): write them once instead of re-deriving them each time.
        p = cuts.cut(p, "postings")
    if strategy == "plain":
        edges = _plain(p, with_sizes)
    elif strategy == "hybrid":
        bags = p.groupBy("v").agg(F.count(F.lit(1)).alias("n")) if with_sizes else p.select("v")
        prepared = _prepared(p, bags, cuts, hot_words, cell_rows, key_bits)
        carry = ["n"] if with_sizes else []
        branches = _branches(prepared, cuts, carry, cell_rows, prefix_words)
        edges = _all_pairs(branches, carry)
    else:
        raise ValueError(f"unknown strategy {strategy!r}")

    def finished(pairs: DataFrame) -> DataFrame:
        if not directed:
            pairs = pairs.where(F.col("src") < F.col("dst"))
        return pairs if attr is None else pairs.withColumn("attr", F.lit(attr))

    def with_ends(attrs: DataFrame, value: str) -> tuple[DataFrame | None, DataFrame | None]:
        ends = cuts.cut(attrs.select("v", F.col(value).alias("end")), f"ends-{len(cuts.paths)}")
        joined = branches.joined([*carry, "end"], ends=ends)
        tiled = None if branches.tiles is None else finished(tiled_pairs(branches.tiles, carry, 0, False, prepared.bits))
        return None if joined is None else finished(joined), tiled

    edges = finished(edges)
    if strategy == "hybrid":
        # For ``graph.triplets``, which would have to shuffle the pairs.
        edges.with_ends = with_ends
    return edges


def overlap_graph(vertices: DataFrame, postings: DataFrame, strategy: str = "hybrid", directed: bool = True,
                  **kw) -> Graph:
    """The word-overlap graph as ``Graph(vertices(v, n), edges(src, dst, ns, nd))``.

    The postings are written once below the checkpoint folder; the bag
    sizes (A20) and the edges (J1, with both end sizes) are derived from that
    table, so whatever produced the postings (e.g. tokenising whole texts)
    runs once.
    """
    p = TableCuts(postings.sparkSession, "overlap", release_shuffles=True).cut(postings.select("v", "w"), "postings")
    sizes = bag_sizes(vertices, p)
    edges = overlap_edges(p, strategy=strategy, directed=directed, materialize=False, with_sizes=True, **kw)
    return Graph(sizes, edges)


def _apart(cells: DataFrame, bits: int, by: list[str], sums: list[str]) -> DataFrame:
    """Sums over the cells whose mask shares no bit with ``low``, for every mask ``low`` of ``bits`` bits.

    ``cells`` has at most one row per mask (and value of ``by``); each adds to the masks that avoid it.
    """
    out = cells.withColumn("bits", F.lit(bits)).select(
        F.explode(_subsets_avoiding("low", "bits")).alias("low"), *by, *sums)
    return out.groupBy("low", *by).agg(*[F.sum(c).alias(f"{c}_apart") for c in sums])


def _classes(postings: DataFrame, cuts: TableCuts) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bags of equal words as one class each: ``bags(v, n, rep)``, ``classes(v, n, c)`` (the least bag, its words,
    the bags of the class), and the postings of the classes. Sets are told apart by size and 128 bits of hashes."""
    sets = cuts.cut(postings.groupBy("v").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("w")).alias("x"),
        F.bit_xor(F.xxhash64(F.lit("second"), "w")).alias("y")), "sets")
    held = cuts.cut(sets.groupBy("n", "x", "y").agg(F.min("v").alias("rep"), F.count(F.lit(1)).alias("c")), "classes")
    bags = sets.join(held.drop("c"), ["n", "x", "y"]).select("v", "n", "rep")
    classes = held.select(F.col("rep").alias("v"), "n", "c")
    # Of most tables few bags are copies of another: a small table goes to the postings, not the postings to the classes.
    copies = cuts.cut(bags.where("rep is null or v != rep").select("v"), "copies")
    return bags, classes, postings.where("v is not null").join(copies, "v", "left_anti")


def neighbor_totals(postings: DataFrame, count_bits: int = 8, hot_words: int = MAX_BITS, cell_rows: int = 4096,
                    key_bits: int = 4, prefix_words: int = PREFIX_WORDS, hot_share: float = HOT_SHARE,
                    key_share: float = KEY_SHARE) -> DataFrame:
    """``v, n, k, total`` per bag with a neighbour: words, neighbours, sum of the neighbours' words.

    Bags with equal words are joined as one class. Neighbours through one of
    the counted words (at most ``count_bits``, each with ``key_share`` of
    Σ df²; none where words are even) are not
    enumerated: they are all bags but those with a disjoint mask and the bag
    itself, and bags are counted per mask (2^count_bits rows at most). Only
    pairs without such a word go through the pair join.
    """
    cuts = TableCuts(postings.sparkSession, "overlap", release_shuffles=True)
    bags, classes, post = _classes(cuts.cut(postings.select("v", "w"), "postings"), cuts)
    p = _prepared(post, classes, cuts, hot_words, cell_rows, key_bits, count_bits, hot_share, key_share)
    branches = _branches(p, cuts, ["n", "c"], cell_rows, prefix_words)
    parts = []
    if (pairs := branches.joined(["n", "c"], p.counted)) is not None:
        parts.append(pairs.groupBy(F.col("src").alias("v")).agg(
            F.sum("cd").alias("k2"), F.sum(F.col("cd") * F.col("nd")).alias("total2")))
    if branches.tiles is not None:
        parts.append(tiled_totals(branches.tiles, _mask(p.counted), p.bits))
    rest = reduce(DataFrame.unionByName, parts)
    if branches.tiles is not None:
        rest = rest.groupBy("v").agg(F.sum("k2").alias("k2"), F.sum("total2").alias("total2"))
    zero = F.lit(0).cast("bigint")
    # Without a counted word, the others of a bag's own class are counted here.
    own = F.col("c") - 1
    counted = p.bags.select("v", "n", own.alias("k1"), (own * F.col("n")).alias("total1"))
    if p.counted:
        low = p.bags.withColumn("low", F.col("m").bitwiseAND((1 << p.counted) - 1))
        cells = low.groupBy("low").agg(F.sum("c").alias("c"), F.sum(F.col("c") * F.col("n")).alias("s"))
        apart = _apart(cells, p.counted, [], ["c", "s"])
        # One row: all bags with a word, and their words.
        every = cells.agg(F.coalesce(F.sum("c"), zero).alias("c"), F.coalesce(F.sum("s"), zero).alias("s")).first()
        has = F.col("low") != 0
        counted = low.join(apart, "low").select(
            "v", "n", F.when(has, F.lit(every["c"]) - F.col("c_apart") - 1).otherwise(own).alias("k1"),
            F.when(has, F.lit(every["s"]) - F.col("s_apart") - F.col("n")).otherwise(own * F.col("n")).alias("total1"))
    per_class = counted.join(rest, "v", "left").select(
        F.col("v").alias("rep"), (F.col("k1") + F.coalesce("k2", zero)).alias("k"),
        (F.col("total1") + F.coalesce("total2", zero)).alias("total")).where("k > 0")
    return bags.join(per_class, "rep").select("v", "n", "k", "total")


def larger_source_count(postings: DataFrame, count_bits: int = 8, hot_words: int = MAX_BITS, cell_rows: int = 4096,
                        key_bits: int = 4, prefix_words: int = PREFIX_WORDS, hot_share: float = HOT_SHARE,
                        key_share: float = KEY_SHARE) -> DataFrame:
    """Q1: ``n_edges``, the pairs of bags that share a word and differ in size (one direction of each counts).

    Bags with equal words are joined as one class; pairs that share a counted
    word are counted per mask and size, as in ``neighbor_totals``; the others are joined.
    """
    cuts = TableCuts(postings.sparkSession, "overlap", release_shuffles=True)
    _, classes, post = _classes(cuts.cut(postings.select("v", "w"), "postings"), cuts)
    p = _prepared(post, classes, cuts, hot_words, cell_rows, key_bits, count_bits, hot_share, key_share)
    branches = _branches(p, cuts, ["n", "c"], cell_rows, prefix_words)
    cuts.drop_named("sets")
    parts = []
    if (pairs := branches.joined(["n", "c"], p.counted, True)) is not None:
        parts.append(pairs.where("ns != nd").agg(F.sum(F.col("cs") * F.col("cd")).alias("x")))
    if branches.tiles is not None:
        parts.append(tiled_differing(branches.tiles, _mask(p.counted), p.bits))
    rest = reduce(DataFrame.union, parts).agg(F.sum("x").alias("x"))
    if not p.counted:
        return rest.select(F.coalesce("x", F.lit(0).cast("bigint")).alias("n_edges"))
    low = p.bags.withColumn("low", F.col("m").bitwiseAND((1 << p.counted) - 1))
    cells = low.groupBy("low", "n").agg(F.sum("c").alias("c"))
    masks = cells.groupBy("low").agg(F.sum("c").alias("c"))
    apart = _apart(masks, p.counted, [], ["c"]).withColumnRenamed("c_apart", "apart")
    apart_n = _apart(cells, p.counted, ["n"], ["c"]).withColumnRenamed("c_apart", "apart_n")
    same = cells.groupBy("n").agg(F.sum("c").alias("same"))
    every = masks.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("c")).first()["c"]
    # Per bag: those that share a hot word with it, less those of them with its size.
    differ = F.col("c") * (F.lit(every) - F.col("apart") - F.col("same") + F.coalesce("apart_n", F.lit(0)))
    counted = cells.where("low != 0").join(apart, "low").join(same, "n").join(apart_n, ["low", "n"], "left").agg(
        F.coalesce(F.sum(differ), F.lit(0)).alias("x"))
    return counted.select(F.expr("x div 2").alias("x")).union(rest).agg(F.sum("x").alias("n_edges"))
