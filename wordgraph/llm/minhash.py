"""Near-duplicates: banded MinHash, sequential Bayesian pruning, exact verification.

1. Every text becomes the set of hashes of its five-word shingles, and a MinHash
   signature of it. Texts with equal word sequences are one node from here on.
2. Signatures are cut into bands; nodes with an equal band share a bucket.
3. First pass: in each bucket every node is compared with the bucket's lead, a
   number of pairs that is linear in the bucket. Leads are chosen by a few
   hashes of the node, taken in turn by the bands, so a large group meets some
   leads and not one for each band. Links found make components.
4. Second pass: only pairs of a bucket whose nodes are in different components
   can change anything. Buckets that still hold several are cut into cells, and
   pairs of cells are compared in parallel, without writing out the pairs: a
   group first tells which of its nodes have partners, then gets the texts of
   these and returns links. The cells of a bucket's largest component meet the
   cells of the others only, never each other.
5. A pair is compared batch by batch of its signatures; it is dropped as soon
   as the posterior probability that its similarity reaches the threshold
   falls below the chosen miss probability (uniform prior, so the posterior is
   a beta distribution). What survives is verified on the full sets.

No group of equal or similar texts is ever expanded into all its pairs unless
its members stay apart, and nothing is capped.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wordgraph.llm.common import WordHash, mix64, ragged, small_batches, text_bytes
from wordgraph.llm.components import components
from wordgraph.session import TableCuts


@dataclass(frozen=True)
class Params:
    """Link where ``100 * shared >= percent * united``."""

    percent: int = 75
    shingle: int = 5
    bands: int = 32
    rows: int = 4
    batch: int = 16
    #: Posterior chance below which a batch prunes a pair. All 8 batches together lose a pair exactly at the
    #: threshold with a chance of about 1e-6; that no band holds it has another 5e-6.
    miss: float = 1e-7
    #: Orders of the nodes by which bands choose leads.
    orders: int = 8
    #: Nodes of a block of a bucket in the second pass.
    block: int = 512
    seed: int = 1

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def _multipliers(p: Params) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(p.seed)
    a = rng.integers(0, 2**32, p.hashes, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
    return a, rng.integers(0, 2**32, p.hashes, dtype=np.uint64).astype(np.uint32)


def shingle_set(words: list, cache: WordHash, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; of the whole sequence if it is shorter."""
    if not words:
        return np.zeros(0, np.uint64)
    h = cache.all(words)
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for i in range(size):
        out += mix64(h[i:len(h) - size + 1 + i] + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % 2**64))
    return np.unique(mix64(out + np.uint64(size)))


def signature(items: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash of a set of 64-bit values: per hash function the least ``a * x + b`` modulo 2**32."""
    x = (items >> np.uint64(32)).astype(np.uint32) ^ items.astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = x[i:i + 2048]
        np.minimum(out, ((a[:, None] * part[None, :]) + b[:, None]).min(axis=1), out=out)
    return out


def _beta_above(t: float, m: int, k: int) -> float:
    """P(similarity >= t) after m agreements in k: 1 minus the beta(m+1, k-m+1) distribution at t."""
    return sum(comb(k + 1, j) * t**j * (1 - t) ** (k + 1 - j) for j in range(0, m + 1))


def agreements_needed(p: Params) -> list[tuple[int, int]]:
    """(hashes compared, agreements below which a pair is pruned) after each batch."""
    t, out = p.percent / 100, []
    for k in range(p.batch, p.hashes + 1, p.batch):
        m = 0
        while m <= k and _beta_above(t, m, k) < p.miss:
            m += 1
        out.append((k, m))
    return out


def may_link(left: np.ndarray, right: np.ndarray, needed: list[tuple[int, int]],
             a: np.ndarray | None = None, b: np.ndarray | None = None) -> np.ndarray:
    """Which pairs no batch prunes: row ``a[i]`` of ``left`` and ``b[i]`` of ``right`` (else row ``i`` of both)."""
    a = np.arange(len(left)) if a is None else a
    b = np.arange(len(right)) if b is None else b
    alive = np.arange(len(a))
    agree, done = np.zeros(len(a), np.int64), 0
    for k, least in needed:
        agree = agree + (left[a[alive], done:k] == right[b[alive], done:k]).sum(axis=1)
        keep = agree >= least
        alive, agree, done = alive[keep], agree[keep], k
    return alive


def signed(docs: DataFrame, p: Params) -> DataFrame:
    """``key, at, words_digest, n_shingles, sig`` of every row of ``docs(key, text)``; no digest without words."""
    a, b = _multipliers(p)

    def run(batches):
        import xxhash

        cache = WordHash()
        for batch in batches:
            digests, counts, sigs = [], [], []
            for text in text_bytes(batch.column("text")):
                words = text.lower().split()
                items = shingle_set(words, cache, p.shingle)
                counts.append(len(items))
                digests.append(xxhash.xxh128_digest(b" ".join(words)) if words else None)
                sigs.append(signature(items, a, b).tobytes() if words else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("at"), pa.array(digests, pa.binary()),
                 pa.array(counts, pa.int64()), pa.array(sigs, pa.binary())],
                names=["key", "at", "words_digest", "n_shingles", "sig"])

    kind = docs.schema["key"].dataType.simpleString()
    placed = docs.select(*_place(F.col("key"), F.col("text")), "text")
    return placed.mapInArrow(run, f"key {kind}, at long, words_digest binary, n_shingles long, sig binary")


def band_keys(nodes: DataFrame, p: Params, *others: str) -> DataFrame:
    """``node, i, band`` and ``others``: a 64-bit key for each band ``i`` of a node's signature."""
    width = 4 * p.rows
    keys = [F.xxhash64(F.lit(i), F.substring("sig", i * width + 1, width)) for i in range(p.bands)]
    return nodes.select("node", *others, F.posexplode(F.array(*keys)).alias("i", "band"))


def _parts(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lead_pairs(bands: DataFrame, p: Params, parts: int) -> DataFrame:
    """``u, v`` (u < v, distinct): in each bucket of ``bands(node, i, band)`` every node and a lead.

    A bucket is dealt over ``parts`` by a hash of the node; a node meets the
    lead of its part, the leads of the parts meet the least of them. Bands
    take turns at ``p.orders`` orders of the nodes, so a large group meets
    that many leads, not one for each band.
    """
    order = F.xxhash64(F.col("i") % p.orders, "node")
    rows = bands.select("node", "band", order.alias("h"), F.pmod(F.xxhash64("node"), F.lit(parts)).alias("part"))
    least = F.min(F.struct("h", "node"))
    led = rows.withColumn("lead", least.over(Window.partitionBy("band", "part")))
    tops = led.where("node = lead.node").select("node", "band", "h").withColumn(
        "lead", least.over(Window.partitionBy("band")))
    pairs = led.select("node", "lead").union(tops.select("node", "lead")).where("node != lead.node")
    return pairs.select(F.least("node", "lead.node").alias("u"), F.greatest("node", "lead.node").alias("v")).distinct()


def _signatures(column) -> np.ndarray:
    flat = b"".join(column.to_pylist())
    return np.frombuffer(flat, np.uint32).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.uint32)


def pruned(pairs: DataFrame, p: Params) -> DataFrame:
    """The ``u, v`` of ``pairs(u, v, sig_u, sig_v, n_u, n_v)`` that sizes and signatures leave."""
    needed = agreements_needed(p)

    def run(batches):
        for batch in batches:
            alive = may_link(_signatures(batch.column("sig_u")), _signatures(batch.column("sig_v")), needed)
            yield batch.select(["u", "v"]).take(pa.array(alive))

    sizes = F.col("n_u") * 100 >= p.percent * F.col("n_v")
    back = F.col("n_v") * 100 >= p.percent * F.col("n_u")
    return pairs.where(sizes & back).select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u long, v long")


def _place(key, text):
    """Where a row's text is found again: its key, or a hash of the text where the key is null."""
    return [key.alias("key"), F.when(key.isNull(), F.xxhash64(text)).otherwise(F.lit(0)).alias("at")]


def candidate_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text`` for ``wanted(node, words_digest, key, at)``: one text with the node's words.

    ``docs(key, text)`` may hold a key more than once, so the digest decides.
    """
    found = docs.select(*_place(F.col("key"), F.col("text")), "text").alias("d").join(
        wanted.alias("w"), F.expr("d.key <=> w.key and d.at = w.at")).select("node", "words_digest", "text")

    def run(batches):
        import xxhash

        for batch in batches:
            keep = [xxhash.xxh128_digest(b" ".join(t.lower().split())) == d for t, d in zip(
                text_bytes(batch.column("text")), batch.column("words_digest").to_pylist())]
            yield batch.select(["node", "text"]).filter(pa.array(keep, pa.bool_()))

    return found.mapInArrow(run, "node long, text string").dropDuplicates(["node"])


def verified(pairs: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The ``pairs(u, v)`` whose full shingle sets reach the threshold; sets are made from ``texts(node, text)``.

    Texts travel rather than sets: they are shorter than their sets of hashes.
    """
    left = texts.select(F.col("node").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("node").alias("v"), F.col("text").alias("text_v"))

    def run(batches):
        cache = WordHash()
        last, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            rows = zip(batch.column("u").to_pylist(), text_bytes(batch.column("text_u")),
                       text_bytes(batch.column("text_v")))
            for i, (u, x, y) in enumerate(rows):
                if u != last:
                    last, own = u, shingle_set(x.lower().split(), cache, p.shingle)
                other = shingle_set(y.lower().split(), cache, p.shingle)
                shared = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * shared >= p.percent * (len(own) + len(other) - shared):
                    keep.append(i)
            yield batch.select(["u", "v"]).take(pa.array(keep, pa.int64()))

    both = pairs.join(right, "v").join(left, "u").select("u", "v", "text_u", "text_v")
    return both.mapInArrow(run, "u long, v long")


#: Columns that name a group of the second pass, and those of its rows.
_GROUP = ["i", "band", "lo", "hi"]
_MEMBER = ["node", "component", "cell"]
#: Pairs that are compared at once in a task.
_AT_ONCE = 1 << 16


def _cells(buckets: DataFrame, p: Params) -> DataFrame:
    """The rows of ``buckets(i, band, node, component)`` in groups ``i, band, lo, hi``.

    A bucket of more than ``p.block`` nodes is dealt in cells of about that
    many, those of its largest component and those of all others apart. A pair
    of cells is one group, unless both are of the largest component, which has
    no pairs to find: N nodes with a few strays make about N rows, not N cells
    of N.
    """
    per = buckets.groupBy("i", "band", "component").agg(F.count(F.lit(1)).alias("n"))
    size = per.groupBy("i", "band").agg(F.sum("n").alias("size"), F.max(F.struct("n", "component")).alias("top"))
    large = F.col("size") > p.block
    rows = buckets.join(size, ["i", "band"]).withColumn("is_top", large & (F.col("component") == F.col("top.component")))
    rows = rows.withColumn("rest", F.when(large, F.ceil((F.col("size") - F.col("top.n")) / p.block)).otherwise(1))
    rows = rows.withColumn("tops", F.when(large, F.ceil(F.col("top.n") / p.block)).otherwise(0))
    h = F.xxhash64("node")
    rows = rows.withColumn("cell", F.when(F.col("is_top"), F.col("rest") + F.pmod(h, F.col("tops"))).otherwise(
        F.pmod(h, F.col("rest"))).cast("int"))
    met = F.col("rest") + F.when(F.col("is_top"), 0).otherwise(F.col("tops"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), (met - 1).cast("int"))))
    return rows.select("i", "band", F.least("cell", "other").alias("lo"), F.greatest("cell", "other").alias("hi"),
                       "node", "component", "cell")


def _by_group(rows: DataFrame) -> DataFrame:
    """Rows of one group next to each other, nodes in order."""
    return rows.repartition(*_GROUP).sortWithinPartitions(*_GROUP, "node")


def _group_starts(table: pa.Table) -> np.ndarray:
    ids = np.stack([table.column(c).to_numpy().astype(np.int64) for c in _GROUP])
    return np.append(0, np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1)


def _whole_groups(batches):
    """Tables of whole groups from sorted batches; a group may go over several batches."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        last = int(_group_starts(table)[-1])
        if last:
            yield table.slice(0, last).combine_chunks()
        held = table.slice(last)
    if held is not None:
        yield held.combine_chunks()


class _Groups:
    """The nodes of whole groups, one after another, and which pairs of them signatures leave."""

    def __init__(self, table: pa.Table, p: Params):
        self.p, self.needed = p, agreements_needed(p)
        self.node, self.comp, self.cell, self.n, self.band, lo, hi = (
            table.column(c).to_numpy() for c in ("node", "component", "cell", "n_shingles", "i", "lo", "hi"))
        self.crossed = lo != hi
        self.sig = _signatures(table.column("sig").combine_chunks())
        self.starts = _group_starts(table)
        self.ends = np.append(self.starts[1:], len(self.node))

    def pairs(self):
        """Arrays ``a, b`` (``a < b``, in the order of ``a``), bounded in size: rows of one group and different
        components that may be linked and agree first in the group's band."""
        p, sig, rows = self.p, self.sig, np.arange(len(self.node))
        after = np.repeat(self.ends, self.ends - self.starts) - rows - 1
        chunk = np.cumsum(after) // _AT_ONCE
        bounds = np.append(np.append(0, np.flatnonzero(np.diff(chunk)) + 1), len(rows))
        for first, end in zip(bounds, bounds[1:]):
            a = np.repeat(rows[first:end], after[first:end])
            b = ragged(rows[first:end] + 1, after[first:end])
            least, most = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
            fits = (self.comp[a] != self.comp[b]) & (100 * least >= p.percent * most)
            fits &= ~self.crossed[a] | (self.cell[a] != self.cell[b])
            a, b = a[fits], b[fits]
            left = may_link(sig, sig, self.needed, a, b)
            a, b = a[left], b[left]
            same = (sig[a] == sig[b]).reshape(len(a), p.bands, p.rows).all(axis=2)
            own = same.argmax(axis=1) == self.band[a]
            yield a[own], b[own]


def _open_nodes(rows: DataFrame, p: Params) -> DataFrame:
    """The rows of groups whose node may be linked with one of another component."""

    def run(batches):
        for table in _whole_groups(batches):
            hit = np.zeros(table.num_rows, bool)
            for a, b in _Groups(table, p).pairs():
                hit[a] = hit[b] = True
            yield from table.select([*_GROUP, *_MEMBER]).filter(pa.array(hit)).to_batches()

    kinds = "i int, band long, lo int, hi int, node long, component long, cell int"
    return _by_group(rows).mapInArrow(run, kinds)


def _links_apart(rows: DataFrame, p: Params) -> DataFrame:
    """``u, v``: verified links of the groups' open nodes (with ``text``), as many as join their components.

    One node is compared with all its partners at once: the group's shingles
    are numbered, the node's are flagged, and flags are summed per partner.
    Partners that a link has already joined in this group are passed over.
    """

    def run(batches):
        cache = WordHash()
        for table in _whole_groups(batches):
            g, texts = _Groups(table, p), text_bytes(table.column("text"))
            us, vs, start, end = [], [], 0, 0
            for firsts, seconds in g.pairs():
                for rest in np.split(np.arange(len(firsts)), np.flatnonzero(np.diff(firsts)) + 1):
                    if not len(rest):
                        continue
                    i, rest = int(firsts[rest[0]]), seconds[rest]
                    if i >= end:
                        start = int(g.starts[np.searchsorted(g.starts, i, side="right") - 1])
                        end = int(g.ends[np.searchsorted(g.starts, i, side="right") - 1])
                        comp = g.comp[start:end].copy()
                        sets = [shingle_set(t.lower().split(), cache, p.shingle) for t in texts[start:end]]
                        sizes = np.array([len(x) for x in sets])
                        _, place = np.unique(np.concatenate(sets), return_inverse=True)
                        starts = np.cumsum(sizes) - sizes
                        flag = np.zeros(int(place.max()) + 1, np.int64)
                    i, rest = i - start, rest - start
                    rest = rest[comp[rest] != comp[i]]
                    if not len(rest):
                        continue
                    own = place[starts[i]:starts[i] + sizes[i]]
                    flag[own] = 1
                    shared = np.add.reduceat(flag[place[ragged(starts[rest], sizes[rest])]],
                                             np.cumsum(sizes[rest]) - sizes[rest])
                    flag[own] = 0
                    for j in rest[100 * shared >= p.percent * (sizes[i] + sizes[rest] - shared)]:
                        if comp[j] != comp[i]:
                            us.append(g.node[start + i])
                            vs.append(g.node[start + j])
                            comp[comp == comp[j]] = comp[i]
            yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], names=["u", "v"])

    return _by_group(rows).mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", params: Params = Params(),
                    cuts: TableCuts | None = None) -> DataFrame:
    """``key, n_shingles, component_id, kept`` for every row of ``docs``.

    ``component_id`` is the least key reachable over links, ``kept`` tells
    whether it is the row's own. A text without words (null, empty) has an
    empty set, no links and is kept. Rows that repeat a key and text agree in
    everything; null keys never lead a component that has another key.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cuts = cuts or TableCuts(spark, "minhash")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = cuts.cut(signed(rows, params), "signed")
    light = marked.select("key", "words_digest", "n_shingles")
    # One node for each sequence of words, led by the least key that has it (null keys last).
    lead = F.min(F.struct(F.col("key").isNull().alias("no"), "key", "at"))
    grouped = marked.where("words_digest is not null").groupBy("words_digest").agg(
        lead.alias("lead"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    nodes = cuts.cut(grouped.select(F.monotonically_increasing_id().alias("node"), "words_digest",
                                    F.col("lead.key").alias("key"), F.col("lead.at").alias("at"),
                                    "n_shingles", "sig"), "nodes")
    sigs = nodes.select("node", "n_shingles", "sig")
    stars = cuts.cut(lead_pairs(band_keys(nodes, params), params, _parts(spark)), "stars")
    wanted = stars.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = candidate_texts(rows, nodes.join(wanted, "node", "left_semi").select("node", "words_digest", "key", "at"))
    texts = cuts.cut(found.join(sigs, "node"), "texts")
    side = lambda x: sigs.toDF(x, f"n_{x}", f"sig_{x}")
    near = pruned(stars.join(side("u"), "u").join(side("v"), "v"), params)
    links = cuts.cut(verified(near, texts, params), "links")

    linked = cuts.cut(components(links, cuts, "first"), "first")
    # Components meet the nodes, one row each, before the bands are written out again.
    labelled = nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    held = band_keys(labelled, params, "component")
    mixed = held.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a < b")
    cells = _cells(held.join(mixed.select("band"), "band", "left_semi"), params)
    open_nodes = cuts.cut(_open_nodes(cells.join(sigs, "node"), params), "open")
    more = cuts.cut(_links_apart(open_nodes.join(texts, "node"), params), "more")

    final = components(linked.toDF("u", "v").union(more), cuts, "second")
    label = final.join(nodes.select("node", "key"), "node").groupBy("component").agg(F.min("key").alias("label"))
    labels = nodes.select("words_digest", "node", "key").join(final, "node", "left").join(
        label, "component", "left").select("words_digest", F.coalesce("label", "key").alias("label"))
    # Texts without words have no digest to meet by: they stay out of the join.
    with_words = light.where("words_digest is not null").join(labels, "words_digest", "left").select(
        "key", "n_shingles", F.col("label").alias("component_id"))
    without = light.where("words_digest is null").select("key", "n_shingles", F.col("key").alias("component_id"))
    return with_words.union(without).select(
        F.col("key").alias(key), "n_shingles", "component_id",
        F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
