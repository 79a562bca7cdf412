"""Seating against one customer at a time, Stirling numbers against their sum, and scores under other partitions."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordgraph.llm import pitman_yor, seating
from wordgraph.llm.blocks import blocks
from wordgraph.session import SHUFFLE_CLEANUP_CONF, TableCuts


def plain_gibbs(pairs, types, d1, d0, t1, t0, sweeps, burn_in, rng):
    """Tables of two levels of restaurants, every customer taken out and seated again, with all tables kept apart."""
    rooms = collections.defaultdict(lambda: collections.defaultdict(list))  # restaurant -> dish -> customers of each table

    def total(room):
        return sum(map(sum, rooms[room].values())), sum(map(len, rooms[room].values()))

    def chance(room, dish):
        if room is None:
            return 1 / (types + 1)
        c, t = total(room)
        d, s = (d0, t0) if room == "root" else (d1, t1)
        up = chance(None if room == "root" else "root", dish)
        return (sum(rooms[room][dish]) - d * len(rooms[room][dish]) + (s + d * t) * up) / (s + c)

    def add(room, dish):
        d, s, up = (d0, t0, None) if room == "root" else (d1, t1, "root")
        weights = [x - d for x in rooms[room][dish]] + [(s + d * total(room)[1]) * chance(up, dish)]
        at = rng.choice(len(weights), p=np.array(weights) / sum(weights))
        if at < len(rooms[room][dish]):
            rooms[room][dish][at] += 1
        else:
            rooms[room][dish].append(1)
            if up:
                add(up, dish)

    def remove(room, dish):
        tables = rooms[room][dish]
        at = rng.choice(len(tables), p=np.array(tables) / sum(tables))
        tables[at] -= 1
        if not tables[at]:
            tables.pop(at)
            if room != "root":
                remove("root", dish)

    for (u, w), n in pairs.items():
        for _ in range(n):
            add(u, w)
    sums = collections.Counter()
    for turn in range(sweeps):
        for (u, w), n in pairs.items():
            for _ in range(n):
                remove(u, w)
                add(u, w)
        if turn >= burn_in:
            for u, w in pairs:
                sums[u, w] += len(rooms[u][w])
            for w in {w for _, w in pairs}:
                sums["root", w] += len(rooms["root"][w])
    return {k: v / (sweeps - burn_in) for k, v in sums.items()}


def test_tables_agree_with_one_customer_at_a_time():
    rng = np.random.default_rng(5)
    pairs = {(int(u), int(w)): int(n) for u, w, n in zip(
        np.repeat(np.arange(4), 6), np.tile(np.arange(6), 4), rng.choice([1, 2, 3, 5, 9, 20], 24))}
    types, d1, d0, t1, t0 = 6, 0.6, 0.4, 2.0, 1.5
    want = plain_gibbs(pairs, types, d1, d0, t1, t0, 700, 100, rng)
    u, w = np.array(list(pairs)).T
    n, t, r = np.array(list(pairs.values())), np.ones(24, np.int64), np.ones(6, np.int64)
    p, ids, sums, root_sums = pitman_yor.Params(), np.arange(6), np.zeros(24), np.zeros(6)
    for turn in range(3100):
        sent = np.bincount(w, weights=t, minlength=6)
        totals = {"discount": d1, "root_discount": d0, "strength": t1, "root_strength": t0, "types": types, "ids": ids,
                  "root_tables": r.sum(), "guests": sent.sum()}
        t = pitman_yor.reseat(u, w, n, t, np.bincount(u, weights=t, minlength=6), sent, r, totals, p, turn)
        sent = np.bincount(w, weights=t, minlength=6).astype(np.int64)
        for x in range(6):
            old = np.minimum(r[x:x + 1], sent[x])
            r[x:x + 1] = seating.tables(sent[x:x + 1], old, t0 + d0 * (r.sum() - r[x] + 0.0 * old), d0, np.ones(1),
                                        np.full(1, types + 1.0), 0,
                                        lambda i, rows: seating.uniform(8, turn, i, ids[x:x + 1][rows], ids[:1][rows]))
        if turn >= 100:
            sums += t
            root_sums += r
    got = dict(zip(pairs, sums / 3000)) | {("root", x): root_sums[x] / 3000 for x in range(6)}
    assert sum(got[k] for k in pairs) == pytest.approx(sum(want[k] for k in pairs), rel=0.05)
    assert all(abs(got[k] - want[k]) < 0.15 + 0.1 * want[k] for k in want)


@pytest.mark.parametrize("discount", [0.3, 0.7])
def test_stirling_numbers_and_large_dishes(discount):
    rows = seating._stirling_rows(discount, 64)
    for n, t in ((5, 2), (20, 7), (40, 3)):  # the alternating sum over products of falling factors
        total = sum((-1) ** (n + k) * math.comb(t, k) * math.prod(discount * k - i for i in range(n)) for k in range(1, t + 1))
        assert rows[n, t] == pytest.approx(math.log(abs(total) / (math.factorial(t) * discount**t)), rel=1e-6)
    size, k = 2 * seating.EXACT, np.arange(300)
    full, j = seating._stirling_rows(discount, size)[size, 1:size], np.arange(size - 1)
    logs = np.cumsum(np.log(3.0 + discount * j) + np.log(40.0 + j) - np.log(500.0 + j)) + full
    mass = np.exp(logs - logs.max())
    want = (mass * (j + 1)).sum() / mass.sum()
    t, kept = np.ones(300, np.int64), []
    for turn in range(60):
        t = seating.tables(np.full(300, size), t, np.full(300, 3.0), discount, np.full(300, 40.0), np.full(300, 500.0), 1,
                           lambda i, rows: seating.uniform(7, turn, i, k[rows], k[rows]))
        kept += [t.mean()] * (turn >= 20)
    assert np.mean(kept) == pytest.approx(want, rel=0.06)


def test_scores_do_not_follow_partitions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    params = pitman_yor.Params(sweeps=2, burn_in=1, chunk_tokens=20_000)
    few, many = (sorted((r["doc_id"], r["score"]) for r in pitman_yor.score_documents(
        docs.repartition(n, F.col("doc_id")), params=params).collect()) for n in (3, 11))
    assert [k for k, _ in few] == [k for k, _ in many]
    assert np.allclose([s for _, s in few], [s for _, s in many], rtol=1e-6)


def test_sweeps_carry_no_pair_seen_once(spark):
    """Pairs seen once are kept, but not in the sweeps; a write's shuffle files go with it."""
    texts = [(k, f"a b c a b d{k} e{k}") for k in range(30)]
    rows = spark.createDataFrame(texts, "key long, text string").withColumn("flag", F.lit(False))
    cuts = TableCuts(spark, "pitman-yor-test", release_shuffles=True)
    table = cuts.cut(blocks(rows, fold=True, end=True), "blocks")
    model = pitman_yor.fit(table, cuts, pitman_yor.Params(sweeps=2, burn_in=1))
    pairs = {(r["u"], r["w"]): (r["n"], r["t"], r["kept"]) for r in model.pairs.collect()}
    # a b, b c, c a and end a are seen often; b d, d e and e end once for each text.
    assert len(pairs) == 4 + 90 and sorted(n for n, _, _ in pairs.values()) == [1] * 90 + [30, 30, 30, 60]
    assert all((t, kept) == (1, 1) for n, t, kept in pairs.values() if n == 1)
    assert [len(pitman_yor._unpack(r["n"])) for r in model.state.collect()] == [4]
    sums = model.ids.agg(F.sum("opened"), F.sum("sent")).first()
    assert list(sums) == [sum(t for _, t, _ in pairs.values())] * 2
    assert spark.conf.get(SHUFFLE_CLEANUP_CONF) == "false"
    local = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = local.getAllFiles().size()
    cuts.cut(spark.range(1000).repartition(7), "dealt")
    assert local.getAllFiles().size() <= before


class CountedCuts(TableCuts):
    """Keeps the number of rows of each table that was written."""

    def cut(self, df, name, **options):
        out = super().cut(df, name, **options)
        self.rows = {**getattr(self, "rows", {}), name: out.count()}
        return out


def test_words_do_not_travel_as_rows(spark):
    """Blocks, chunks and parts exchange packed rows: no written table has a row per word."""
    texts = [(k, " ".join(f"w{k}x{i % 400}" for i in range(500))) for k in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    cuts = CountedCuts(spark, "pitman-yor-test")
    params = pitman_yor.Params(sweeps=2, burn_in=1, part_words=4000, chunk_tokens=4000)
    assert pitman_yor.score_documents(docs, params=params, cuts=cuts).count() == 40
    assert {"blocks", "numbers", "seats", "words-2"} <= set(cuts.rows)
    assert max(cuts.rows.values()) < 400  # of 16,000 distinct words


def test_scores_do_not_follow_parts_of_the_vocabulary(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).union(
        spark.createDataFrame([(-1, None), (-2, "é " * 40 + "\x1c z\x85 " + "long" * 9000), (-3, ""), (-2, "the the")],
                              "doc_id long, text string")).cache()
    given = {"sweeps": 2, "burn_in": 1, "chunk_tokens": 5000, "block_bytes": 30_000}
    one, many = (sorted((r["doc_id"], r["n_known"], r["base_score"], r["score"]) for r in pitman_yor.score_documents(
        docs, params=pitman_yor.Params(**given, **more)).collect()) for more in ({}, {"part_words": 900, "part_bytes": 8000}))
    assert len(one) == 64 and [r[:2] for r in one] == [r[:2] for r in many]
    assert np.allclose([r[2:] for r in one], [r[2:] for r in many], rtol=1e-9)
    cuts = TableCuts(spark, "pitman-yor-test")
    rows = docs.select(F.col("doc_id").alias("key"), F.lit(False).alias("flag"), "text")
    table = cuts.cut(blocks(rows, fold=True, end=True), "blocks")
    vocab = pitman_yor.vocabulary(table, cuts, pitman_yor.Params(part_words=900, part_bytes=8000))
    words = {w for r in docs.collect() for w in (r["text"] or "").encode().lower().split()}
    assert len(vocab.starts) > 5 and vocab.types == vocab.starts[-1] == len(words) + 1
    assert vocab.parts.count() == len(vocab.starts) - 1


def test_without_training_texts_all_words_are_unknown(spark):
    held = [(k, "a b a") for k in range(60) if zlib.crc32(str(k).encode()) % 5 == 1]
    rows = pitman_yor.score_documents(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert len(rows) == len(held) and all((r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) == (4, 0, 0, 0.0) for r in rows)


@pytest.mark.parametrize("steps", [False, True])
def test_packed_numbers(steps):
    for values in ([], [0], [5, 3, -1, 2**40, 7, -(2**50)], list(range(1000))):
        got = pitman_yor._unpack(pitman_yor._pack(np.array(values, np.int64), steps))
        assert got.tolist() == values and got.dtype == np.int64
