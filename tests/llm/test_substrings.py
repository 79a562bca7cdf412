"""Removal of repeated windows against a plain version, in one block and in many."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordgraph.llm import substrings

RNG = random.Random(5)
PASSAGE = [f"p{i}" for i in range(60)]


def made():
    rows = []
    for i in range(120):
        words = [f"w{RNG.randrange(400)}" for _ in range(RNG.randrange(0, 80))]
        if i % 3 == 0:
            words[len(words) // 2:len(words) // 2] = PASSAGE[RNG.randrange(20):RNG.randrange(30, 60)]
        if i % 10 == 0:
            words += ["a", "b"] * 20
        rows.append((i, " ".join(words)))
    rows += [(200 + i, rows[33][1]) for i in range(20)]  # copies
    rows += [(-5, "\n".join(PASSAGE[:14])), (300, None), (301, ""), (302, " \t\x0b\x0c\r "), (303, " ".join(PASSAGE[:12])),
             (304, " ".join(PASSAGE[:13])), (None, " ".join(PASSAGE)), (None, " ".join(PASSAGE)), (305, "x " * 5000),
             (306, "x\u0085y\x1c " * 5000), (306, "x\u0085y\x1c " * 5000), (307, "x " * 12), ((1 << 62) + 1, " ".join(PASSAGE)),
             ((1 << 62) + 2, " ".join(PASSAGE))]
    return rows


def plain(rows, size=13):
    least, split = {}, [(k, (t or "").encode().split()) for k, t in rows]
    for k, words in split:
        for i in range(len(words) - size + 1):
            if k is not None:
                w = tuple(words[i:i + size])
                least[w] = min(k, least.get(w, k))
    out = []
    for k, words in split:
        gone = [False] * len(words)
        for i in range(len(words) - size + 1):
            if k is not None and least[tuple(words[i:i + size])] < k:
                gone[i:i + size] = [True] * size
        out.append((k, len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes,size", [(12 << 20, 13), (3000, 13), (1, 13), (3000, 2), (3000, 8)])
def test_repeats(spark, block_bytes, size):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("block", F.lit("clash")).withColumn("key", F.lit(1))
    got = substrings.remove_repeats(docs.repartition(3), size=size, block_bytes=block_bytes)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows, size)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.remove_repeats(docs).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 8, 13, 20])
def test_hashes_tell_windows_apart(size):
    words = np.random.default_rng(2).integers(0, 3, 400).astype(np.uint64)
    hashes = substrings.window_hashes(words, size, np.uint64(0x9E3779B97F4A7C15))
    seen = {}
    for i, h in enumerate(hashes.tolist()):
        assert seen.setdefault(h, tuple(words[i:i + size])) == tuple(words[i:i + size])
    assert len(hashes) == 401 - size and len(set(hashes.tolist())) == len({tuple(words[i:i + size]) for i in range(401 - size)})


def test_sketch_never_underestimates(spark):
    """Every window that is there twice passes the merged sketch, few others do."""
    from wordgraph.llm.blocks import blocks
    from wordgraph.session import TableCuts

    rows = [(k, t) for k, t in made() if k is not None]
    docs = spark.createDataFrame(rows, "key long, text string").withColumn("flag", F.lit(False)).repartition(3)
    table = TableCuts(spark, "test").cut(blocks(docs, block_bytes=3000), "blocks")
    bits, slices = 16, 4
    bits_of = substrings.merged(substrings.sketches(table, 13, bits, slices), 1 << bits - 2).collect()
    answers = {}
    for r in bits_of:
        answers.setdefault(r["block"], {})[r["part"]] = bytes(r["bits"])
    seen, passed = [], []
    for r in table.collect():
        words = [bytes(w) for w in r["words"]]
        refs = substrings.unpack_numbers(bytes(r["refs"]))
        windows = substrings.Windows(r["keys"], np.array(r["sizes"]), refs, words, 13)
        keep = windows.repeated(bits, slices, answers.get(r["block"], {}))
        text = [words[i] for i in refs]
        seen += [tuple(text[i:i + 13]) for i in windows.starts]
        passed += keep.tolist()
    counts = {}
    for w in seen:
        counts[w] = counts.get(w, 0) + 1
    assert all(p for w, p in zip(seen, passed) if counts[w] > 1)
    false = sum(p for w, p in zip(seen, passed) if counts[w] == 1)
    assert false <= len(counts) // 10


@pytest.mark.parametrize("bits", [10, 50, 63])
def test_order_with_and_without_places(bits):
    values = np.random.default_rng(bits).integers(0, 1 << bits, 5000)
    values[::7] = values[0]
    order, held = substrings.in_order(values, bits)
    assert (values[order] == held).all() and (held == np.sort(values)).all() and sorted(order.tolist()) == list(range(5000))
