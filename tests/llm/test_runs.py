"""Runs against a search of all periods, on texts made of repeats of every kind."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordgraph.llm import runs
from wordgraph.llm.queries import QUERIES


def plain(words, exponent=4, shortest=6):
    """All runs by every period, smallest first: a stretch counts for its smallest period only."""
    n, out = len(words), []
    for p in range(1, n // exponent + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            end = i + p
            if end - start >= max(shortest, exponent * p) and not any(
                    p % q == 0 and all(words[k] == words[k + q] for k in range(start, end - q)) for q in range(1, p)):
                out.append((start, end - start, p))
    return sorted(out)


def texts():
    rng = random.Random(11)
    out = [[], ["a"], ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 4 + ["a"], list("abc") * 40]
    for _ in range(120):
        words = []
        for _ in range(rng.randrange(1, 6)):
            kind = rng.randrange(4)
            if kind == 0:
                words += [f"w{rng.randrange(300)}" for _ in range(rng.randrange(30))]
            else:
                letters = rng.choice([1, 2, 3, 50])
                root = [f"r{rng.randrange(letters)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 13, 16, 17, 31, 40, 64]))]
                if rng.random() < 0.4:
                    root = root * rng.randrange(1, 4) + [f"r{rng.randrange(letters)}"]
                times = rng.choice([2.5, 3.2, 4, 4.3, 5, 6.7, 12])
                words += [root[i % len(root)] for i in range(int(len(root) * times))]
        out.append(words)
    fib = ["a"], ["a", "b"]
    for _ in range(9):
        fib = fib[1], fib[1] + fib[0]
    out += [fib[1], (fib[1][:34] * 5)[:160]]
    for _ in range(60):
        out.append([rng.choice("ab") for _ in range(rng.randrange(1, 90))])
        block = [rng.choice("ab") for _ in range(rng.randrange(1, 12))] * rng.randrange(1, 9)
        out.append((block + [rng.choice("ab")]) * rng.randrange(1, 9))
    return out


def joined(parts):
    numbers, flat, ends = {}, [], []
    for words in parts:
        flat += [numbers.setdefault(w, len(numbers)) for w in words]
        ends.append(len(flat))
        flat.append(10**9 + len(ends))
    return np.array(flat, np.int64), np.array(ends, np.int64)


def test_every_run_is_found():
    parts = texts()
    flat, ends = joined(parts)
    found = runs.find_runs(flat, ends)
    first, want = 0, []
    for words, end in zip(parts, ends.tolist()):
        alone = runs.find_runs(*joined([words])).tolist()
        own = plain(words)
        assert alone == [list(x) for x in own], words
        want += [[s + first, n, p] for s, n, p in own]
        first = end + 1
    assert found.tolist() == want


@pytest.mark.parametrize("period", [1, 2, 3, 5, 6, 9, 11, 12, 21, 23, 47, 63, 64, 65, 100, 341, 342, 500])
def test_every_period(period):
    rng = random.Random(period)
    for exponent in (3.9, 4, 4.5, 9):
        root = [rng.randrange(3 if period > 3 else 10**6) for _ in range(period)]
        words = [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(200))]
        words += [root[i % period] for i in range(int(period * exponent))] + [f"y{rng.randrange(10**6)}" for _ in range(50)]
        assert runs.find_runs(*joined([words])).tolist() == [list(x) for x in plain(words)]


def test_selection_is_locally_consistent():
    """Equal contexts of twice the scale are chosen alike, and no long gap without a short period is left out."""
    rng = np.random.default_rng(3)
    words = np.concatenate([rng.integers(0, 4, 600), np.tile(rng.integers(0, 4, 9), 30), rng.integers(0, 4, 300)])
    levels = runs.mix64(words.astype(np.uint64) + runs._ODD)
    for scale in (1, 2, 4, 8):
        at = set(runs.selected(levels, scale, []).tolist())
        seen = {}
        for i in range(len(words) - 2 * scale + 1):
            assert seen.setdefault(tuple(words[i:i + 2 * scale]), i in at) == (i in at)
        levels = runs.mix64(levels[:-scale] * runs._ODD + levels[scale:])


def brute_row(key, text):
    words = (text or "").encode().split()
    found = plain(words)
    gone = set()
    for s, n, p in found:
        gone.update(range(s + p, s + n))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone).decode()
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (key, len(words), found, kept, len(found),
            *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4))


def rows(frame):
    return sorted(((r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"], r["n_runs"], r["start"], r["length"],
                    r["period"], r["exponent_milli"]) for r in frame.collect()), key=str)


def test_operator(spark, monkeypatch):
    given = [(i, " ".join(words)) for i, words in enumerate(texts())]
    given += [(-1, None), (None, "a a a a a a a"), (5, "\n a\ta a a\x0b a a a"), (5, "\n a\ta a a\x0b a a a"), (600, "é\u0085 " * 9),
              (601, " ".join(f"w{i % 300}" for i in range(2000)))]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("key", F.lit("clash"))
    assert rows(runs.summary(runs.runs(docs))) == sorted((brute_row(*x) for x in given), key=str)
    assert runs.summary(runs.runs(docs.where(F.lit(False)))).count() == 0


def test_groups_of_texts(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(runs, "GROUP_WORDS", 10)
    batch = pa.RecordBatch.from_pydict({"key": [1, 2, 3, 4], "text": ["a " * 8, "b " * 30, None, "c"]})
    assert [[k for k, _ in g] for g in runs._texts(batch, None)] == [[1], [2], [3, 4]]


def by_all_periods(words):
    """``plain`` for long texts: words compared as arrays, one period after the other."""
    numbers, out = {}, []
    flat = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    for p in range(1, len(flat) // 4 + 1):
        same = np.concatenate([[0], (flat[:-p] == flat[p:]).astype(np.int8), [0]])
        for start, end in zip(np.nonzero(np.diff(same) == 1)[0].tolist(), np.nonzero(np.diff(same) == -1)[0].tolist()):
            end += p
            if end - start >= max(6, 4 * p) and not any(
                    p % q == 0 and np.array_equal(flat[start:end - q], flat[start + q:end]) for q in range(1, p)):
                out.append((start, end - start, p))
    return sorted(out)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        words = re.findall("[^\x20\x09-\x0d]+", r["text"] or "")
        n, h = len(words), zlib.crc32(str(r["doc_id"]).encode())
        if h % 10 == 0 and n > 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found, gone = by_all_periods(words), set()
        for s, m, p in found:
            gone.update(range(s + p, s + m))
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        want[r["doc_id"]] = (len(found), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
                             hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest(),
                             hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_synchronising_runs"](spark, sf).collect()}
    assert got == want and sum(x[0] for x in want.values()) > 10
