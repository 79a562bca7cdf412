"""Periodic run detection with string synchronising sets.

A run is a stretch of words with smallest period q, at least ``exponent`` (4) times
as long, which no neighbouring word extends. They are found at dyadic scales
t = 1, 2, 4, ... without looking at pairs of all positions:

* A position i is *selected* at scale t if, among the hashes of the t-word
  windows starting at i .. i+t, the least one is the first or the last. The
  2t words from i alone decide, so equal contexts make equal choices: in a
  stretch of period q the selected positions repeat every q words.
* Windows with a period of at most t/3 are left out of the comparison, as
  their hashes repeat and would select too much or nothing. The stretches that hold
  them are known by then: those of period 1 and 2 come from comparing
  neighbours, longer ones from smaller scales. They supply their small periods
  themselves.
* Selected positions with equal contexts that follow each other propose
  their distance as a period. With contexts of 2t words this meets every run
  of a period from t to 2t; with contexts of 4t words every stretch of 8t
  words with a period over 4t/3 and up to 8t/3, which scale 8t leaves out.

A proposal is checked word by word and extended to both sides as far as the
words agree, so hashes never decide what a run is. The few selected positions
of a scale (about 2 in t) are all that is sorted.

Rows: a null text has no words and no runs; a repeated row has its own result;
an empty table gives no rows; texts are taken whole, whatever their length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.llm.common import mix64, text_bytes

EXPONENT, SHORTEST = 4, 6
#: Texts are searched together up to so many words; a longer text on its own.
GROUP_WORDS = 1 << 19

_ODD = np.uint64(0x9E3779B97F4A7C15)
_LARGEST = np.uint64(0xFFFFFFFFFFFFFFFF)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours, from least values towards both ends of blocks of that width."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, _LARGEST, np.uint64)
    padded[:len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def agreeing(words: np.ndarray, period: int, shortest: int) -> list[tuple[int, int]]:
    """All longest stretches of at least ``shortest`` words in which words ``period`` apart agree."""
    same = np.concatenate([[False], words[:-period] == words[period:], [False]])
    change = np.nonzero(same[1:] != same[:-1])[0]
    starts, ends = change[::2], change[1::2] + period
    long = ends - starts >= shortest
    return list(zip(starts[long].tolist(), ends[long].tolist()))


def _run_length(words: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and ``b`` on agree, forwards or backwards, compared in growing pieces."""
    done, piece = 0, 64
    while True:
        if step > 0:
            x, y = words[a + done:a + done + piece], words[b + done:b + done + piece]
        else:
            lo = max(0, a - done - piece + 1)
            x, y = words[lo:a - done + 1][::-1], words[b - a + lo:b - done + 1][::-1]
        n = min(len(x), len(y))
        differ = np.nonzero(x[:n] != y[:n])[0]
        if len(differ):
            return done + int(differ[0])
        done += n
        if n < piece:
            return done
        piece = min(piece * 4, 1 << 16)


def stretches(words: np.ndarray, proposals: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[int, int, int]]:
    """``start, end, period`` of the longest stretch around each proposed (position, period), each once."""
    at = np.concatenate([p for p, _ in proposals])
    periods = np.concatenate([d for _, d in proposals])
    order = np.lexsort((at, periods))
    at, periods = at[order], periods[order]
    out, i = [], 0
    while i < len(at):
        s, p = int(at[i]), int(periods[i])
        end = s + p + _run_length(words, s, s + p, 1)
        start = s - (_run_length(words, s - 1, s - 1 + p, -1) if s else 0)
        if end - start > p:
            out.append((start, end, p))
        # The next proposal that this stretch does not cover.
        last = i + int(np.searchsorted(periods[i:], p, "right"))
        i = i + 1 + int(np.searchsorted(at[i + 1:last], max(end - p, s + 1)))
    return out


def _primitive(words: np.ndarray, start: int, period: int) -> bool:
    """Whether no part of the period divides it; the stretch is at least twice as long."""
    n, factor, parts = period, 2, set()
    while factor * factor <= n:
        if n % factor == 0:
            parts.add(factor)
            n //= factor
        else:
            factor += 1
    if n > 1:
        parts.add(n)
    own = words[start:start + period]
    return not any(np.array_equal(own, words[start + period // f:start + period // f + period]) for f in parts)


def selected(hashes: np.ndarray, scale: int, periodic: list[tuple[int, int, int]]) -> np.ndarray:
    """The synchronising positions of a scale, from the hashes of all its windows."""
    ids = hashes.copy()
    for start, end, period in periodic:
        if 3 * period <= scale <= end - start:
            ids[start:end - scale + 1] = _LARGEST
    least = sliding_min(ids, scale + 1)
    n = len(least)
    first, last = ids[:n], ids[scale:scale + n]
    return np.nonzero((least < _LARGEST) & ((least == first) | (least == last)))[0]


def _neighbours(at: np.ndarray, contexts: np.ndarray, scale: int, low: float, high: float):
    """Positions and distances of equal contexts that follow each other at a distance from ``low`` to ``high``."""
    at = at[at < len(contexts)]
    held = contexts[at]
    order = np.argsort(held, kind="stable")
    a, h = at[order], held[order]
    near = (h[1:] == h[:-1]) & (a[1:] - a[:-1] >= low) & (a[1:] - a[:-1] <= high)
    return a[:-1][near], (a[1:] - a[:-1])[near]


def find_runs(words: np.ndarray, ends: np.ndarray, exponent: int = EXPONENT, shortest: int = SHORTEST) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of the texts in ``words``, by start and period.

    ``words``: equal words have equal numbers; texts end at ``ends``, each with a number of its own that stands
    nowhere else. ``exponent`` is 4 at least.
    """
    # Periods 1 and 2 straight from neighbours: also the periodic stretches of the smallest scales.
    found = [(s, e, p) for p in (1, 2) if len(words) > p for s, e in agreeing(words, p, 3 * p)]
    periodic = [x for x in found if x[2] == 1 or _primitive(words, x[0], x[2])]
    out = list(periodic)
    lengths = np.diff(ends, prepend=-1) - 1
    longest = int(lengths.max()) if len(lengths) else 0
    levels, scale = {1: mix64(words.astype(np.uint64) + _ODD)}, 1
    while exponent * scale <= longest:
        for width in (2 * scale, 4 * scale):
            if width not in levels and len(levels[width // 2]) > width // 2:
                half = levels[width // 2]
                levels[width] = mix64(half[:-(width // 2)] * _ODD + half[width // 2:])
        at = selected(levels[scale], scale, periodic)
        proposals = [_neighbours(at, levels[w], scale, max(3, low), high) for w, low, high in
                     ((2 * scale, scale, 2 * scale), (4 * scale, 4 * scale / 3, 8 * scale / 3)) if w in levels]
        proposals = [x for x in proposals if len(x[0])]
        fresh = [(s, e, p) for s, e, p in stretches(words, proposals) if e - s >= 3 * p and _primitive(words, s, p)] \
            if proposals else []
        out += fresh
        known = set(periodic)
        periodic += [x for x in fresh if x not in known]
        del levels[scale]
        scale *= 2
    rows = sorted({(s, e - s, p) for s, e, p in out if e - s >= max(shortest, exponent * p)})
    return np.array(rows, np.int64).reshape(-1, 3)


def _texts(batch, edit):
    """Groups of texts (positions in the batch, their words) of a bounded number of words."""
    held, size = [], 0
    for i, (key, text) in enumerate(zip(batch.column("key").to_pylist(), text_bytes(batch.column("text")))):
        words = text.split()
        if edit is not None and words:
            words = edit(key, words)
        if held and size + len(words) > GROUP_WORDS:
            yield held
            held, size = [], 0
        held.append((key, words))
        size += len(words)
    if held:
        yield held


def runs(docs: DataFrame, key: str = "doc_id", text: str = "text", exponent: int = EXPONENT, shortest: int = SHORTEST,
         edit: Callable[[object, list], list] | None = None) -> DataFrame:
    """``key, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs``: an array of ``start, length, period`` (word numbers) by start and period. ``collapsed``: the words
    left, joined by blanks, when of each run only the first period stays. ``edit`` maps a row's key and words
    (bytes) to the words that are searched.
    """
    def run(batches):
        for batch in batches:
            for group in _texts(batch, edit):
                numbers: dict[bytes, int] = {}
                for _, words in group:
                    for w in words:
                        if w not in numbers:
                            numbers[w] = len(numbers)
                sizes = np.array([len(words) for _, words in group], np.int64)
                ends = np.cumsum(sizes + 1) - 1
                flat = np.empty(int(ends[-1]) + 1, np.int64)
                for (_, words), end in zip(group, ends.tolist()):
                    flat[end - len(words):end] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
                flat[ends] = len(numbers) + np.arange(len(group))
                found = find_runs(flat, ends, exponent, shortest)
                change = np.zeros(len(flat) + 1, np.int64)
                np.add.at(change, found[:, 0] + found[:, 2], 1)
                np.add.at(change, found[:, 0] + found[:, 1], -1)
                gone = np.cumsum(change)[:-1] > 0
                per = np.searchsorted(found[:, 0], np.concatenate([[-1], ends]))
                lists, kept = [], []
                for i, (_, words) in enumerate(group):
                    first = int(ends[i]) - len(words)
                    own = found[per[i]:per[i + 1]]
                    lists.append([{"start": s - first, "length": n, "period": p} for s, n, p in own.tolist()])
                    if len(own):
                        words = [w for w, g in zip(words, gone[first:first + len(words)].tolist()) if not g]
                    kept.append(b" ".join(words))
                entry = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in group], batch.schema.field("key").type), pa.array(sizes),
                     pa.array(lists, pa.list_(entry)), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["key", "n_words", "runs", "collapsed"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, "
                                "collapsed string").withColumnRenamed("key", key)


def summary(found: DataFrame) -> DataFrame:
    """``found`` (of ``runs``) with ``n_runs`` and the longest run (ties: least start, then period) as ``start,
    length, period, exponent_milli``, null without one."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    out = found.withColumn("n_runs", F.size("runs").cast("long")).withColumn("_best", best)
    return out.select(*[c for c in out.columns if c != "_best"], (-F.col("_best.start")).alias("start"), F.col("_best.length").alias("length"),
                      (-F.col("_best.period")).alias("period"),
                      F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"))
