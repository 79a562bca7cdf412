"""Substring dedup: words of a window that an earlier document holds already go.

Count-min prefilter. The texts are kept in blocks. Every block sketches its
windows: in each of ``DEPTH`` rows the cells that its windows fall in, with
counts up to two, which is all that "repeated" asks for. The sketches are as
wide as the corpus has windows, so they are never whole in one place: the
cells are cut in slices, each slice's sketches are added up in one task, and
every block gets back one bit per cell it sent. Estimates are never below the
true counts, so a window that two places hold is never lost.

Second pass: a block's distinct windows that all rows call repeated are sent,
each once with the least id of its holders in the block, to a task chosen by
the window; there equal windows are grouped exactly and every block learns of
each whether an earlier document lies elsewhere. A window that a third of all
documents hold arrives once per block.

Windows are told apart by two independent 64-bit hashes of their words, taken
together: 128 bits. Only the prefilter uses fewer.

Rows: a null text has no words; a text of fewer words than a window keeps all;
rows that repeat an id don't remove each other's words; a row without an id
neither loses words nor removes any. An empty table gives no rows. Ids are
64-bit numbers. Columns other than the named two are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.llm.blocks import blocks, pack_numbers, unpack_numbers
from wordgraph.llm.common import mix64, ragged
from wordgraph.session import TableCuts

WINDOW = 13
#: Rows of the sketch, and cells per window in each of them: about one window in 64 passes by chance.
DEPTH, CELLS_PER_WINDOW = 2, 8
#: Cells that one task adds up, windows that one task groups, text bytes of a block.
SLICE_CELLS, PART_WINDOWS, BLOCK_BYTES = 1 << 24, 1 << 20, 12 << 20

_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def window_hashes(words: np.ndarray, size: int, odd: np.uint64) -> np.ndarray:
    """One hash per run of ``size`` neighbours, put together from runs of 1, 2, 4, ... words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, at, width, level = None, 0, 1, words
    while True:
        if size & width:
            piece = level[at:at + n]
            out = piece if out is None else mix64(out * odd + piece)
            at += width
        if 2 * width > size:
            return out
        level = mix64(level[:-width] * odd + level[width:])
        width *= 2


class Windows:
    """The windows of a block's documents that have an id: start, document and both hashes of each."""

    def __init__(self, keys: list, sizes: np.ndarray, refs: np.ndarray, words: list, size: int):
        lengths = sizes.astype(np.int64)
        firsts = np.cumsum(lengths) - lengths
        numbered = np.array([k is not None for k in keys], bool)
        counts = np.where(numbered, np.maximum(lengths - size + 1, 0), 0)
        self.starts = ragged(firsts, counts)
        self.docs = np.repeat(np.array([k or 0 for k in keys], np.int64), counts)
        self.hashes = []
        for seed, odd in enumerate(_ODD):
            held = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words))
            self.hashes.append(window_hashes(held[refs], size, odd)[self.starts] if len(self.starts) else np.zeros(0, np.uint64))

    def cells(self, row: int, bits: int) -> np.ndarray:
        """The cell of each window in one row of a sketch of 2**bits cells."""
        seed = np.uint64((0x5851F42D4C957F2D * (row + 1)) & 0xFFFFFFFFFFFFFFFF)
        return (mix64(self.hashes[0] ^ seed) >> np.uint64(64 - bits)).astype(np.int64)

    def repeated(self, bits: int, slices: int, answers: dict) -> np.ndarray:
        """Whether every row of the merged sketch counts a window twice or more."""
        keep = np.ones(len(self.starts), bool)
        for row in range(DEPTH):
            order, cells = in_order(self.cells(row, bits), bits)
            new = np.ones(len(cells), bool)
            new[1:] = cells[1:] != cells[:-1]
            own = cells[new]
            cuts = np.searchsorted(own, np.arange(slices + 1) << (bits - _log2(slices)))
            twice = np.zeros(len(own), bool)
            for s in range(slices):
                n = cuts[s + 1] - cuts[s]
                if n:
                    twice[cuts[s]:cuts[s + 1]] = np.unpackbits(np.frombuffer(answers[row * slices + s], np.uint8), count=n)
            keep[order] &= twice[np.cumsum(new) - 1]
        return keep

    def candidates(self, keep: np.ndarray):
        """Of the kept windows: their order by hashes, the group of each (in that order), each group's hashes
        and the least id in it."""
        order = np.nonzero(keep)[0]
        order = order[np.lexsort((self.docs[order], self.hashes[1][order], self.hashes[0][order]))]
        a, b = self.hashes[0][order], self.hashes[1][order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        return order, np.cumsum(new) - 1, a[new], b[new], self.docs[order][new]


def _log2(n: int) -> int:
    return int(n).bit_length() - 1


def _power(n: float) -> int:
    """The least power of two not below ``n``."""
    return 1 << max(0, int(np.ceil(np.log2(max(1, n)))))


def in_order(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of values below 2**bits, and the values in it; sorted together with their places where both
    fit 64 bits, which is much faster."""
    places = len(values).bit_length()
    if bits + places > 64:
        order = np.argsort(values, kind="stable")
        return order, values[order]
    both = np.sort((values.astype(np.uint64) << np.uint64(places)) | np.arange(len(values), dtype=np.uint64))
    return (both & np.uint64((1 << places) - 1)).astype(np.int64), (both >> np.uint64(places)).astype(np.int64)


def _deltas(sorted_values: np.ndarray) -> bytes:
    return pack_numbers(np.diff(sorted_values, prepend=0))


def _block(table: pa.Table, size: int):
    sizes = table.column("sizes")[0].values.to_numpy()
    words = table.column("words")[0].as_py()
    refs = unpack_numbers(table.column("refs")[0].as_py())
    keys = table.column("keys")[0].as_py()
    return keys, sizes, refs, words, Windows(keys, sizes, refs, words, size)


def _answers(table: pa.Table, kind: int) -> dict:
    return {p: a for k, p, a in zip(*(table.column(c).to_pylist() for c in ("kind", "part", "bits"))) if k == kind}


def sketches(table: DataFrame, size: int, bits: int, slices: int) -> DataFrame:
    """``block, part, cells, twice``: each block's cells per row and slice of the sketch, and which of them it
    fills twice itself."""
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = pa.Table.from_batches([batch.slice(i, 1)])
                block, (*_, windows) = row.column("block")[0].as_py(), _block(row, size)
                parts, cells, twice = [], [], []
                for depth in range(DEPTH):
                    held = np.sort(windows.cells(depth, bits))
                    first = np.nonzero(np.diff(held, prepend=-1))[0]
                    own, counts = held[first], np.diff(first, append=len(held))
                    width = bits - _log2(slices)
                    cuts = np.searchsorted(own, np.arange(slices + 1) << width)
                    for s in range(slices):
                        lo, hi = cuts[s], cuts[s + 1]
                        if lo < hi:
                            parts.append(depth * slices + s)
                            cells.append(_deltas(own[lo:hi] - (s << width)))
                            twice.append(np.packbits(counts[lo:hi] > 1).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(parts), pa.int64()), pa.array(parts, pa.int32()), pa.array(cells, pa.binary()),
                     pa.array(twice, pa.binary())], names=["block", "part", "cells", "twice"])

    return table.select("block", "keys", "sizes", "refs", "words").mapInArrow(
        run, "block long, part int, cells binary, twice binary")


def merged(sent: DataFrame, cells_per_slice: int) -> DataFrame:
    """``kind, block, part, bits, n``: per cell a block sent, whether the sum over all blocks is two or more."""
    def run(group: pa.Table) -> pa.Table:
        # Counts above two say no more than two: they stay within a byte.
        total = np.zeros(cells_per_slice, np.uint8)
        rows = list(zip(group.column("cells").to_pylist(), group.column("twice").to_pylist()))
        for cells, twice in rows:
            at = np.cumsum(unpack_numbers(cells))
            total[at] = np.minimum(total[at] + 1 + np.unpackbits(np.frombuffer(twice, np.uint8), count=len(at)), 2)
        bits, n = [], []
        for cells, _ in rows:
            flags = total[np.cumsum(unpack_numbers(cells))] > 1
            bits.append(np.packbits(flags).tobytes())
            n.append(int(flags.sum()))
        return pa.table({"kind": pa.array([0] * len(rows), pa.int32()), "block": group.column("block"),
                         "part": group.column("part"), "bits": pa.array(bits, pa.binary()), "n": pa.array(n, pa.int64())})

    return sent.groupBy("part").applyInArrow(run, "kind int, block long, part int, bits binary, n long")


def candidates(table: DataFrame, answers: DataFrame, size: int, bits: int, slices: int, parts: int) -> DataFrame:
    """``block, part, hashes, docs``: each block's distinct windows estimated repeated, sorted, with the least id
    that holds each there."""
    def run(texts: pa.Table, given: pa.Table) -> pa.Table:
        out = {"block": [], "part": [], "hashes": [], "docs": []}
        if texts.num_rows:
            *_, windows = _block(texts, size)
            keep = windows.repeated(bits, slices, _answers(given, 0))
            _, _, a, b, docs = windows.candidates(keep)
            cuts = np.searchsorted(a >> np.uint64(64 - _log2(parts)) if parts > 1 else np.zeros(len(a), np.uint64),
                                   np.arange(parts + 1, dtype=np.uint64))
            for p in range(parts):
                lo, hi = cuts[p], cuts[p + 1]
                if lo < hi:
                    out["block"].append(texts.column("block")[0].as_py())
                    out["part"].append(p)
                    out["hashes"].append(np.stack([a[lo:hi], b[lo:hi]]).tobytes())
                    out["docs"].append(docs[lo:hi].astype("<i8").tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int64()), "part": pa.array(out["part"], pa.int32()),
                         "hashes": pa.array(out["hashes"], pa.binary()), "docs": pa.array(out["docs"], pa.binary())})

    held = table.select("block", "keys", "sizes", "refs", "words")
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "block long, part int, hashes binary, docs binary")


def grouped(sent: DataFrame) -> DataFrame:
    """``kind, block, part, bits``: per window a block sent, whether another block has it under a smaller id."""
    def run(group: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, "<u8").reshape(2, -1) for x in group.column("hashes").to_pylist()]
        docs = np.concatenate([np.frombuffer(x, "<i8") for x in group.column("docs").to_pylist()])
        a, b = np.concatenate([x[0] for x in hashes]), np.concatenate([x[1] for x in hashes])
        order = np.lexsort((docs, b, a))
        a, b = a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        least = docs[order][new][np.cumsum(new) - 1]
        earlier = np.empty(len(order), bool)
        earlier[order] = least < docs[order]
        ends = np.cumsum([x.shape[1] for x in hashes])
        bits = [np.packbits(x).tobytes() for x in np.split(earlier, ends[:-1])]
        return pa.table({"kind": pa.array([1] * len(bits), pa.int32()), "block": group.column("block"),
                         "part": group.column("part"), "bits": pa.array(bits, pa.binary())})

    return sent.groupBy("part").applyInArrow(run, "kind int, block long, part int, bits binary")


def cut_words(table: DataFrame, answers: DataFrame, size: int, bits: int, slices: int, parts: int, kind: str) -> DataFrame:
    """``key, n_words, n_removed, kept`` per document, from the blocks and both passes' answers."""
    def run(texts: pa.Table, given: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({"key": pa.array([], texts.schema.field("keys").type.value_type), "n_words": pa.array([], pa.int64()),
                             "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string())})
        keys, sizes, refs, words, windows = _block(texts, size)
        order, group, a, _, least = windows.candidates(windows.repeated(bits, slices, _answers(given, 0)))
        exact = _answers(given, 1)
        cuts = np.searchsorted(a >> np.uint64(64 - _log2(parts)) if parts > 1 else np.zeros(len(a), np.uint64),
                               np.arange(parts + 1, dtype=np.uint64))
        earlier = np.zeros(len(a), bool)
        for p in range(parts):
            n = cuts[p + 1] - cuts[p]
            if n:
                earlier[cuts[p]:cuts[p + 1]] = np.unpackbits(np.frombuffer(exact[p], np.uint8), count=n)
        drops = windows.starts[order[earlier[group] | (least[group] < windows.docs[order])]]
        change = np.bincount(drops, minlength=len(refs) + 1)[:len(refs) + 1]
        change = change - np.concatenate([np.zeros(size, np.int64), change])[:len(change)]
        gone = np.cumsum(change)[:len(refs)] > 0
        ends = np.cumsum(sizes.astype(np.int64))
        before = np.concatenate([[0], np.cumsum(gone)])
        removed = before[ends] - before[ends - sizes]
        kept, at = [], 0
        for end, some in zip(ends.tolist(), removed.tolist()):
            own = refs[at:end] if not some else refs[at:end][~gone[at:end]]
            kept.append(b" ".join(map(words.__getitem__, own.tolist())))
            at = end
        return pa.table({"key": texts.column("keys")[0].values, "n_words": pa.array(sizes.astype(np.int64)),
                         "n_removed": pa.array(removed.astype(np.int64)), "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    held = table.select("block", "keys", "sizes", "refs", "words")
    return held.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"key {kind}, n_words long, n_removed long, kept string")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = WINDOW,
                   cuts: TableCuts | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``key, n_words, n_removed, kept`` for every row of ``docs``; ``kept``: the words left, joined by blanks.

    A word goes if a window of ``size`` words over it also starts in a row with a smaller key. Windows are
    judged on the texts as given.
    """
    spark = docs.sparkSession
    cuts = cuts or TableCuts(spark, "substrings")
    rows = docs.select(F.col(key).alias("key"), F.lit(False).alias("flag"), F.col(text).alias("text"))
    table = cuts.cut(blocks(rows, block_bytes=block_bytes).drop("flags", "counts"), "blocks", compression="zstd")
    tasks = _power(int(spark.conf.get("spark.sql.shuffle.partitions")))
    total = table.agg(F.sum(F.expr(f"aggregate(sizes, 0L, (s, x) -> s + greatest(x - {size - 1}, 0))"))).first()[0] or 0
    bits = max(10, _log2(_power(CELLS_PER_WINDOW * total)))
    slices = min(max(tasks // DEPTH, 1 << max(0, bits - _log2(SLICE_CELLS))), 1 << bits - 1)
    estimates = cuts.cut(merged(sketches(table, size, bits, slices), 1 << bits - _log2(slices)), "estimates")
    found = estimates.where(F.col("part") < slices).agg(F.sum("n")).first()[0] or 0
    parts = max(tasks, _power(found / PART_WINDOWS))
    estimates = estimates.drop("n")
    exact = grouped(candidates(table, estimates, size, bits, slices, parts))
    kind = rows.schema["key"].dataType.simpleString()
    return cut_words(table, estimates.unionByName(exact), size, bits, slices, parts, kind).withColumnRenamed("key", key)
