"""Sum-of-squares packing of documents into fixed windows of tokens.

A document of more than a window is cut into full windows, which stand alone,
and a rest. Rests arrive one after another; a level array counts the open
windows by fill. A rest goes to the fill level that makes the sum of the
squared counts least, an empty window being one of the choices; windows that
become full leave the array.

Rows are dealt to groups by a hash and each group packs on its own. What a
group leaves open is packed again: its partly filled windows, as items, meet
those of the other groups in fewer, larger groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.llm.common import small_batches
from wordgraph.llm.tokens import held_word_ids
from wordgraph.session import TableCuts

WINDOW = 2048
#: Rests that a group packs.
GROUP_ITEMS = 8192
END_ID = 1


def token_pieces(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens`` per piece of ``docs(key, text)``.

    A document's ids are those of its text (none for a null or empty one) and
    then ``end_id``, so every row has at least one piece.
    """

    def run(batches):
        encoder = held_word_ids(tokenizer_path)
        for batch in batches:
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for i, found in enumerate(encoder.texts(batch.column("text"))):
                ids = np.append(found, np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start:start + window]
                    rows.append(i)
                    starts.append(start)
                    lengths.append(len(piece))
                    crcs.append(zlib.crc32(piece.tobytes()))
                    totals.append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(rows, pa.int64())),
                 *[pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]],
                names=["key", "start", "length", "ids_crc32", "doc_tokens"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "text").mapInArrow(
        run, f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def pack_sizes(sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sum-of-squares packing of item sizes (1 to ``window``) in the order given.

    Returns each item's window and offset, and the fill of each window. Of
    levels with equal sums the fullest is taken; of windows of one level the
    one that reached it last.
    """
    count = np.zeros(window + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(window + 1)]
    where, offset, fills = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64), []
    far = np.int64(2**40)
    for item, size in enumerate(sizes.tolist()):
        # Change of the sum of squares, less two, if the item goes to level h: at [h] from h to h + size.
        top = window - size
        change = 2 * count[size:window + 1]
        change[top] = -1  # the window becomes full and leaves
        if top:
            level = count[:top + 1]
            change -= 2 * level
            change[level == 0] = far
        # An empty window: its level is not counted, only the new one is.
        fresh = 2 * count[size] - 1
        best = top - int(np.argmin(change[::-1])) if top else 0
        if top and best and change[best] < fresh:
            target = stacks[best].pop()
            count[best] -= 1
        else:
            best, target = 0, len(fills)
            fills.append(0)
        where[item], offset[item] = target, best
        fills[target] = best + size
        if fills[target] < window:
            stacks[fills[target]].append(target)
            count[fills[target]] += 1
    return where, offset, np.array(fills, np.int64)


def _packed(items: DataFrame, window: int) -> DataFrame:
    """``item, bin, at`` for ``items(item, size, group)``: bins are numbered within a group."""

    def run(table: pa.Table) -> pa.Table:
        item = table.column("item").to_numpy()
        # A fixed order that has nothing to do with size: items come as they would from a stream.
        order = np.lexsort((item, item * np.int64(0x9E3779B97F4A7C1) & np.int64(0x7FFFFFFF)))
        sizes = table.column("size").to_numpy()[order]
        where, offset, fills = pack_sizes(sizes, window)
        group = table.column("group")[0].as_py()
        return pa.table({"item": item[order], "bin": (np.int64(group) << 32) + where, "at": offset,
                         "fill": fills[where]})

    return items.groupBy("group").applyInArrow(run, "item long, bin long, at long, fill long")


def pack(pieces: DataFrame, cuts: TableCuts, window: int = WINDOW, group_items: int = GROUP_ITEMS) -> DataFrame:
    """``pieces`` (a written table with ``length``) with ``sequence_id`` and ``offset`` (long).

    A sequence's pieces lie gapless from 0 and hold at most ``window`` tokens.
    Rows are told apart by a number of their own, so repeated rows are packed
    like any others; an empty table gives an empty one.
    """
    rows = cuts.cut(pieces.withColumn("item", F.monotonically_increasing_id()), "items")
    rests = rows.where(F.col("length") < window).select("item", F.col("length").alias("size"))
    groups = max(1, -(-rests.count() // group_items))
    dealt = rests.withColumn("group", F.pmod(F.xxhash64("item"), F.lit(groups)))
    first = cuts.cut(_packed(dealt, window), "first")
    # Windows left open meet those of other groups as items of their own.
    left = first.where(F.col("fill") < window).groupBy("bin").agg(F.first("fill").alias("size"))
    again = max(1, -(-groups // 16))
    second = _packed(left.select(F.col("bin").alias("item"), "size", F.pmod(
        F.xxhash64("bin"), F.lit(again)).alias("group")), window).select(
        F.col("item").alias("bin"), F.col("bin").alias("bin2"), F.col("at").alias("at2"))
    placed = first.join(second, "bin", "left").select(
        "item", F.when(F.col("bin2").isNull(), F.col("bin") * 4 + 1).otherwise(F.col("bin2") * 4 + 2).alias("sequence_id"),
        (F.col("at") + F.coalesce("at2", F.lit(0))).alias("offset"))
    out = rows.join(placed, "item", "left")
    return out.withColumn("sequence_id", F.coalesce("sequence_id", F.col("item") * 4)).withColumn(
        "offset", F.coalesce("offset", F.lit(0).cast("long"))).drop("item")


def pack_documents(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
                   window: int = WINDOW, cuts: TableCuts | None = None) -> DataFrame:
    """``key, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece of every row of ``docs``."""
    small_batches(docs.sparkSession)
    cuts = cuts or TableCuts(docs.sparkSession, "packing")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    packed = pack(token_pieces(rows, tokenizer_path, window), cuts, window)
    return packed.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
