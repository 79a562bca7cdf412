"""SimHash fingerprints, and all fingerprints within a Hamming radius.

The terms of a text are its pairs of neighbouring words (its one word, if it
has no more). A term's 64-bit hash votes on each bit of the fingerprint, for
or against, with the letters of its words as weight. Fingerprints near each
other are found through permuted tables: bits are cut into blocks, and each
table has another choice of blocks in front, as its key; two fingerprints
within the radius agree on the key of at least one table.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wordgraph.llm.common import WordHash, mix64, small_batches

BITS = 64
RADIUS = 3
BLOCKS = 5


def fingerprint(words: list[bytes], cache: WordHash) -> int:
    """The 64-bit fingerprint of a text's words; 0 without words."""
    if not words:
        return 0
    h = cache.all(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    if len(words) > 1:
        h = mix64(h[:-1] * np.uint64(3) + mix64(h[1:]))
        sizes = sizes[:-1] + sizes[1:]
    total = int(sizes.sum())
    # Whole numbers, exact in either type, whatever order they are added in.
    kind = np.float32 if total < 2**24 else np.float64
    votes = np.zeros(BITS, kind)
    for i in range(0, len(h), 4096):
        bits = np.unpackbits(h[i:i + 4096].astype(">u8").view(np.uint8)).reshape(-1, BITS)
        votes += sizes[i:i + 4096].astype(kind) @ bits.astype(kind)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big")


def likeness(a: int, b: int) -> float:
    return 1.0 - (a ^ b).bit_count() / BITS


def edited_text(text: str, following: str) -> str:
    """The text with its last half replaced by the start of another, as many code points or all of it."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def with_following(docs: DataFrame, parts: int) -> DataFrame:
    """``docs(key, text)`` in ranges of descending keys: ``part, tail, key, h, text``, sorted in each task.

    The row after a row is the next one of its range; the first row of the
    following range comes once more at the end of a range, marked ``tail``
    (after the last range: the very first row). Null keys come last; rows with
    one key are ordered by a hash of their text. Ranges are cut at
    percentiles of the keys; what the driver holds is one row per range.
    """
    rows = docs.select("key", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    at = [i / parts for i in range(1, parts)]
    cuts = rows.agg(F.percentile_approx("key", at, 10000).alias("p")).first()["p"] if at else []
    bounds = np.array(sorted(set(cuts or [])), np.int64)

    @pandas_udf("int")
    def part_of(key):
        known = key.notna().to_numpy()
        out = np.full(len(key), len(bounds) + 1, np.int32)
        out[known] = len(bounds) - np.searchsorted(bounds, key[known].to_numpy().astype(np.int64), "right")
        return pd.Series(out)

    dealt = rows.withColumn("part", part_of("key"))
    firsts = sorted(dealt.select("part", "key", "h").groupBy("part").agg(
        F.max(F.struct("key", "h")).alias("first")).collect(), key=lambda r: r["part"])
    if not firsts:
        return dealt.withColumn("tail", F.lit(False)).select("part", "tail", "key", "h", "text")
    leads = docs.sparkSession.createDataFrame(
        [(r["part"], r["first"]["key"], r["first"]["h"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)],
        f"part int, first_key {docs.schema['key'].dataType.simpleString()}, first_h long, before int")
    first = F.col("key").eqNullSafe(F.col("first_key")) & (F.col("h") == F.col("first_h"))
    place = lambda part, tail: F.struct(F.col(part).alias("part"), F.lit(tail).alias("tail"))
    spread = dealt.join(F.broadcast(leads), "part").withColumn("place", F.explode(
        F.when(first, F.array(place("part", False), place("before", True))).otherwise(F.array(place("part", False)))))
    out = spread.select("place.part", "place.tail", "key", "h", "text")
    return out.repartition(parts, "part").sortWithinPartitions(
        "part", "tail", F.col("key").desc_nulls_last(), F.col("h").desc())


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per row of ``docs``: its fingerprint and that of its edited text, as hexadecimal strings.

    ``key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``. A null text is an empty one (fingerprint 0); a
    table of one row follows itself. Rows that repeat key and text follow one
    another.
    """
    spark = docs.sparkSession
    small_batches(spark, 500)
    parts = parts or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def run(batches):
        cache = WordHash()
        of = lambda t: fingerprint(t.encode("utf-8").lower().split(), cache)
        held = None  # (part, key, text, fingerprint) of a row that waits for the one after it
        for batch in batches:
            out = []
            for part, tail, k, t in zip(*(batch.column(c).to_pylist() for c in ("part", "tail", "key", "text"))):
                own = of(t)
                if held is not None and held[0] == part:
                    edited = edited_text(held[2], t)
                    changed = of(edited)
                    out.append((held[1], len(held[2]), hashlib.sha256(edited.encode("utf-8")).hexdigest(),
                                f"{held[3]:016x}", f"{changed:016x}", likeness(held[3], changed),
                                likeness(held[3], own)))
                held = None if tail else (part, k, t, own)
            columns = list(zip(*out)) or [[]] * 7
            kinds = [batch.schema.field("key").type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(),
                     pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds)],
                names=["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
                       "near_next"])

    kind = rows.schema["key"].dataType.simpleString()
    return with_following(rows, parts).select("part", "tail", "key", "text").mapInArrow(
        run, f"key {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double").withColumnRenamed("key", key)


def block_masks(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Masks of the tables' keys: every choice of ``blocks - radius`` blocks of bits."""
    if not 0 <= radius < blocks <= BITS:
        raise ValueError("the radius must be smaller than the number of blocks")
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    whole = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(whole, blocks - radius)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``query, found, distance`` for distinct 64-bit numbers ``queries(query)`` and ``prints(found)``.

    All pairs within the radius, each once, from the first table in which its
    keys agree: the join gives out no pair beyond the radius and none twice.
    """
    masks = block_masks(radius, blocks)
    tables = lambda c: F.posexplode(F.array(*[c.bitwiseAND(_signed(m)) for m in masks]))
    left = queries.select("query", tables(F.col("query")).alias("t", "block"))
    right = prints.select("found", tables(F.col("found")).alias("t", "block"))
    x = F.col("query").bitwiseXOR(F.col("found"))
    first = F.coalesce(*[F.when(x.bitwiseAND(_signed(m)) == 0, F.lit(i)) for i, m in enumerate(masks)])
    on = (F.col("l.t") == F.col("r.t")) & (F.col("l.block") == F.col("r.block")) & (F.bit_count(x) <= radius) & (
        first == F.col("l.t"))
    return left.alias("l").join(right.alias("r"), on).select("query", "found", F.bit_count(x).alias("distance"))
