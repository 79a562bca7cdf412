"""BPE by a table of distinct words: encode each word once, join ids back by position.

Words are split where Spark reads the texts; a block keeps its texts as word
numbers. A block's distinct words travel in bundles, one packed row for each
hash part: equal words of all blocks meet in one part, where each distinct word
is encoded by the tokenizers library one time, and a bundle's ids go back to its
block in the bundle's order. Decoding takes the piece of each id.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.llm.blocks import blocks, pack_numbers, unpack_numbers
from wordgraph.llm.common import ragged, small_batches
from wordgraph.llm.tokens import encode_words, load, word_parts
from wordgraph.session import TableCuts


def piece_table(spark: SparkSession, tokenizer_path: str) -> DataFrame:
    """``id, piece``: the tokenizer's vocabulary, special tokens included (bounded by its file)."""
    vocabulary = load(tokenizer_path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame(sorted((i, piece) for piece, i in vocabulary.items()), "id int, piece string")


def word_ids(bundles: DataFrame, tokenizer_path: str) -> DataFrame:
    """``block, part, lengths, ids`` (packed, by the bundle's words) for ``bundles(block, part, words)``.

    Each distinct word is encoded once: the words of one part are held while its bundles pass by.
    """

    def run(batches):
        tokenizer = load(tokenizer_path)
        last, known = None, {}
        for batch in batches:
            lengths, ids = [], []
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("words").to_pylist()):
                if part != last:
                    last, known = part, {}
                words = zlib.decompress(packed).split(b"\n")
                fresh = [w for w in words if w not in known]
                known.update((w, np.array(x, "<u4").tobytes()) for w, x in zip(fresh, encode_words(tokenizer, fresh)))
                found = [known[w] for w in words]
                lengths.append(pack_numbers(np.array([len(x) // 4 for x in found])))
                ids.append(pack_numbers(np.frombuffer(b"".join(found), "<u4")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("part"), pa.array(lengths, pa.binary()),
                 pa.array(ids, pa.binary())], names=["block", "part", "lengths", "ids"])

    dealt = bundles.repartition("part").sortWithinPartitions("part", "block")
    return dealt.mapInArrow(run, "block long, part int, lengths binary, ids binary")


def _joined(docs: DataFrame, tokenizer_path: str, key: str, text: str, cuts: TableCuts | None, make, columns: str):
    """``key`` and ``columns`` per row of ``docs``; ``make`` turns a text's ids into the values of ``columns``.

    Texts (as word numbers) and their words' ids meet by block.
    """
    spark = docs.sparkSession
    small_batches(spark)
    cuts = cuts or TableCuts(spark, "bpe")
    rows = docs.select(F.col(key).alias("key"), F.lit(False).alias("flag"), F.col(text).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = cuts.cut(blocks(rows, parts=word_parts, bundles=parts).drop("flags", "counts"), "blocks", compression="zstd")
    back = word_ids(table.select("block", F.inline("words")).select("block", "part", "words"), tokenizer_path)
    names = [c.split()[0] for c in columns.split(", ")]

    def run(texts: pa.Table, ids: pa.Table) -> pa.Table:
        unpacked = {c: [unpack_numbers(x) for x in ids.sort_by("part").column(c).to_pylist()] for c in ("lengths", "ids")}
        held, flat = (np.concatenate([np.zeros(0, np.int64), *unpacked[c]]) for c in ("lengths", "ids"))
        places = np.concatenate([np.zeros(0, np.int64), *map(unpack_numbers, texts.column("places")[0].as_py())])
        lengths, starts = np.zeros(len(held), np.int64), np.zeros(len(held), np.int64)
        lengths[places], starts[places] = held, np.cumsum(held) - held
        flat = flat.astype(np.uint32)
        refs = unpack_numbers(texts.column("refs")[0].as_py())
        sizes = texts.column("sizes")[0].values.to_numpy()
        out, at = [], 0
        for n in sizes.tolist():
            own = refs[at:at + n]
            at += n
            out.append(make(flat[ragged(starts[own], lengths[own])] if n else flat[:0]))
        arrays = {"key": texts.column("keys")[0].values}
        for i, name in enumerate(names):
            arrays[name] = pa.array([x[i] for x in out])
        return pa.table(arrays)

    kind = rows.schema["key"].dataType.simpleString()
    texts = table.select("block", "keys", "sizes", "refs", F.col("words.numbers").alias("places"))
    met = texts.groupBy("block").cogroup(back.groupBy("block"))
    return met.applyInArrow(run, f"key {kind}, {columns}").withColumnRenamed("key", key)


def encode(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
           cuts: TableCuts | None = None) -> DataFrame:
    """``key, ids`` (array<bigint>) for every row of ``docs``; a null text has no ids."""
    return _joined(docs, tokenizer_path, key, text, cuts, lambda ids: (ids.astype(np.int64),), "ids array<bigint>")


def round_trip(docs: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text",
               cuts: TableCuts | None = None) -> DataFrame:
    """``key, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    The digests are of the ids as little-endian unsigned 32-bit integers and of
    the decoded text (pieces joined by blanks, as this tokenizer decodes) in
    UTF-8. Null and empty texts have no ids and decode to the empty text. The
    id-to-piece table is bounded by the tokenizer's vocabulary: it is sent to
    all tasks, where a text's ids are joined with it by id.
    """
    table = sorted((r["id"], r["piece"]) for r in piece_table(docs.sparkSession, tokenizer_path).collect())
    pieces = docs.sparkSession.sparkContext.broadcast(dict(table))

    def make(ids):
        decoded = " ".join(map(pieces.value.__getitem__, ids.tolist()))
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(decoded.encode("utf-8")).hexdigest())

    return _joined(docs, tokenizer_path, key, text, cuts, make,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string")
