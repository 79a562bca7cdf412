"""Texts as blocks: a table of distinct words and, in place of each word, its number.

A block holds the texts that one task reads next to each other, up to a number
of bytes. Work on distinct words then meets each word once per block, and what
is joined back to the texts are word numbers, by position, not the words.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wordgraph.llm.common import ragged, text_bytes

BLOCK_BYTES = 40 << 20


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers below 2**32, low and high bytes apart, compressed."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zlib.compress(np.ascontiguousarray(planes).tobytes(), 1)


def unpack_numbers(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4").astype(np.int64)


def word_bundles(words: list[bytes], parts: int) -> list[dict]:
    """Words in bundles by a hash into ``parts``: ``part``, sorted ``words`` and their ``numbers``, packed."""
    part = np.fromiter((zlib.crc32(w) % parts for w in words), np.int64, len(words))
    order = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
    order = order[np.argsort(part[order], kind="stable")]
    used, starts = np.unique(part[order], return_index=True)
    return [{"part": int(x), "words": zlib.compress(b"\n".join(words[i] for i in own), 1), "numbers": pack_numbers(own)}
            for x, own in zip(used, np.split(order, starts[1:]))]


def blocks(docs: DataFrame, fold: bool = False, end: bool = False, parts=None,
           block_bytes: int = BLOCK_BYTES, bundles: int = 0) -> DataFrame:
    """One row per block of ``docs(key, flag, text)``.

    ``block`` (long), ``keys``, ``flags`` and ``sizes`` (one entry per row of
    ``docs``: key, flag, words), ``refs`` (the words' numbers of all texts, one
    after another, packed), ``words`` (binary, by number, most frequent first)
    and ``counts`` (of each word in the rows that are not flagged). ``fold``
    lower-cases A-Z; ``end`` adds a line feed as a last word to each text;
    ``parts`` turns a word into the list of words to be taken in its place;
    with ``bundles``, ``words`` come as ``word_bundles`` of that many parts. A null text is an empty one. Numbers of blocks hold for this one reading of
    ``docs``: write the table before it is used twice.
    """

    def run(batches):
        from pyspark import TaskContext

        part, made = TaskContext.get().partitionId(), 0
        index: dict[bytes, int] = {}
        keys, flags, sizes, refs, held = [], [], [], [], 0

        def row():
            numbers = np.concatenate(refs) if refs else np.zeros(0, np.int64)
            words, lengths = list(index), np.array(sizes, np.int64)
            if parts is not None:
                split = [parts(w) for w in words]
                own: dict[bytes, int] = {}
                flat = [own.setdefault(x, len(own)) for ws in split for x in ws]
                per = np.array([len(ws) for ws in split], np.int64)
                starts = np.cumsum(per) - per
                ends = np.concatenate([[0], np.cumsum(per[numbers])])
                lengths = np.diff(ends[np.concatenate([[0], np.cumsum(lengths)])])
                numbers = np.array(flat, np.int64)[ragged(starts[numbers], per[numbers])]
                words = list(own)
            order = np.argsort(-np.bincount(numbers, minlength=len(words)), kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            numbers = rank[numbers]
            ordered = [words[i] for i in order]
            held_words = pa.array([word_bundles(ordered, bundles) if bundles else ordered], pa.list_(word_type))
            train = numbers[np.repeat(~np.array(flags, bool), lengths)]
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + made], pa.int64()), pa.array([keys]).cast(pa.list_(key_type)),
                 pa.array([flags], pa.list_(pa.bool_())), pa.array([lengths.astype(np.int32)], pa.list_(pa.int32())),
                 pa.array([pack_numbers(numbers)], pa.binary()),
                 held_words,
                 pa.array([np.bincount(train, minlength=len(words)).astype(np.int32)], pa.list_(pa.int32()))],
                names=["block", "keys", "flags", "sizes", "refs", "words", "counts"])

        for batch in batches:
            key_type = batch.schema.field("key").type
            for key, flag, text in zip(batch.column("key").to_pylist(), batch.column("flag").to_pylist(),
                                       text_bytes(batch.column("text"))):
                words = (text.lower() if fold else text).split()
                if end:
                    words.append(b"\n")
                for word in words:
                    if word not in index:
                        index[word] = len(index)
                refs.append(np.fromiter(map(index.__getitem__, words), np.int64, len(words)))
                keys.append(key)
                flags.append(bool(flag))
                sizes.append(len(words))
                held += len(text)
                if held >= block_bytes:
                    yield row()
                    made += 1
                    index.clear()
                    keys, flags, sizes, refs, held = [], [], [], [], 0
        if keys:
            yield row()

    word_type = pa.binary() if not bundles else pa.struct(
        [("part", pa.int32()), ("words", pa.binary()), ("numbers", pa.binary())])
    word_kind = "struct<part: int, words: binary, numbers: binary>" if bundles else "binary"
    kind = docs.schema["key"].dataType.simpleString()
    return docs.select("key", "flag", "text").mapInArrow(
        run, f"block long, keys array<{kind}>, flags array<boolean>, sizes array<int>, refs binary, "
             f"words array<{word_kind}>, counts array<int>")
