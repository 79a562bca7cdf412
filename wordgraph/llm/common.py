"""Helpers shared by the operators of this package."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: blank, tab, line feed, vertical tab, form
#: feed and carriage return. ``bytes.split()`` splits at exactly these.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_CLASS = r"[\x20\x09-\x0D]"

BATCH_ROWS = 1000


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that very long texts fit a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold_ascii(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text modulo ``modulus``; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def text_bytes(column) -> list:
    """The UTF-8 bytes of an Arrow string column; empty where null."""
    import pyarrow as pa

    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


class WordHash(dict):
    """64-bit hashes of words, kept for a bounded number of distinct words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def all(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of consecutive runs ``starts[i] .. starts[i]+lengths[i]-1``, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - lengths), lengths)
