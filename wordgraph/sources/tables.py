"""Word bags from tables (S6 and the fixtures): one bag per row key.

* ``bags_from_rows`` — a vertex column and a word column (e.g. order → part).
* ``bags_from_text`` — a vertex column and a whole text; the words are the
  maximal matches of a token regular expression (every word of every text,
  no prefix).
* ``bags_from_events`` — S6, the reference's "time interval" bags: events
  cut into fixed intervals, the interval is the vertex.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordgraph.functions.columns import DOC_TOKEN, doc_tokens, interval_number
from wordgraph.session import spread


def bags_from_rows(df: DataFrame, vertex: str, word: str) -> tuple[DataFrame, DataFrame]:
    """``(vertices(v), postings(v, w))``: distinct words per vertex; null words dropped."""
    vertices = df.select(F.col(vertex).alias("v")).distinct()
    postings = df.where(F.col(word).isNotNull()).select(F.col(vertex).alias("v"), F.col(word).alias("w")).distinct()
    return vertices, postings


def counts_from_rows(df: DataFrame, vertex: str, word: str) -> tuple[DataFrame, DataFrame]:
    """``(vertices(v), counts(v, w, c))``: occurrences per vertex and word."""
    vertices = df.select(F.col(vertex).alias("v")).distinct()
    counts = (
        df.where(F.col(word).isNotNull())
        .groupBy(F.col(vertex).alias("v"), F.col(word).alias("w"))
        .agg(F.count(F.lit(1)).alias("c"))
    )
    return vertices, counts


def text_tokens(df: DataFrame, vertex: str, text: str, token: str = DOC_TOKEN) -> DataFrame:
    """``v, w`` one row per token occurrence of each whole text."""
    return (
        df.select(F.col(vertex).alias("v"), F.explode(doc_tokens(text, token)).alias("w"))
        .where(F.col("w") != "")
    )


def bags_from_text(df: DataFrame, vertex: str, text: str, token: str = DOC_TOKEN,
                   counts: bool = False, vertex_is_key: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(vertices(v), postings(v, w))`` or ``(vertices, counts(v, w, c))`` from whole texts.

    A text without any token is a vertex with no word. When the vertex
    column is a key (one row per bag, the default), the distinct words of a
    bag are found inside its row (``array_distinct``), so the set form needs
    no shuffle at all; otherwise a global ``distinct`` merges the rows.
    """
    src = spread(df.select(vertex, text), vertex)
    vertices = df.select(F.col(vertex).alias("v")).distinct()
    if counts:
        toks = text_tokens(src, vertex, text, token)
        return vertices, toks.groupBy("v", "w").agg(F.count(F.lit(1)).alias("c"))
    if vertex_is_key:
        words = F.explode(F.array_distinct(doc_tokens(text, token))).alias("w")
        return vertices, src.select(F.col(vertex).alias("v"), words).where(F.col("w") != "")
    return vertices, text_tokens(src, vertex, text, token).distinct()


def bags_from_events(df: DataFrame, ts: str, word: str, every: str = "1 hour",
                     counts: bool = True) -> tuple[DataFrame, DataFrame]:
    """Events cut into intervals; the interval key is the vertex.

    The key is the number of whole intervals since 1970-01-01, the same as
    the stream's.
    """
    zoned = dict(df.dtypes)[ts] == "timestamp"
    keyed = df.select(interval_number(ts, every, zoned).alias("v"), F.col(word).alias("w"))
    vertices = keyed.select("v").distinct()
    keyed = keyed.where(F.col("w").isNotNull())
    if counts:
        return vertices, keyed.groupBy("v", "w").agg(F.count(F.lit(1)).alias("c"))
    return vertices, keyed.distinct()
