"""A training-data pipeline over ``documents``: quality rules, language ID, near-duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept.
All but the last return the columns of ``documents``; the last returns the
pieces of the packed sequences. Nothing is kept in memory between stages: each
result is written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.llm import langid, minhash, packing, quality
from wordgraph.llm.common import read_table
from wordgraph.llm.tokens import public_tokenizer_path
from wordgraph.session import TableCuts

#: A text stays if some language has at least this many times the share of the score that each has where all
#: are equally likely.
MIN_LANGUAGE_SHARE = 1.2


def _row(docs: DataFrame):
    """All columns of a row as one, so that their names clash with none of a stage's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are near some language's histograms; null texts go. Labels with too
    few texts for histograms are judged by the base rules."""
    rows = docs.select(_row(docs), "text", "lang")
    judged = quality.quality(rows, quality.references(docs), key="row")
    return judged.where("kept").select("row.*")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter whose language is recognised; the network learns from the labelled ones."""
    pairs = langid.sample(docs.select(F.col("doc_id").alias("key"), "text", "lang"))
    found = langid.identified(docs, langid.train(pairs) if pairs else None)
    least = MIN_LANGUAGE_SHARE / max(1, len({lang for lang, _ in pairs}))
    recognised = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least)
    return found.where(recognised if pairs else F.lit(True)).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the least id (then the least hash of its
    text); of rows that repeat both id and text, one."""
    rows = docs.select(_row(docs), F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("id"), "text")
    marked = minhash.near_duplicates(rows.select("id", "text"), key="id")
    kept = marked.where("kept").select("id").distinct().alias("k")
    same = F.expr("d.id.doc_id <=> k.id.doc_id and d.id.hash <=> k.id.hash")
    return rows.alias("d").join(kept, same, "left_semi").dropDuplicates(["id"]).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("language_id", language_id), ("near_duplicates", near_duplicates),
          ("packing", pack)]

#: A network's answers and token ids can't be had from SQL: tested against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    cuts = TableCuts(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cuts.cut(stage(spark, docs, sf_dir), name)
    return docs
