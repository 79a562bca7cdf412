"""Text-file sources — edge lists, URL pairs and directories of word bags.

All readers are one ``spark.read.text`` scan (any number of files, split
across tasks); nothing is listed or read on the driver beyond the file
listing that every Spark scan makes, and no path of it reaches Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.functions.columns import fields
from wordgraph.operators.numbering import number_rows
from wordgraph.session import TableCuts

EDGE_COMMENT = "#"


def edge_list(spark: SparkSession, path: str, comment: str = EDGE_COMMENT, permissive: bool = False) -> DataFrame:
    """``src bigint, dst bigint`` from white-space separated lines.

    Empty lines and lines starting with ``comment`` are skipped; fields after
    the second are ignored; duplicates and self loops are kept. Strict mode
    (default) raises on a short line or a non-numeric id (ANSI casts and
    array bounds); ``permissive=True`` drops such lines instead.
    """
    lines = spark.read.text(path).where((F.length("value") > 0) & ~F.col("value").startswith(comment))
    parts = lines.select(fields("value").alias("p"))
    if permissive:
        out = parts.select(
            F.expr("try_cast(try_element_at(p, 1) as bigint)").alias("src"),
            F.expr("try_cast(try_element_at(p, 2) as bigint)").alias("dst"),
        ).where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    else:
        out = parts.select(
            F.col("p")[0].cast("bigint").alias("src"),
            F.col("p")[1].cast("bigint").alias("dst"),
        )
    return out


def url_pairs(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """S2 + P1 + A3: ``src string, dst string`` — first two fields, duplicates removed.

    ``#`` lines are data here. Strict mode raises on a line with fewer than two
    fields (including a blank line); ``permissive=True`` skips it. A leading
    blank makes the first field empty (Java split rule), as in the reference.
    """
    parts = spark.read.text(path).select(fields("value").alias("p"))
    if permissive:
        out = parts.where((F.size("p") >= 2) & (F.col("p")[0] != "")).select(
            F.col("p")[0].alias("src"), F.col("p")[1].alias("dst")
        )
    else:
        out = parts.select(F.col("p")[0].alias("src"), F.col("p")[1].alias("dst"))
    return out.distinct()


def _listing(files: DataFrame) -> DataFrame:
    """``path`` of every file of a scan, empty ones too, which give no row: the scan's own listing, dealt to many
    parts and not read by Python."""
    spark = files.sparkSession
    jvm = spark.sparkContext._jvm
    paths = jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(files._jdf.inputFiles())
    listed = spark._jsparkSession.createDataset(paths, jvm.org.apache.spark.sql.Encoders.STRING()).toDF()
    return DataFrame(listed, spark).select(F.col("value").alias("path")).distinct()


def bag_files(spark: SparkSession, path: str, counts: bool = False) -> tuple[DataFrame, DataFrame]:
    """``(vertices(v, path), postings(v, w))`` or ``(vertices, counts(v, w, c))``.

    One file is one bag, one line one word, untouched (no trim, no case fold; an empty line is
    the word ``""``). Vertex ids are the positions of the files in path order, from 0; an empty file is
    a vertex without words.

    Lines are counted per file and word before anything else, so a long file is no key of its raw lines; a file is
    told by a 64-bit hash of its path, tried on the paths until no two are equal, as the path is much longer than a
    word. Ids are numbered in Spark, in ranges of the paths. Both tables are written below the checkpoint folder.
    """
    cuts = TableCuts(spark, "bags")
    files = spark.read.option("recursiveFileLookup", "false").text(path)
    listed = cuts.cut(_listing(files), "listing")
    seed = _telling_seed(listed)
    numbered = number_rows(listed, [F.col("path").asc()], cuts, "paths")
    vertices = cuts.cut(numbered.select("v", "path", _file_key("path", seed).alias("file")), "vertices")
    lines = files.select(_file_key(F.input_file_name(), seed).alias("file"), F.col("value").alias("w"))
    words = cuts.cut(lines.groupBy("file", "w").agg(F.count(F.lit(1)).alias("c")), "words")
    found = words.join(vertices.select("file", "v"), "file")
    return vertices.select("v", "path"), found.select("v", "w", "c") if counts else found.select("v", "w")


def _file_key(path: Column | str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), path)


def _telling_seed(paths: DataFrame, seed: int = 0) -> int:
    """The first seed from ``seed`` by which no two of the distinct ``paths(path)`` have an equal key."""
    while not paths.groupBy(_file_key("path", seed)).count().where("count > 1").isEmpty():
        seed += 1
    return seed
