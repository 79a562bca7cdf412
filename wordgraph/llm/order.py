"""Global row numbers without bringing all rows to one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgraph.session import TableCuts


def numbered(df: DataFrame, order: list[Column], cuts: TableCuts, name: str = "parts") -> tuple[DataFrame, int]:
    """``df`` with a gapless ``row_no`` from 0 in the given order, and the number of rows.

    Rows are dealt to ranges of the order (ties are broken by where a row was
    read, so that many equal rows fill several ranges), numbered within their
    range and written; a second step adds the sizes of the ranges before. The
    only thing that meets in one place is one count per range. Rows that are
    equal in ``order`` get their numbers in any order.
    """
    spark = df.sparkSession
    tie = F.col("_tie")
    keys = [*order, tie.asc()]
    ranged = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(*keys)
        .withColumn("_range", F.spark_partition_id())
    )
    within = Window.partitionBy("_range").orderBy(*keys)
    written = cuts.cut(ranged.withColumn("_rank", F.row_number().over(within) - 1).drop("_tie"), name)
    counts = written.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range: bounded by spark.sql.shuffle.partitions.
    sizes = {r["_range"]: r["_n"] for r in counts.collect()}
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    offsets = spark.createDataFrame(before, "_range int, _before long")
    out = written.join(F.broadcast(offsets), "_range").withColumn("row_no", F.col("_before") + F.col("_rank"))
    return out.drop("_range", "_before", "_rank"), total
