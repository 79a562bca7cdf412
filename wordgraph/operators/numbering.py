"""Gapless row numbers in an order, without all rows in one task and none on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordgraph.session import TableCuts


def number_rows(df: DataFrame, order: list[Column], cuts: TableCuts, name: str = "numbered", number: str = "v") -> DataFrame:
    """``df`` with ``number`` from 0 in the given order, which must tell rows apart.

    Rows are dealt to ranges of the order and numbered within their range; the
    sizes of the ranges before are added. Only the sizes meet: one row per
    range, so at most ``spark.sql.shuffle.partitions`` of them.
    """
    ranged = df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    within = Window.partitionBy("_range").orderBy(*order)
    held = cuts.cut(ranged.withColumn("_rank", F.row_number().over(within).cast("bigint") - 1), name)
    sizes = held.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    up_to = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_range", F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"))
    return held.join(F.broadcast(before), "_range").withColumn(number, F.col("_before") + F.col("_rank")).select(*df.columns, number)
