"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_tuples(df: DataFrame, path: str, key: str = "id", value: str = "rank", mode: str = "errorifexists") -> None:
    """Text lines ``(key,value)`` like the reference's output; fails if ``path`` exists."""
    df.select(
        F.concat(F.lit("("), F.col(key).cast("string"), F.lit(","), F.col(value).cast("string"), F.lit(")")).alias("value")
    ).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", partition_by: list[str] | None = None) -> None:
    """Parquet, the better default for a result that is read again."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
