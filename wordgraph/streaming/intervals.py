"""S6 as a stream: word counts per time interval from an event stream.

The reference's bags are files written by a word stream cut into time
intervals. ``interval_counts_stream`` builds the same multiset bags
``(v, w, c)`` from a streaming DataFrame: a watermark bounds the state,
a tumbling window per interval, ``append`` output emits each interval once
it is closed. The batch form is ``sources.tables.bags_from_events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordgraph.functions.columns import EPOCH_NTZ, interval_number, interval_seconds
from wordgraph.session import TableCuts, checkpoint_dir


def interval_counts_stream(events: DataFrame, ts: str, word: str, every: str = "1 hour",
                           late: str | None = "10 minutes") -> DataFrame:
    """``v, w, c`` per closed interval; ``v`` = interval start as whole ``every`` units since 1970.

    A zone-free timestamp is read as UTC. ``late`` bounds the state by a
    watermark, and later events are lost; with ``late=None`` nothing is: for
    bounded input, whose state is its result.
    """
    t = F.col(ts)
    if dict(events.dtypes).get(ts) == "timestamp_ntz":
        # Zone-free wall time read as UTC: seconds since 1970, then an instant.
        t = F.timestamp_seconds(F.timestamp_diff("SECOND", F.expr(EPOCH_NTZ), t))
    if late is None:
        rows = events.select(interval_number(t, every, zoned=True).alias("v"), F.col(word).alias("w"))
        return rows.where(F.col("w").isNotNull()).groupBy("v", "w").agg(F.count(F.lit(1)).alias("c"))
    seconds = interval_seconds(every)
    keyed = events.select(t.alias("_ts"), F.col(word).alias("w")).where(F.col("w").isNotNull())
    agg = (
        keyed.withWatermark("_ts", late)
        .groupBy(F.window("_ts", every).alias("win"), "w")
        .agg(F.count(F.lit(1)).alias("c"))
    )
    return agg.select(
        (F.unix_seconds(F.col("win.start")) / F.lit(seconds)).cast("bigint").alias("v"), "w", "c"
    )


def run_interval_counts(spark: SparkSession, source_dir: str, file_glob: str, ts: str, word: str,
                        every: str = "1 hour", files_per_batch: int = 1, name: str | None = None) -> DataFrame:
    """Run ``interval_counts_stream`` over the files of ``source_dir`` to the end.

    The stream is processed with an available-now trigger in ``update``
    mode: each micro-batch appends the intervals it changed, with their
    current counts, to a table below the shared checkpoint folder. The
    stream's own checkpoint lives there too; a job started again under the
    same ``name`` goes on where it was. Files may come in any order. Counts of an interval only grow, so its final count is the largest one
    written. Returns ``v, w, c``.
    """
    schema = spark.read.parquet(f"{source_dir.rstrip('/')}/{file_glob}").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", file_glob).option(
        "maxFilesPerTrigger", files_per_batch).parquet(source_dir)
    counts = interval_counts_stream(stream, ts, word, every, None)
    root = f"{checkpoint_dir(spark).rstrip('/')}/wordgraph-stream-{name}" if name else TableCuts(spark, "stream").root
    out = f"{root}/updates"

    def sink(batch: DataFrame, batch_id: int) -> None:
        # A batch that is run again only writes the same counts again.
        batch.withColumn("batch", F.lit(batch_id)).write.mode("append").parquet(out)

    q = (
        counts.writeStream.outputMode("update")
        .foreachBatch(sink)
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema("v bigint, w string, c bigint, batch bigint").parquet(out).groupBy("v", "w").agg(
        F.max("c").alias("c")
    )


def append_closed_intervals(spark: SparkSession, source_dir: str, schema, ts: str, word: str, every: str, late: str,
                            root: str) -> DataFrame:
    """Run ``interval_counts_stream`` in append mode over the files of ``source_dir`` that were not read before.

    An interval is emitted once, when the watermark (latest event time seen, less ``late``) has passed its end; events
    of an interval that was closed when their batch began are dropped. All new files make one batch. State and
    output live below ``root``: the next call goes on from there, so files may be added in between. Returns
    ``v, w, c`` of all intervals closed so far.
    """
    stream = spark.readStream.schema(schema).parquet(source_dir)
    counts = interval_counts_stream(stream, ts, word, every, late)
    query = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{root}/closed")
        .option("checkpointLocation", f"{root}/closed-checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema("v bigint, w string, c bigint").parquet(f"{root}/closed")
