import shutil
import uuid

from tests.conftest import rows
from wordgraph import bags_from_events
from wordgraph.streaming import interval_counts_stream

SF = "/root/testdata/sf0.001"


def test_stream_equals_batch(spark, tmp_path):
    src = tmp_path / "events"
    src.mkdir()
    shutil.copy(f"{SF}/events.parquet", src / "part-0.parquet")
    events = spark.read.parquet(str(src))
    stream = spark.readStream.schema(events.schema).parquet(str(src))
    out = interval_counts_stream(stream, "ts", "event_type", "1 hour", late="1 hour")
    name = f"intervals_{uuid.uuid4().hex}"
    # Complete mode also emits the last interval, which no later event closes.
    q = (
        out.writeStream.outputMode("complete")
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / "ckpt"))
        .start()
    )
    q.processAllAvailable()
    q.stop()
    got = rows(spark.sql(f"select v, w, c from {name}"))
    _, batch = bags_from_events(events, "ts", "event_type")
    assert got == rows(batch.select("v", "w", "c"))


def test_bounded_stream_keeps_every_event_of_files_in_any_order(spark, tmp_path):
    from pyspark.sql import functions as F

    from wordgraph.sources.tables import bags_from_events
    from wordgraph.streaming.intervals import run_interval_counts

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    for i, part in enumerate(["ts >= '2024-01-20'", "ts < '2024-01-20' and ts >= '2024-01-10'", "ts < '2024-01-10'"]):
        events.where(part).coalesce(1).write.mode("append").parquet(str(tmp_path / "events"))
    got = run_interval_counts(spark, str(tmp_path / "events"), "*.parquet", "ts", "event_type", "1 day")
    want = bags_from_events(events, "ts", "event_type", "1 day")[1]
    assert got.agg(F.sum("c")).first()[0] == events.where("event_type is not null").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
