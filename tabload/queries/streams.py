"""Streams over files that Spark lands from the driver tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.queries import query, table
from tabload.session import shared_dir
from tabload.sinks.publish import SnapshotStore
from tabload.sources.listing import list_files
from tabload.streaming.ingest import LatestTable, append_batches, claimed, run_available, stream_files, stream_latest


@query("stream_keep_latest", """
    select user_id, event_id, value, event_type, (select count(*) from events where event_id % 50 = 0 and ts is not null) as n_late
    from events where ts is not null
    qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""")
def stream_keep_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The latest event of every user from three landings in no order of time, with repeats, and from one of events that come too late."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, folder, "events").filter("ts is not null").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value"
    )
    part = F.pmod(F.xxhash64("event_id"), F.lit(3))
    again = (F.col("event_id") % 3 == 0) & (part < 2)  # these come a second time with the next landing
    landings = [events.filter((part == at) | (again & (part == at - 1))) for at in range(3)]
    # the state keeps all identities: every event is less than ten years older than the latest; those of the last landing are not
    landings.append(events.filter("event_id % 50 = 0").withColumn("ts", F.col("ts") - F.expr("interval 20 years")))
    latest = LatestTable(spark, f"{root}/latest", ["user_id"], ["ts", "event_id"], events.schema)
    late = 0
    for at, rows in enumerate(landings):
        rows.write.parquet(f"{root}/landing/{at}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landing/*")
        late += stream_latest(stream, ["event_id"], "ts", "3650 days", f"{root}/checkpoint", latest)
    return latest.read().select("user_id", "event_id", "value", "event_type", F.lit(late).cast("bigint").alias("n_late"))


@query("stream_load_replayed", "select event_id, user_id, value from events")
def stream_load_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """A micro-batch that is handled twice leaves the rows of one: it is claimed before it writes, and writes the same folder again."""
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    events = table(spark, folder, "events").select("event_id", "user_id", "value")
    events.write.option("header", "true").csv(f"{root}/landing")
    store = SnapshotStore(spark, f"{root}/store")
    kinds = events.dtypes
    typed = append_batches(f"{root}/rows", lambda rows: rows.select(*[F.col(c).cast(kind).alias(c) for c, kind in kinds]))
    handle = claimed(store, "events", typed)
    run_available(stream_files(spark, f"{root}/landing"), f"{root}/checkpoint", handle)
    handle(list_files(spark, f"{root}/landing", "*.csv"), 0)  # as after a crash between the write and the commit of the batch
    return spark.read.schema(events.schema).option("basePath", f"{root}/rows").parquet(f"{root}/rows/batch=*").select("event_id", "user_id", "value")
