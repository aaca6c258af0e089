"""Ingest of landed files as a stream.

The stream carries paths, not rows: each micro-batch reads its files with the batch reader, which
groups them by header. The stream's checkpoint is the list of files already seen. A replayed
micro-batch writes the same folder again, so its rows never appear twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from tabload.operators.dedup import keep_last
from tabload.sinks.publish import SnapshotStore
from tabload.sources.delimited import read_delimited
from tabload.sources.listing import relative_key

FILE_SCHEMA = StructType([
    StructField("path", StringType()),
    StructField("modificationTime", TimestampType()),
    StructField("length", LongType()),
    StructField("content", BinaryType()),
])


def stream_files(spark: SparkSession, root: str, pattern: str = "*.csv", files_per_batch: int = 10000) -> DataFrame:
    """Stream of landed files in the shape of a listing; file contents are not read."""
    return (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(root)
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("size"))
        .withColumn("key", relative_key(F.col("path"), root))
    )


def run_available(files: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process all files that are there, then stop; ``handle`` gets each batch of files."""
    query = files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def append_batches(target: str, change: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable[[DataFrame, int], None]:
    """Handler that reads a batch's files and keeps the changed rows in the batch's own folder."""

    def handle(files: DataFrame, batch_id: int) -> None:
        rows = read_delimited(files.select("path"))
        if rows is not None:
            change(rows).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return handle


def keep_latest_within(rows: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Drop repeats of a key that arrive within a delay, for sources that deliver more than once."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def batch_digest(files: DataFrame) -> str:
    """What a micro-batch of files holds: number, and sum and exclusive or of the hashes of path, size and time, in any order."""
    one = F.xxhash64("path", "size", "modified_at")
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum(one.cast("decimal(38,0)")).alias("total"), F.bit_xor(one).alias("mixed")).first()
    return f"{row.n}:{row.total}:{row.mixed}"


class ReplayMismatch(Exception):
    """A micro-batch came again with other files than the first time."""


def claimed(store: SnapshotStore, stream: str, handle: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Handler that claims (stream, batch) with a digest of the batch's files before ``handle`` writes anything.

    A batch that is replayed with the same files is handled again (``handle`` must write the same places again, or ask what was
    published); one that comes with other files, as after a lost checkpoint, is refused before it can mix with what is there.
    """

    def guarded(files: DataFrame, batch_id: int) -> None:
        digest = batch_digest(files)
        found = store.reserve(f"streams/{stream}/{batch_id}", digest)
        if found != digest:
            raise ReplayMismatch(f"batch {batch_id} of {stream} holds {digest}, not {found}")
        handle(files, batch_id)

    return guarded


@dataclass
class LatestTable:
    """The latest row per key of a stream: each micro-batch leaves the latest row of the keys it has, reading takes the latest of these.

    A micro-batch writes a folder of its own (again, if it is replayed) and never reads what is stored, so its work grows with the batch.
    ``compact`` folds the folders into one.
    """

    spark: SparkSession
    path: str
    keys: list[str]
    order: list[str]
    schema: StructType

    def handle(self, rows: DataFrame, batch_id: int) -> None:
        keep_last(rows, self.keys, self.order).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        stored = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(f"{self.path}/batch=*")
        return keep_last(stored.select(*[f"`{c}`" for c in self.schema.fieldNames()]), self.keys, self.order)

    def compact(self, path: str) -> LatestTable:
        """The same rows in a new folder, to go on with."""
        self.read().write.parquet(f"{path}/batch=-1")
        return replace(self, path=path)


def stream_latest(
    rows: DataFrame, ident: list[str], event_time: str, delay: str, checkpoint: str, table: LatestTable,
) -> int:
    """Take what has arrived into a table of latest rows; the number of rows that came too late.

    Rows with an identity that came before, within ``delay``, are repeats and count once: the state store holds the identities of
    the last ``delay`` of event time. Rows older than the latest event time of earlier batches less ``delay`` are dropped and counted.
    """
    query = (
        keep_latest_within(rows, ident, event_time, delay).writeStream.foreachBatch(table.handle)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(operator["numRowsDroppedByWatermark"] for progress in query.recentProgress for operator in progress["stateOperators"])
