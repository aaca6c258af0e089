"""All-or-nothing publishing of snapshots.

A run writes its tables below ``runs/<run_id>/<attempt>/`` and, when every check has passed, one manifest
row per table or bucket, with the version that follows the one the run has read. Each attempt has a folder of its own, so a
repeated run never writes where a manifest row points. A table with keys lies in
``BUCKETS`` folders by a hash of its key, and a run writes only the buckets its changes touch; readers take the
newest row of each bucket. So a failed run changes nothing, and what did not change stays where it is. A
run whose tables moved on since it read them is refused (``StaleRun``). The next version of a table is claimed by creating a file that
must not be there yet, so of two runs that read the same version one publishes. A run that dies between its claim and
its manifest rows is repeated under its id; until then the table takes no other run.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType
from pyspark.errors import AnalysisException

from tabload.config import DeltaSpec

MANIFEST_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("table_name", StringType()),
    StructField("bucket", IntegerType()),
    StructField("path", StringType()),
    StructField("n_rows", LongType()),
    StructField("version", LongType()),
    StructField("published_at", TimestampType()),
    StructField("digest", StringType()),  # of the bucket's compared columns, see delta.bucket_digests
])


BUCKETS = 64
BUCKET_COLUMN = "_bucket"


@dataclass(frozen=True)
class Head:
    """Current version of a table and the folder of each bucket (None: of the whole table)."""

    version: int
    paths: dict[int | None, str]
    digests: dict[int | None, str | None] = field(default_factory=dict)

    @property
    def bucketed(self) -> bool:
        return None not in self.paths


def bucket_of(keys: list[str]) -> Column:
    """The bucket of a row, from the texts of its key."""
    return F.pmod(F.xxhash64(*[F.col(f"`{key}`").cast("string") for key in keys]), F.lit(BUCKETS)).cast("int")


class StaleRun(Exception):
    """Another run has published one of the tables since this run read it."""

LOG_SCHEMA = StructType([
    StructField("run_id", StringType()),
    StructField("table_name", StringType()),
    StructField("op", StringType()),
    StructField("n_rows", LongType()),
    StructField("error", StringType()),
])


def append_rows(rows: DataFrame, path: str) -> None:
    """Append new rows to a stored table."""
    rows.write.mode("append").parquet(path)


def append_jdbc(rows: DataFrame, options: dict[str, str], table: str) -> None:
    """Append new rows to a database table; each partition writes on its own connection."""
    rows.write.format("jdbc").options(**options).option("dbtable", table).mode("append").save()


def validate(snapshot: DataFrame, spec: DeltaSpec, table: str) -> DataFrame:
    """Row count, repeated keys and missing keys of a snapshot about to be published."""
    per_key = snapshot.groupBy(*spec.keys).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.greatest(*[F.col(k).isNull().cast("int") for k in spec.keys]) if len(spec.keys) > 1 else (
        F.col(spec.keys[0]).isNull().cast("int")
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("repeated_keys"),
        F.coalesce(F.sum(missing * F.col("_n")), F.lit(0)).alias("missing_keys"),
    ).select(F.lit(table).alias("table_name"), "n_rows", "repeated_keys", "missing_keys")


class SnapshotStore:
    """Published tables under one folder. The manifest has a row per table and run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def manifest(self) -> DataFrame:
        try:
            return self.spark.read.schema(MANIFEST_SCHEMA).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], MANIFEST_SCHEMA)

    def heads(self, upto: int | None = None) -> dict[str, Head]:
        """Current version and folders per table: at most one row per table and bucket. ``upto``: as of this version."""
        known = self.manifest() if upto is None else self.manifest().filter(F.col("version") <= upto)
        newest = known.groupBy("table_name", "bucket").agg(F.max(F.struct("version", "path", "digest")).alias("head"))
        rows = newest.collect()
        found: dict[str, Head] = {}
        for name in {row.table_name for row in rows}:
            own = [row for row in rows if row.table_name == name]
            # A table written whole replaces the buckets before it.
            since = max((row.head.version for row in own if row.bucket is None), default=0)
            last = max(row.head.version for row in own)
            paths = {row.bucket: row.head.path for row in own if row.head.version >= since}
            if last > since:
                paths.pop(None, None)
            found[name] = Head(last, paths, {row.bucket: row.head.digest for row in own if row.bucket in paths})
        return found

    def locations(self) -> dict[str, list[str]]:
        """Current folders per table."""
        return {name: list(head.paths.values()) for name, head in self.heads().items()}

    def is_published(self, run_id: str) -> bool:
        return not self.manifest().filter(F.col("run_id") == run_id).isEmpty()

    def read(self, table: str, schema: StructType) -> DataFrame:
        """Current table; an empty one with the given schema if it was never published."""
        return self.open(self.locations().get(table), schema)

    def open(self, paths: list[str] | None, schema: StructType) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def staging(self, folder: str, part: str) -> str:
        return f"{self.root}/runs/{folder}/{part}"

    def stage(self, rows: DataFrame, folder: str, part: str) -> DataFrame:
        """Write rows to the run's folder and read them back: cuts the plan, survives lost executors."""
        path = self.staging(folder, part)
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def stage_counted(self, rows: DataFrame, folder: str, part: str, **metrics: Column) -> tuple[DataFrame, dict[str, int]]:
        """``stage``, and aggregates of the rows gathered while they are written, so that no second job reads them.

        The metrics are taken in the tasks that write, whose results count once, also if a task is run again.
        """
        told = Observation()
        staged = self.stage(rows.observe(told, *[metric.alias(name) for name, metric in metrics.items()]), folder, part)
        return staged, told.get

    def stage_buckets(self, rows: DataFrame, folder: str, table: str, keys: list[str]) -> dict[int, str]:
        """Write rows to the run's folder by bucket; the folder of each bucket that has rows."""
        return self.stage_buckets_counted(rows, folder, table, keys)[0]

    def stage_buckets_counted(self, rows: DataFrame, folder: str, table: str, keys: list[str]) -> tuple[dict[int, str], dict[int, int]]:
        """``stage_buckets`` and the rows of each written bucket, counted while they are written.

        Spark sizes the writing tasks (``REBALANCE``): a large bucket is written by several, as one file each, small ones share a task.
        """
        path = self.staging(folder, f"tables/{table}")
        told = Observation()
        at = F.col(BUCKET_COLUMN)
        placed = rows.withColumn(BUCKET_COLUMN, bucket_of(keys)).hint("rebalance", 4 * BUCKETS, F.col(BUCKET_COLUMN))
        counted = placed.observe(told, *[F.count_if(at == bucket).alias(f"b{bucket}") for bucket in range(BUCKETS)])
        counted.write.mode("overwrite").partitionBy(BUCKET_COLUMN).parquet(path)
        counts = {bucket: told.get[f"b{bucket}"] for bucket in range(BUCKETS)}
        written = {bucket: n for bucket, n in counts.items() if n}
        return {bucket: f"{path}/{BUCKET_COLUMN}={bucket}" for bucket in written}, written

    def reserve(self, name: str, holder: str) -> str:
        """Write a name's holder unless it has one; the holder it has then.

        The file system creates a file only if there is none, which Spark's writers do not offer.
        """
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/claims/{name}")
        system = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            stream = system.create(path, False)
        except Py4JJavaError:
            if not system.exists(path):
                raise
            found = self.spark.read.text(path.toString(), wholetext=True).first()
            return found[0] if found else ""
        stream.write(bytearray(holder, "utf-8"))
        stream.close()
        return holder

    def claim(self, table: str, version: int, run_id: str) -> None:
        """Reserve a version of a table for a run; a run may claim again what it holds."""
        holder = self.reserve(f"tables/{table}/{version}", run_id)
        if holder != run_id:
            raise StaleRun(f"{table}: version {version} is claimed by {holder or 'another run'}")

    def publish(
        self, run_id: str, tables: dict[str, int | dict[int, int]], read: dict[str, Head] | None = None, folder: str | None = None,
        digests: dict[str, dict[int, str]] | None = None,
    ) -> None:
        """Make the run's staged tables the current ones: the last write of a run.

        ``tables`` holds the rows of each table or of each of its written buckets, ``read`` the heads the
        run has read; without it the heads of this moment count. ``folder`` is where the run has staged, its id by default;
        ``digests`` are those of written buckets.
        """
        heads = self.heads()
        read = heads if read is None else read
        moved = sorted(name for name in tables if _version(heads, name) != _version(read, name))
        if moved:
            raise StaleRun(f"{', '.join(moved)}: published by another run meanwhile")
        for name in sorted(tables):  # in one order, so two runs never hold each other up
            self.claim(name, _version(heads, name) + 1, run_id)
        now = datetime.now()
        rows = []
        for name, count in tables.items():
            path, version = self.staging(folder or run_id, f"tables/{name}"), _version(heads, name) + 1
            if isinstance(count, dict):
                known = (digests or {}).get(name, {})
                rows += [(run_id, name, at, f"{path}/{BUCKET_COLUMN}={at}", n, version, now, known.get(at)) for at, n in count.items()]
            else:
                rows.append((run_id, name, None, path, count, version, now, None))
        self.spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{self.root}/manifest")

    def log(self, rows: list[tuple[str, str, str, int, str | None]]) -> DataFrame:
        """Append rows of (run, table, operation, count, error) to the run log."""
        logged = self.spark.createDataFrame(rows, LOG_SCHEMA)
        logged.coalesce(1).write.mode("append").parquet(f"{self.root}/run_log")
        return logged


def _version(heads: dict[str, Head], name: str) -> int:
    return heads[name].version if name in heads else 0
