"""Spark session settings and the shared folder for intermediate data."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. Anything a cluster sets itself wins, because
# build_session() only applies them to a session it creates.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join input even when a later step then needs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "tabload", master: str | None = None, **conf: str) -> SparkSession:
    """Create (or get) a session with the settings above; ``conf`` keys use ``_`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate data that driver and executors share.

    It is the one the cluster names in ``spark.checkpoint.dir`` or, failing that, the folder set on
    the context. Only a single-machine session (``local``, as in tests) gets a temporary folder of its
    own; elsewhere the executors would not see it, so its absence is an error.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if found:
        return found
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    own = tempfile.mkdtemp(prefix="tabload-checkpoint-")
    context.setCheckpointDir(own)
    return own


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` write to the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write rows as Parquet to the shared folder and read them back: this runs a job and cuts lineage.

    Later reads survive lost executors. The folder belongs to the cluster, which empties it. With ``by``, a column of few values, reads
    that ask for one of them open its files only.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
