"""A table landed as files and streamed back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabload.config import CastSpec
from tabload.operators.cast import schema_cast
from tabload.operators.clean import normalise_nulls
from tabload.session import shared_dir
from tabload.streaming.ingest import append_batches, run_available, stream_files


def landed_and_streamed(spark: SparkSession, events: DataFrame) -> DataFrame:
    """Events written as delimited files in two column orders and ingested as a stream.

    A hash of the id decides which of the two a row goes to. The files lie in the shared folder.
    """
    root = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    names = ["event_id", "user_id", "event_type", "value"]
    for part, order in enumerate((names, names[::-1])):
        chosen = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == part).select(*order)
        chosen.write.option("header", "true").csv(f"{root}/landing/{order[0]}")
    spec = CastSpec({"event_id": "INTEGER", "user_id": "INTEGER", "value": "DOUBLE"})
    types = append_batches(f"{root}/rows", lambda rows: schema_cast(normalise_nulls(rows.select(*names)), spec).drop("_bad"))
    run_available(stream_files(spark, f"{root}/landing"), f"{root}/checkpoint", types)
    return spark.read.parquet(f"{root}/rows").select(*names)
