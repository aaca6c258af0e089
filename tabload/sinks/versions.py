"""Earlier versions of published tables.

A folder that a run has written holds its bucket from that run's version on, until a later version writes the bucket (or the
whole table) again. No folder is changed after it was published, so every version can be read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tabload.functions import text
from tabload.operators.joins import join_on
from tabload.sinks.publish import SnapshotStore
from tabload.sources.listing import comparable_path, metadata_path


def read_as_of(store: SnapshotStore, table: str, schema: StructType, version: int) -> DataFrame:
    """The table as its version left it; empty before its first one."""
    head = store.heads(version).get(table)
    return store.open(list(head.paths.values()) if head else None, schema)


def folder_spans(store: SnapshotStore, table: str) -> DataFrame:
    """``path, since, until`` of every folder a table was published in: until the first version that no longer reads it, or NULL."""
    rows, own = store.manifest().filter(F.col("table_name") == table), F.col("version")
    whole = F.col("bucket").isNull()
    later = Window.partitionBy("table_name").orderBy("version").rangeBetween(1, Window.unboundedFollowing)
    same = F.lead(own).over(Window.partitionBy("table_name", "bucket").orderBy("version"))
    # a table written whole ends the buckets before it; the first bucket after it ends it, as all are written then
    until = F.when(whole, F.min(own).over(later)).otherwise(F.least(same, F.min(F.when(whole, own)).over(later)))
    return rows.select("path", own.alias("since"), until.alias("until"))


def _place(path: Column) -> Column:
    return F.regexp_replace(comparable_path(path), "^file:", "")


def version_intervals(store: SnapshotStore, table: str, schema: StructType, keys: list[str]) -> DataFrame:
    """The columns of the table with ``valid_from, valid_to``: one row for each stretch of versions in which a key had one set of values.

    ``valid_to`` is the first version in which it no longer had them, NULL if it has them still. A bucket that was written again without a
    change to the key makes no new row.
    """
    spans = folder_spans(store, table)
    paths = [row.path for row in spans.select("path").collect()]  # one per bucket and version, as the reader needs them
    values = F.struct(*[F.col(f"`{c}`") for c in schema.fieldNames() if c not in keys])
    rows = store.open(paths, schema).withColumn("_place", _place(text.path_parent(metadata_path()))) if paths else (
        store.open(None, schema).withColumn("_place", F.lit(""))
    )
    held = join_on(rows, spans.select(_place(F.col("path")).alias("_place"), "since", "until"), ["_place"]).drop("_place")
    by_key = Window.partitionBy(*keys).orderBy("since")
    goes_on = (F.lag("until").over(by_key) == F.col("since")) & F.lag("_values").over(by_key).eqNullSafe(F.col("_values"))
    marked = held.withColumn("_values", values).withColumn("_new", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    numbered = marked.withColumn("_island", F.sum("_new").over(by_key))
    joined = numbered.groupBy(*keys, "_island").agg(
        F.first("_values").alias("_values"), F.min("since").alias("valid_from"), F.max_by("until", "since").alias("valid_to")
    )
    return joined.select(*[f"`{c}`" if c in keys else f"_values.`{c}`" for c in schema.fieldNames()], "valid_from", "valid_to")
