"""Current tables, from Parquet or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_jdbc(
    spark: SparkSession, options: dict[str, str], table: str,
    split_on: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1,
) -> DataFrame:
    """A database table, read in parallel ranges of a numeric column.

    ``options`` holds url, driver and credentials; filters and projections are pushed down.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if split_on:
        reader = reader.options(
            partitionColumn=split_on, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return reader.load()


def read_mapping(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """File kind to target tables, from rows (file_kind, target_table): of schema size."""
    rows = spark.read.schema("file_kind string, target_table string").json(path).collect()
    mapping: dict[str, list[str]] = {}
    for row in rows:
        mapping.setdefault(row.file_kind, []).append(row.target_table)
    return mapping


def kinds_of(mapping: dict[str, list[str]], table: str) -> list[str]:
    """File kinds that feed a table."""
    return [kind for kind, tables in mapping.items() if table in tables]
