"""Unions, unpivot, crosstab and set difference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tabload.functions import text
from tabload.operators.dedup import keep_last
from tabload.operators.joins import anti, shared_columns


def union_all(frames: list[DataFrame]) -> DataFrame:
    """Union by column name; a column missing on one side is NULL there."""
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), frames)


def combine_intents(create: DataFrame, update: DataFrame) -> DataFrame:
    """Both intents of a file kind in one table, so that they are cleaned alike."""
    return union_all([create.withColumn("intent", F.lit("Create")), update.withColumn("intent", F.lit("Update"))])


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` without an equal row (on the shared columns) in ``right``."""
    return anti(left, right, shared_columns(left, right))


def unpivot_flags(df: DataFrame, flags: list[str], name: str, value: str, keep: str = "Yes") -> DataFrame:
    """One row per flag column that holds ``keep``; the other columns are repeated."""
    ids = [c for c in df.columns if c not in flags]
    quoted = [f"`{c}`" for c in ids]
    return df.unpivot(quoted, [f"`{c}`" for c in flags], name, value).filter(F.col(value) == keep)


def assay_targets(df: DataFrame, specimen_types: list[str]) -> DataFrame:
    """Assays by specimen type they apply to; types come from the type table."""
    bare = df.distinct().toDF(
        *[c.replace("Target_biospecimen_is_", "").replace("/", "_") for c in df.columns]
    )
    flags = [c for c in specimen_types if c in bare.columns]
    return unpivot_flags(bare, flags, "Target_Biospecimen_Type", "Is_Present") if flags else bare


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts per row value and listed column value, in one aggregate."""
    return df.groupBy(rows).agg(*[F.count_if(F.col(columns) == value).alias(value) for value in values])


def tagged_union_latest(
    parts: dict[str, DataFrame], tag: str, key: str, strip_literal: str, order: list[str]
) -> DataFrame:
    """Per part: strip a literal from the key and keep each key's last row; then one tagged union."""
    cleaned = []
    for label, part in parts.items():
        keyed = part.withColumn(key, text.remove_literals(F.col(key), (strip_literal,)))
        cleaned.append(keep_last(keyed, [key], order).withColumn(tag, F.lit(label)))
    return union_all(cleaned)
