"""Keep-first, keep-last and versioning.

Every operator reduces each map task's rows before the shuffle, so a key with very many rows
sends at most one row per task: ``row_number() = 1`` plans a partial group limit, aggregates
plan a partial aggregate, and the flag operators join on the full order key, which is unique.
Orders must be total on distinct rows; give enough order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabload.operators.joins import join_on


def _one_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    if not order:
        # All columns are keys: rows of a key are equal.
        return df.dropDuplicates([key.strip("`") for key in keys])
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c).asc_nulls_first() for c in order])


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_last_ignoring_case(df: DataFrame, keys: list[str], folded: str, order: list[str]) -> DataFrame:
    """Keep last where one of the key columns compares without case."""
    lowered = df.withColumn("_folded", F.lower(folded))
    return keep_last(lowered, [*keys, "_folded"], order).drop("_folded")


def keep_first_ignoring_case(df: DataFrame, keys: list[str], folded: str, order: list[str]) -> DataFrame:
    lowered = df.withColumn("_folded", F.lower(folded))
    return keep_first(lowered, [*keys, "_folded"], order).drop("_folded")


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def latest_per_group(df: DataFrame, groups: list[str], order: list[str]) -> DataFrame:
    """Newest row of each group."""
    return keep_last(df, groups, order)


def max_per_group(df: DataFrame, groups: list[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*groups).agg(F.max(column).alias(name))


def last_value_first_version(
    df: DataFrame, keys: list[str], version: str, order: list[str], marks: dict[str, str] | None = None,
) -> DataFrame:
    """Per key the values of the highest version and the number of the lowest one.

    ``order`` breaks ties within a version. ``marks`` names, for columns with cells that could not be read, the column that is
    true there: such a cell gives way to the last one of its key that could be read, and its mark stays only where there is none.
    """
    marks = marks or {}
    values = [c for c in df.columns if c not in keys and c != version]
    # One struct: what orders the versions is among the values, so nothing is shuffled twice.
    named = [c.strip("`") for c in order]
    last = F.max(F.struct(version, *order, *[F.col(f"`{c}`") for c in values if c not in named])) if values else None
    readable = [
        F.max(F.when(F.col(f"`{mark}`").isNull(), F.struct(version, *order, F.col(f"`{c}`").alias("_cell")))).alias(f"_read:{c}")
        for c, mark in marks.items()
    ]
    folded = df.groupBy(*keys).agg(
        *([last.alias("_last")] if values else []), F.min(version).alias("_first_version"), *readable
    )
    picked = {c: F.col(f"_last.`{c}`").alias(c) for c in values}
    for c, mark in marks.items():
        unread, before = F.col(f"_last.`{mark}`").isNotNull(), F.col(f"`_read:{c}`")
        picked[c] = F.when(unread, before.getField("_cell")).otherwise(F.col(f"_last.`{c}`")).alias(c)
        picked[mark] = F.when(unread & before.isNull(), True).alias(mark)
    picked[version] = F.col("_first_version").alias(version)
    return folded.select(*[picked.get(c, F.col(c)) for c in df.columns])


def flag_superseded(
    df: DataFrame, groups: list[str], order: list[str], flag: str, exempt: Column | None = None
) -> DataFrame:
    """Add a 0/1 flag to every row but the last of its group; exempt rows neither count nor get it.

    (groups, order) must be unique over the rows that count.
    """
    counted = df if exempt is None else df.filter(~F.coalesce(exempt, F.lit(False)))
    lasts = (
        counted.groupBy(*groups)
        .agg(F.max(F.struct(*order)).alias("_last"))
        .select(*groups, *[F.col(f"_last.{c}").alias(c) for c in order], F.lit(True).alias("_is_last"))
    )
    marked = join_on(df, lasts, [*groups, *order], "left")
    superseded = F.col("_is_last").isNull()
    if exempt is not None:
        superseded = superseded & ~F.coalesce(exempt, F.lit(False))
    return marked.withColumn(flag, superseded.cast("int")).drop("_is_last")


def harmonise_latest(
    df: DataFrame, key: str, value: str, order: list[str], exempt: Column | None = None
) -> DataFrame:
    """Give all rows of a key the value of its last row; exempt rows neither count nor change.

    Only keys with more than one value are joined back. The rows of a key with very many of them
    meet their single entry in a null-safe join, which adaptive execution splits.
    """
    counted = df if exempt is None else df.filter(~F.coalesce(exempt, F.lit(False)))
    wanted = F.struct(F.col(value).alias("value"))
    mixed = (
        counted.groupBy(key)
        .agg(F.max_by(wanted, F.struct(*order)).alias("_latest"), F.min(wanted).alias("_low"), F.max(wanted).alias("_high"))
        .filter(F.col("_low") != F.col("_high"))
        .select(key, "_latest")
    )
    joined = join_on(counted, mixed, [key], "left")
    latest = F.when(F.col("_latest").isNotNull(), F.col("_latest.value")).otherwise(F.col(value))
    changed = joined.withColumn(value, latest).drop("_latest")
    # Exempt rows take no part in the join, so they cannot crowd one of its keys.
    return changed if exempt is None else changed.unionByName(df.filter(F.coalesce(exempt, F.lit(False))))
