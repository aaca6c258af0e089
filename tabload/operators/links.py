"""Link tables, surrogate numbers and load order."""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tabload.operators.joins import anti, join_on, semi

KEYS_A_RANGE = 16  # sampled keys between two bounds
RANGES = 256  # at least so many


def link_table(
    items: DataFrame, base: DataFrame, on: list[str], pair: list[str],
    stored: DataFrame, known: DataFrame, known_key: str,
) -> DataFrame:
    """New (owner, item id) pairs: items joined with their base table, minus stored, owners known.

    A pair with a missing half is none; so the distinct pairs stay where they are for the anti join.
    """
    pairs = join_on(items, base, on).select(*pair).na.drop("any").distinct()
    return semi(anti(pairs, stored, pair, null_safe=False), known, [known_key], null_safe=False)


def number_rows(
    df: DataFrame, order: list[str | Column], name: str, start: int | Column = 1, ranges: int | None = None,
) -> DataFrame:
    """Dense numbers from ``start`` in the given order, which must be total, without a single-task sort.

    Range bounds come from a sample of the sort keys (those with the smallest hashes) by a scalar subquery, so a row's
    range is an expression of its key alone: no job runs while the plan is built, and a lost executor changes
    nothing. Rows are numbered within their range and shifted by the sizes of the ranges before it; that
    list has a row per range, so it may be broadcast. There are as many ranges as shuffle partitions, which follow the size of the data,
    and ``RANGES`` at least. A row finds its range in two steps, among every ``width``-th bound and then among those up to the next.
    """
    ranges = ranges or max(RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    width = isqrt(ranges - 1) + 1
    key = F.struct(*order)
    keyed = df.withColumn("_key", key)
    sample = keyed.select("_key").orderBy(F.xxhash64("_key")).limit(KEYS_A_RANGE * ranges)
    listed = sample.agg(F.sort_array(F.collect_list("_key")).alias("keys")).select(
        F.filter("keys", lambda _, at: at % KEYS_A_RANGE == KEYS_A_RANGE - 1).alias("bounds")
    )
    wide = listed.select(F.filter("bounds", lambda _, at: at % width == width - 1).alias("wide"))
    block = F.size(F.filter("_wide", lambda bound: bound <= F.col("_key"))) * width
    within = F.size(F.filter(F.slice("_bounds", F.col("_block") + 1, width), lambda bound: bound <= F.col("_key")))
    ranged = keyed.withColumns({"_bounds": listed.scalar(), "_wide": wide.scalar()}).withColumn("_block", block).withColumn(
        "_range", F.col("_block") + within
    ).drop("_bounds", "_wide", "_block")
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_key"))
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        ranged.withColumn("_place", place)
        .join(F.broadcast(offsets), "_range")
        .withColumn(name, (F.col("_before") + F.col("_place") - 1 + first).cast("bigint"))
        .drop("_range", "_place", "_key", "_before")
    )


def assign_surrogates(new_keys: DataFrame, existing: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Numbers for natural keys that have none yet, from the highest existing number on."""
    unknown = anti(new_keys.select(*keys).distinct(), existing, keys)
    top = existing.agg((F.coalesce(F.max(name), F.lit(0)) + 1).alias("next")).scalar()
    return number_rows(unknown, keys, name, top)


def load_order(parents: dict[str, set[str]]) -> list[list[str]]:
    """Tables in waves: each table after the tables it refers to.

    Parents that are not loaded in this run count as done. A table that refers to itself is
    checked against its own rows, so that is no obstacle; a longer cycle is an error.
    """
    waiting = {table: (refs & set(parents)) - {table} for table, refs in parents.items()}
    waves: list[list[str]] = []
    while waiting:
        ready = sorted(table for table, refs in waiting.items() if not refs)
        if not ready:
            raise ValueError(f"tables refer to each other in a cycle: {sorted(waiting)}")
        waves.append(ready)
        waiting = {table: refs - set(ready) for table, refs in waiting.items() if table not in ready}
    return waves
