"""Joins on named keys. NULL keys match each other, as they do in a natural merge.

No side is hinted to be broadcast here: Spark's own size check decides, and beyond that size
the join shuffles both sides, where adaptive execution splits a skewed key. A null-safe key is
hashed by its value and its null flag, so a join to an aggregate on the same key has an exchange
of its own on both sides; that is what lets adaptive execution split the large side there too.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

MARK = "_right_"


def _renamed_keys(right: DataFrame, keys: list[str]) -> DataFrame:
    return right.withColumnsRenamed({key: f"{MARK}{key}" for key in keys})


def _condition(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool) -> Column:
    pairs = [(left[key], right[f"{MARK}{key}"]) for key in keys]
    equal = [one.eqNullSafe(other) if null_safe else one == other for one, other in pairs]
    return reduce(lambda one, other: one & other, equal)


def join_on(
    left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", null_safe: bool = True
) -> DataFrame:
    """Join on keys, which appear once, taken from the left side.

    Without ``null_safe`` (for keys that are never NULL) an earlier partitioning by the keys is kept.
    """
    renamed = _renamed_keys(right, keys)
    joined = left.join(renamed, _condition(left, renamed, keys, null_safe), how)
    return joined.drop(*[f"{MARK}{key}" for key in keys])


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    return [name for name in left.columns if name in right.columns]


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the two sides have in common."""
    return join_on(left, right, shared_columns(left, right), how)


def anti(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return join_on(left, right.select(*keys), keys, "left_anti", null_safe)


def semi(left: DataFrame, right: DataFrame, keys: list[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``left`` whose key is in ``right``."""
    return join_on(left, right.select(*keys), keys, "left_semi", null_safe)


def lookup(left: DataFrame, right: DataFrame, keys: list[str], found: str | None = None) -> DataFrame:
    """Left join to a table with one row per key, with an optional found flag."""
    if found is None:
        return join_on(left, right, keys, "left")
    joined = join_on(left, right.withColumn(found, F.lit(True)), keys, "left")
    return joined.withColumn(found, F.coalesce(F.col(found), F.lit(False)))


def resolve_or_reject(left: DataFrame, right: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Inner enrichment, and the rows that found no partner."""
    return join_on(left, right, keys, "inner"), anti(left, right, keys)


def enrich_distinct(base: DataFrame, extra: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Left join to provenance columns, then distinct rows."""
    on = keys or shared_columns(base, extra)
    return join_on(base, extra.distinct(), on, "left").distinct()


def split_route(
    rows: DataFrame, route: Column,
    first: DataFrame, first_keys: list[str],
    second: DataFrame, second_keys: list[str],
) -> DataFrame:
    """Rows that satisfy ``route`` join ``first``, the others ``second``; union of both results.

    A row whose route is NULL goes the second way, so every row has exactly one route.
    """
    taken = F.coalesce(route, F.lit(False))
    return join_on(rows.filter(taken), first, first_keys).unionByName(
        join_on(rows.filter(~taken), second, second_keys), allowMissingColumns=True
    )


def compare_stored(computed: DataFrame, stored: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Computed rows whose stored value differs or is missing, with both values and a status."""
    old = f"stored_{value}"
    held = stored.select(*keys, F.col(value).alias(old), F.lit(True).alias("_held"))
    joined = join_on(computed, held, keys, "left")
    status = F.when(F.col("_held").isNull(), "missing").otherwise("different")
    return (
        joined.filter(F.col("_held").isNull() | ~F.col(value).eqNullSafe(F.col(old)))
        .withColumn("status", status)
        .drop("_held")
    )


def fits_broadcast(rows: DataFrame, max_rows: int = 1_000_000, max_bytes: int = 256 << 20) -> bool:
    """Whether a table may be sent whole to every executor (runs jobs; meant for staged tables).

    The row count comes from file footers; only few rows are then measured, as JSON text.
    """
    if rows.count() > max_rows:
        return False
    measured = rows.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return (measured.bytes or 0) <= max_bytes


def reachable(large: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a large table whose key occurs in a small one, found by broadcasting the small one's keys.

    A table whose keys are too many to broadcast (checked, which runs jobs) leaves the large one as it
    is: the join that follows then shuffles both.
    """
    wanted = small.select(*keys)
    if not fits_broadcast(wanted):
        return large
    return join_on(large, F.broadcast(wanted), keys, "left_semi")
