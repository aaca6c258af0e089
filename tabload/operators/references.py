"""References between tables: which rows refer to nothing, and which fall with them.

Every reference is a list of columns with a name of its own, so a table may refer to one parent several times and by
several columns at once. All references of a table are checked in one pass: a row's references become (name, value) pairs,
the values of all parents meet them in one anti join, and what is missing is put together per row again.

A row that is lost takes with it the rows that refer to it, and these take others (``cascade``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tabload.operators.joins import anti, join_on, semi


@dataclass(frozen=True)
class Reference:
    """Columns of a child that must be found in columns of a parent. A reference with a NULL in it refers to nothing."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


PAIR = ["_reference", "_value"]


def _value(columns: list[Column], kinds: list[DataType]) -> Column:
    """A comparable form of several columns: each in the type of the parent, as text; one that does not fit stays as told."""
    return F.array(*[F.coalesce(c.try_cast(kind).cast("string"), c.cast("string")) for c, kind in zip(columns, kinds, strict=True)])


def _pairs(rows: DataFrame, kept: list[str], named: list[tuple[str, tuple[str, ...], list[DataType]]]) -> DataFrame:
    """``kept`` columns and one (name, value) pair for each reference that is not NULL."""
    pairs = []
    for name, columns, kinds in named:
        cells = [F.col(f"`{c}`") for c in columns]
        there = reduce(lambda one, other: one & other, [c.isNotNull() for c in cells])
        pairs.append(F.when(there, F.struct(F.lit(name).alias(PAIR[0]), _value(cells, kinds).alias(PAIR[1]))))
    each = rows.select(*[F.col(f"`{c}`") for c in kept], F.explode(F.array_compact(F.array(*pairs))).alias("_pair"))
    return each.select(*[f"`{c}`" for c in kept], *[f"_pair.{c}" for c in PAIR])


def _kinds(reference: Reference) -> list[DataType]:
    return [reference.parent.schema[c].dataType for c in reference.parent_columns]


def missing_pairs(pairs: DataFrame, references: list[Reference], few: bool = False) -> DataFrame:
    """The distinct (name, value) pairs that no parent has.

    Pass ``few`` only after a check of the size of the child's references; they are then broadcast to the parents, whose other
    rows take no part.
    """
    wanted = pairs.select(*PAIR).distinct()
    held = reduce(DataFrame.unionByName, [
        _pairs(r.parent, [], [(r.name, r.parent_columns, _kinds(r))]) for r in references
    ])
    if few:
        held = semi(held, F.broadcast(wanted), PAIR)
    return anti(wanted, held, PAIR)


def broken(child: DataFrame, key: list[str], references: list[Reference], few: bool = False) -> DataFrame:
    """``key`` and the sorted names of the references that are broken (``broken``), for rows that have any.

    ``key`` tells the rows of ``child`` apart.
    """
    pairs = _pairs(child, key, [(r.name, r.columns, _kinds(r)) for r in references])
    lost = join_on(pairs, missing_pairs(pairs, references, few), PAIR)
    return lost.groupBy(*[f"`{c}`" for c in key]).agg(F.sort_array(F.collect_set(PAIR[0])).alias("broken"))


def cascade(
    child: DataFrame, key: list[str], lost: DataFrame, own: list[Reference], stage: Callable[[DataFrame, str], DataFrame],
) -> DataFrame:
    """``key, broken, depth`` of all rows that fall: those of ``lost`` (depth 0) and those that refer to fallen rows.

    ``own`` are the references of ``child`` to its own table, each with the rows that stand whatever happens (those of the stored
    table) as parent. A value stands as long as one row that has it stands. Each round starts from the rows that fell in the
    one before and is staged; the search ends when none falls. So it takes as many rounds as the longest chain of
    fallen rows, and moves the fallen rows and what refers to them, once.
    """
    named = [(r.name, r.columns, _kinds(r)) for r in own]
    offered = stage(_pairs(child, key, [(r.name, r.parent_columns, _kinds(r)) for r in own]), "offered")
    pairs = _pairs(child, key, named)
    # references that rest on rows of this child alone
    resting = stage(join_on(pairs, missing_pairs(pairs, own), PAIR), "resting")
    frontier = stage(lost.select(*[f"`{c}`" for c in key], "broken", F.lit(0).alias("depth")), "lost-0")
    rounds = [frontier]
    while not frontier.isEmpty():
        fallen = reduce(DataFrame.unionByName, rounds).select(*[f"`{c}`" for c in key])
        at_stake = semi(offered, frontier, key).select(*PAIR).distinct()
        standing = anti(semi(offered, at_stake, PAIR), fallen, key)
        gone = anti(at_stake, standing, PAIR)
        next_ = anti(join_on(resting, gone, PAIR), fallen, key).groupBy(*[f"`{c}`" for c in key]).agg(
            F.sort_array(F.collect_set(PAIR[0])).alias("broken")
        )
        frontier = stage(next_.withColumn("depth", F.lit(len(rounds))), f"lost-{len(rounds)}")
        rounds.append(frontier)
    return reduce(DataFrame.unionByName, rounds)
