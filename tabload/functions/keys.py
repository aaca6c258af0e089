"""Composite and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabload.functions.text import strip


def visit_number(cell: Column) -> Column:
    """Canonical text of a visit number: ``Baseline(1)`` is 1, ``01`` and ``1.0`` are ``1``."""
    return F.regexp_replace(strip(cell.cast("string")), r"^(?:0*([0-9]+)(?:\.0)?|Baseline\((1)\))$", "$1$2")


def padded_visit(cell: Column) -> Column:
    """Visits 1 to 9 with a leading zero; all others (10 and up, -1, texts) as they are."""
    return F.when((F.length(cell) == 1) & cell.between("1", "9"), F.concat(F.lit("0"), cell)).otherwise(cell)


def visit_key(participant: Column, visit_type: Column, number: Column) -> Column:
    """``participant : B01``: first letter of the visit type and the padded visit number."""
    return F.concat(participant, F.lit(" : "), F.substring(visit_type, 1, 1), padded_visit(visit_number(number)))


def tagged(cell: Column) -> Column:
    """A cell with its length in front, so that joined cells can be told apart; ``~`` for NULL."""
    text = cell.cast("string")
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def hash_key(*cells: Column) -> Column:
    """Surrogate key from the natural key: the same row gets the same key in every run."""
    return F.md5(F.concat(*[tagged(cell) for cell in cells]))
