"""Text clean-up expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# What counts as white space at the ends of a text, beyond ASCII too.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def dash(cell: Column) -> Column:
    """En dash to hyphen."""
    return F.replace(cell, F.lit("–"), F.lit("-"))


def strip(cell: Column) -> Column:
    """Remove white space (tabs and line ends too) at both ends."""
    return F.trim(cell, F.lit(WHITE_SPACE))


def canonical(cell: Column) -> Column:
    """Compare form of a text: stripped, without single quotes, NULL if nothing is left."""
    return F.nullif(F.replace(strip(cell), F.lit("'"), F.lit("")), F.lit(""))


def strip_trailing_zero(cell: Column) -> Column:
    """``10.0`` to ``10``; ``10.05`` stays."""
    return F.when(cell.endswith(".0"), F.substring(cell, F.lit(1), F.length(cell) - 2)).otherwise(cell)


def recode(cell: Column, mapping: dict[str, str]) -> Column:
    """Replace whole-cell values, leave all others."""
    if not mapping:
        return cell
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.create_map(*pairs)[cell], cell)


def remove(cell: Column, pattern: str) -> Column:
    return F.regexp_replace(cell, pattern, "")


def remove_literals(cell: Column, literals: tuple[str, ...]) -> Column:
    return F.regexp_replace(cell, "|".join(re.escape(text) for text in literals), "")


def _is_digit(character: Column) -> Column:
    return character.between("0", "9")


def has_third_digit(cell: Column) -> Column:
    """Whether the number after a 13-character parent and ``_`` has more than two digits."""
    return _is_digit(F.substring(cell, 15, 1)) & _is_digit(F.substring(cell, 16, 1)) & _is_digit(F.substring(cell, 17, 1))


def pad_aliquot_id(cell: Column) -> Column:
    """Normalise a 13-character parent, ``_`` and a number.

    Text after one or two digits goes, one digit gets a leading zero. An id with a third digit stays as
    it is: without that digit it would be another record's (``has_third_digit`` tells).
    """
    first, second = F.substring(cell, 15, 1), F.substring(cell, 16, 1)
    single = F.when(
        F.substring(cell, 14, 1) == "_", F.concat(F.substring(cell, 1, 13), F.lit("_0"), first)
    ).otherwise(F.substring(cell, 1, 15))
    return (
        F.when(has_third_digit(cell), cell)
        .when(_is_digit(first) & _is_digit(second), F.substring(cell, 1, 16))
        .when(_is_digit(first), single)
        .otherwise(cell)
    )


def site_prefix(cell: Column) -> Column:
    return F.substring(cell, 1, 2)


def parent_id(cell: Column) -> Column:
    return F.concat(F.substring(cell, 1, 7), F.lit(" 0001"))


def path_part(path: Column, index: int) -> Column:
    """The ``index``-th (from 0) element of a path; NULL past its end."""
    return F.get(F.split(path, "/"), F.lit(index))


def path_parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def path_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def decode_path(path: Column) -> Column:
    """Undo the ``+`` and ``%XX`` encoding of an object key; a malformed escape leaves it as it is."""
    return F.coalesce(F.try_url_decode(path), path)
