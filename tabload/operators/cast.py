"""Typing of all-text tables from declared column types."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType

from tabload.config import CastSpec
from tabload.functions import dates, nulls, numbers

INTEGERS = ("INTEGER", "INTERGER", "INT", "BIGINT", "SMALLINT", "TINYINT")
NUMBERS = ("FLOAT", "DOUBLE", "DECIMAL", "REAL")


def base_type(declared: str) -> str:
    return declared.split("(")[0].strip().upper()


def decimal_type(declared: str) -> DecimalType | None:
    """Precision and scale of ``DECIMAL(p, s)``; None for other types and for a bare ``DECIMAL``."""
    found = re.fullmatch(r"\s*(?:DECIMAL|NUMERIC)\s*\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)\s*", declared, re.IGNORECASE)
    return DecimalType(int(found[1]), int(found[2] or 0)) if found else None


def typed(cell: Column, declared: str) -> Column:
    """One text cell in its declared type, NULL where it does not fit."""
    told, parse, value, _ = _steps(declared)
    return value(parse(told(cell)))


def _steps(declared: str):
    """How to read a cell: text that is due a value, parsed value, stored value, and the failure test
    on (text, parsed, stored)."""
    kind = base_type(declared)

    def unparsed(text, parsed, stored):
        return text.isNotNull() & parsed.isNull()

    def not_whole(text, parsed, stored):
        return text.isNotNull() & (parsed.isNull() | (stored.isNull() & nulls.number_sentinel_to_null(parsed).isNotNull()))

    def same(cell):
        return cell

    if kind in INTEGERS:
        return numbers.told_number, numbers.to_exact, numbers.as_whole, not_whole
    if exact := decimal_type(declared):
        return numbers.told_number, numbers.to_exact, numbers.as_decimal(exact), not_whole
    if kind in NUMBERS:
        return numbers.told_number, numbers.to_number, numbers.as_double, unparsed
    if kind == "DATE":
        return nulls.date_text_to_null, dates.parse_date, same, unparsed
    if kind in ("DATETIME", "TIMESTAMP"):
        return nulls.date_text_to_null, dates.parse_timestamp, same, unparsed
    if kind == "TIME":
        return nulls.blank_tokens, dates.parse_time, same, unparsed
    return same, same, same, None


def schema_cast(df: DataFrame, spec: CastSpec, mixed: str | None = None) -> DataFrame:
    """Type every column; columns without a declared type stay text.

    Cells that hold a value but not one of the declared type become NULL, and the names of their
    columns are listed in the reject column. Texts, parsed values and stored values are separate
    projections, so each cell is parsed once.

    ``mixed`` names a VARIANT column for what did not fit: an object with the text of each such cell under its column's name, NULL
    where every cell fits.
    """
    texts, parsed, stored, failed, unfit = [], [], [], [], []
    for at, name in enumerate(df.columns):
        declared = spec.types.get(name, "VARCHAR(255)")
        told, parse, value, fails = _steps(declared)
        cell = F.col(f"`{name}`").cast("string")
        if name in spec.censored:
            cell = numbers.uncensor(cell)
        if name in spec.dilution and spec.dilution_requires in df.columns:
            told, parse, value, fails = nulls.blank_tokens, numbers.dilution, lambda c: c, lambda t, p, s: t.isNotNull() & p.isNull()
        elif name in spec.one_decimal and fails is not None:
            told, parse = _after_top_code(told), _one_decimal(parse)
        elif name in spec.one_decimal:
            cell = F.coalesce(numbers.round_measure(cell, 1).cast("string"), cell)
        text, number, kept = F.col(f"_t{at}"), F.col(f"_p{at}"), F.col(f"`{name}`")
        texts.append(told(cell).alias(f"_t{at}"))
        parsed += [text, parse(text).alias(f"_p{at}")] if fails else [text]
        stored += [text, number, value(number).alias(name)] if fails else [text.alias(name)]
        if fails:
            failed.append(F.when(fails(text, number, kept), F.lit(name)))
            unfit.append(F.struct(F.lit(name).alias("key"), text.cast("string").alias("value")))
    rejects = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    extra = [rejects.alias(spec.reject_column)]
    if mixed is not None:
        bad = [F.when(test.isNotNull(), cell) for test, cell in zip(failed, unfit, strict=True)]
        cells = F.array_compact(F.array(*bad)) if bad else F.lit(None)
        held = F.when(F.size(cells) > 0, F.to_json(F.map_from_entries(cells))) if bad else F.lit(None).cast("string")
        extra.append(F.parse_json(held).alias(mixed))
    return df.select(*texts).select(*parsed).select(*stored).select(*[F.col(f"`{c}`") for c in df.columns], *extra)


def _after_top_code(told):
    return lambda cell: told(numbers.drop_top_code(cell))


def _one_decimal(parse):
    return lambda text: F.round(parse(text), 1)


def split_rejects(df: DataFrame, spec: CastSpec) -> tuple[DataFrame, DataFrame]:
    """Typed rows without the reject column, and the rows with at least one rejected cell."""
    return df.drop(spec.reject_column), df.filter(F.size(spec.reject_column) > 0)
