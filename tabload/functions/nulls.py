"""Missing-value markers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabload.config import (
    DATE_SENTINELS, NULL_TOKENS, NUMBER_NULL_TEXTS, NUMBER_SENTINELS, TEXT_SENTINELS,
)


def blank_tokens(cell: Column, tokens: tuple[str, ...] = NULL_TOKENS) -> Column:
    """NULL for a cell that holds only a missing-value token, else the cell as it is."""
    return F.when(~F.trim(cell).isin(*tokens), cell)


def text_sentinel_to_null(cell: Column) -> Column:
    return blank_tokens(cell, NULL_TOKENS + TEXT_SENTINELS)


def number_sentinel_to_null(number: Column) -> Column:
    for value in NUMBER_SENTINELS:
        number = F.nullif(number, F.lit(value))
    return number


def number_text_to_null(cell: Column) -> Column:
    """Texts that mean "no number" in a numeric column."""
    return blank_tokens(cell, NULL_TOKENS + TEXT_SENTINELS + NUMBER_NULL_TEXTS)


def date_text_to_null(cell: Column) -> Column:
    return blank_tokens(cell, NULL_TOKENS + TEXT_SENTINELS + DATE_SENTINELS)


def fill(cell: Column, label: str) -> Column:
    return F.coalesce(cell, F.lit(label))
