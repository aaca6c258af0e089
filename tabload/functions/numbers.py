"""Number expressions. Rounding is half up on the decimal form of a number."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DecimalType

from tabload.functions.nulls import number_sentinel_to_null, number_text_to_null
from tabload.functions.text import strip


EXACT = DecimalType(30, 10)
WIDE = DecimalType(38, 10)  # whole numbers up to 28 digits


def to_number(cell: Column) -> Column:
    """Text or number as a finite double, NULL where it is neither."""
    return F.nullif(F.nullif(F.nullif(cell.try_cast("double"), F.lit(float("nan"))), F.lit(float("inf"))), F.lit(float("-inf")))


def round_half_up(cell: Column, digits: int) -> Column:
    """Rounded as a decimal of ten places, so that computed values do not miss a tie by an ulp."""
    return F.round(cell.try_cast(EXACT), digits).cast("double")


def drop_top_code(cell: Column) -> Column:
    """``90+`` to ``90``."""
    return F.regexp_replace(strip(cell.cast("string")), r"\+$", "")


def is_top_coded(cell: Column) -> Column:
    return F.coalesce(strip(cell.cast("string")).rlike(r"^[0-9.]+\+$"), F.lit(False))


def round_measure(cell: Column, digits: int = 1) -> Column:
    return round_half_up(drop_top_code(cell), digits)


def scientific(cell: Column) -> Column:
    """Three significant digits as ``4.00E+2``: ties go to the even digit, no zero leads the exponent."""

    def rounded(digits: Column) -> Column:
        mantissa = F.bround(F.regexp_extract(digits, "^(-?[0-9.]+)E", 1).try_cast(DecimalType(17, 14)), 2)
        return F.struct(mantissa.alias("m"), F.regexp_extract(digits, "E([+-][0-9]+)$", 1).try_cast("int").alias("e"))

    def shown(parts: Column) -> Column:
        carried = F.abs(parts["m"]) >= 10
        mantissa = F.when(carried, parts["m"] / 10).otherwise(parts["m"]).cast(DecimalType(4, 2)).cast("string")
        power = parts["e"] + carried.cast("int")
        return F.concat(mantissa, F.when(power < 0, "E-").otherwise("E+"), F.abs(power).cast("string"))

    digits = F.array(F.format_string("%.14E", to_number(cell)))
    return F.get(F.transform(F.transform(digits, rounded), shown), F.lit(0))


def dilution(cell: Column) -> Column:
    """Undiluted (``none``) is 1; NULL and texts without a number are NULL."""
    return scientific(F.when(cell == "none", F.lit("1")).otherwise(cell))


def uncensor(cell: Column) -> Column:
    """Take ``<`` and ``>`` off a result; a reactivity word carries no number."""
    bare = F.regexp_replace(cell, "[<>]", "")
    return F.when(~strip(bare).isin("Nonreactive", "Reactive"), bare)


def censor_flag(cell: Column) -> Column:
    return (
        F.when(cell.contains("<"), "below")
        .when(cell.contains(">"), "above")
        .when(strip(cell).isin("Nonreactive", "Reactive"), "qualitative")
    )


def compare_number(number: Column) -> Column:
    """Number as it is compared: sentinels to NULL, four decimals."""
    return F.round(number_sentinel_to_null(number), 4)


def compare_form(cell: Column) -> Column:
    """Text as the number that is compared; texts without a number are NULL."""
    return compare_number(to_number(number_text_to_null(cell)))


def told_number(cell: Column) -> Column:
    """Text of a number column: the first visit's label is 1, texts for "none" are NULL."""
    return number_text_to_null(F.when(cell == "Baseline(1)", "1").otherwise(cell))


def as_double(number: Column) -> Column:
    return F.round(number_sentinel_to_null(number), 5)


def to_exact(cell: Column) -> Column:
    """Text or number as a decimal without passing through a double, NULL where it is none."""
    return cell.try_cast(WIDE)


def as_decimal(kind: DecimalType):
    """How a number is stored in a decimal column: sentinels to NULL, rounded half up to its scale."""
    return lambda number: number_sentinel_to_null(number).try_cast(kind)


def as_whole(number: Column) -> Column:
    kept = number_sentinel_to_null(number)
    return F.when(kept == F.floor(kept), kept.try_cast("bigint"))


def lenient_number(cell: Column) -> Column:
    """Whole numbers as they are, others to five decimals, NULL for anything else."""
    return as_double(to_number(told_number(cell)))


def whole_number(cell: Column) -> Column:
    """Whole numbers as bigint, NULL for anything else (also for a fraction)."""
    return as_whole(to_exact(told_number(cell)))


def band(number: Column, bands: tuple[tuple[float | None, str], ...], current: Column) -> Column:
    """Name of the band a positive number falls in; ``current`` for zero and NULL."""
    chain = F.when(number.isNull() | (number <= 0), current)
    for upper, name in bands:
        chain = chain.otherwise(F.lit(name)) if upper is None else chain.when(number < upper, name)
    return chain


def row_mean(*cells: Column) -> Column:
    """Mean over the columns of a row, ignoring NULLs; NULL if there are none."""
    numbers = [to_number(cell) for cell in cells]
    total = reduce(lambda left, right: left + right, [F.coalesce(number, F.lit(0.0)) for number in numbers])
    count = reduce(lambda left, right: left + right, [number.isNotNull().cast("int") for number in numbers])
    return F.try_divide(total, count)
