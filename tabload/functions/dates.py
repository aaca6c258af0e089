"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tabload.config import DATE_FORMATS, LAST_SHORT_YEAR, SUBMISSION_TIME_FORMATS, TIMESTAMP_FORMATS
from tabload.functions.nulls import date_text_to_null


Formats = tuple[tuple[str, str], ...]


def _by_shape(text: Column, formats: Formats) -> Column:
    """Parse in the layout whose shape the text has; one attempt per cell, NULL if none fits."""
    chain = F.when(text.isNull(), F.lit(None).cast("timestamp"))
    for layout, shape in formats:
        parsed = F.try_to_timestamp(text, F.lit(layout))
        if layout.endswith("/yy"):
            short = F.regexp_extract(text, r"(\d{2})$", 1).try_cast("int")
            century = F.when(short <= LAST_SHORT_YEAR % 100, "20").otherwise("19")
            whole = F.concat(F.regexp_replace(text, r"\d{2}$", ""), century, F.regexp_extract(text, r"(\d{2})$", 1))
            parsed = F.try_to_timestamp(whole, F.lit(layout + "yy"))
        chain = chain.when(text.rlike(shape), parsed)
    return chain


def parse_date(cell: Column, formats: Formats = DATE_FORMATS + TIMESTAMP_FORMATS) -> Column:
    """The day of a date, also of one that is given with a time."""
    return _by_shape(date_text_to_null(cell), formats).cast("date")


def parse_timestamp(cell: Column, formats: Formats = TIMESTAMP_FORMATS + DATE_FORMATS) -> Column:
    return _by_shape(date_text_to_null(cell), formats)


def submission_time(part: Column) -> Column:
    """Time stamp of a submission folder; the third character tells the two layouts apart."""
    clock_first, date_first = SUBMISSION_TIME_FORMATS
    return F.when(
        F.substring(part, 3, 1) == "-", F.try_to_timestamp(part, F.lit(clock_first))
    ).otherwise(F.try_to_timestamp(part, F.lit(date_first)))


def seconds_to_time(seconds: Column) -> Column:
    """Seconds of an interval as ``HH:mm:ss`` within a day."""
    return F.date_format(F.timestamp_seconds(F.pmod(seconds, F.lit(86400))), "HH:mm:ss")


def parse_time(cell: Column) -> Column:
    """``HH:mm:ss`` text of a time of day, NULL if the text is none."""
    parsed = F.coalesce(
        F.try_to_timestamp(cell, F.lit("H:mm:ss")), F.try_to_timestamp(cell, F.lit("H:mm"))
    )
    return F.date_format(parsed, "HH:mm:ss")
