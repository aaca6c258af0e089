"""The cleaning chain every landed file kind goes through."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, functions as F

from tabload.config import CleanSpec
from tabload.operators import clean
from tabload.sources.delimited import MALFORMED_COLUMN, PATH_COLUMN, SHORT_COLUMN

BOOKKEEPING = (PATH_COLUMN, MALFORMED_COLUMN, SHORT_COLUMN, "Submission_Index", "Submission_CBC", "intent", "submission")


# Up to so many listed ids are tested as expressions; a longer list is joined.
FEW_PIECES = 100


def few_pieces(excluded_ids: DataFrame | None) -> tuple[str, ...] | None:
    """The listed ids if they are few, None if they are many (runs a job)."""
    if excluded_ids is None:
        return ()
    found = excluded_ids.select("id").filter(F.length("id") > 0).distinct().limit(FEW_PIECES + 1).collect()
    return tuple(row.id for row in found) if len(found) <= FEW_PIECES else None


def clean_landed(
    landed: DataFrame, spec: CleanSpec, excluded_ids: DataFrame | None = None, excluded_ages: DataFrame | None = None,
    pieces: tuple[str, ...] | None = None,
) -> DataFrame:
    """Null markers, blank and template rows, excluded records, recodes.

    Rows without one of the excludable ids drop, whether or not anything is listed.
    ``excluded_ids`` (column ``id``) drops rows whose ids contain a listed id; a list known to be
    short is given as ``pieces`` instead. ``excluded_ages`` (Research_Participant_ID, Age) drops
    known wrong pairs.
    """
    rows = landed.transform(partial(clean.normalise_nulls, tokens=spec.null_tokens))
    rows = rows.transform(clean.drop_unnamed_columns)
    data_columns = [c for c in rows.columns if c not in BOOKKEEPING]
    ignored = tuple(c for c in rows.columns if c in BOOKKEEPING)
    rows = rows.transform(partial(clean.drop_blank_rows, ignore=ignored))
    indexed = [c for c in [*data_columns, "Submission_Index"] if c in rows.columns]
    rows = rows.transform(partial(clean.drop_constant_rows, columns=tuple(indexed)))
    rows = rows.transform(clean.normalise_dashes)
    rows = clean.exclude_marked(rows, marks=spec.excluded_comments)
    if "Age" in rows.columns and excluded_ages is not None:
        pairs = excluded_ages.select("Research_Participant_ID", F.col("Age").cast("string").alias("Age"))
        rows = clean.exclude_keys(rows, pairs, ["Research_Participant_ID", "Age"])
    rows = clean.require(rows, *[c for c in spec.required_ids if c in rows.columns])
    ids = [c for c in spec.excludable_ids if c in rows.columns]
    for c in ids:
        rows = rows.filter(F.col(c).isNotNull())
    if ids and pieces is not None:
        rows = clean.exclude_pieces(rows, ids, pieces) if pieces else rows
    elif ids and excluded_ids is not None:
        rows = clean.exclude_containing(rows, ids, excluded_ids, "id")
    return clean.recode_columns(rows, spec.recodes)
