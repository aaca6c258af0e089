"""Submission folders: listing, routing, numbering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabload.config import ROUTES
from tabload.functions import dates, text
from tabload.operators.joins import anti
from tabload.operators.links import number_rows


def route_by_path(path: Column, routes: tuple[tuple[str, str], ...] = ROUTES) -> Column:
    """All jobs a path asks for; an empty array if none."""
    return F.array_compact(F.array(*[F.when(path.contains(part), F.lit(job)) for part, job in routes]))


def list_submissions(
    files: DataFrame, path: str = "path", marker: str = "UnZipped_Files",
    dropped: tuple[str, ...] = ("Submissions_in_Review",), dropped_prefix: str = "test/",
) -> DataFrame:
    """Distinct submission folders of a file listing."""
    folder = text.path_parent(F.col(path))
    kept = files.filter(F.col(path).contains(marker)).select(folder.alias("submission"))
    kept = kept.filter(~F.col("submission").startswith(dropped_prefix))
    for part in dropped:
        kept = kept.filter(~F.col("submission").contains(part))
    return kept.distinct()


def describe_submissions(submissions: DataFrame, sites: DataFrame) -> DataFrame:
    """Site folder, site code, folder time and file name of each submission path.

    A path is ``study/site/time/file/...``; ``sites`` has one row per site folder.
    """
    path = F.col("submission")
    parts = submissions.withColumns({
        "site_folder": text.path_part(path, 1),
        "submitted_at": dates.submission_time(text.path_part(path, 2)),
        "file_name": text.remove(text.path_part(path, 3), "submission_[0-9]{3}_"),
    })
    return parts.join(sites.select("site_folder", "site_code"), "site_folder", "left")


def pending(submissions: DataFrame, done: DataFrame, path: str = "submission") -> DataFrame:
    """Submissions whose path was not loaded before."""
    return anti(submissions, done, [path])


def number_submissions(submissions: DataFrame, done: DataFrame) -> DataFrame:
    """Index from the last loaded one on, in the order of time and path; the first run starts at 1."""
    first = done.agg((F.coalesce(F.max("Submission_Index"), F.lit(0)) + 1).alias("next")).scalar()
    return number_rows(submissions, ["submitted_at", "submission"], "Submission_Index", first)


def split_by_intent(df: DataFrame, intent: str = "intent") -> tuple[DataFrame, DataFrame]:
    """Rows to load, and rows whose intent is neither Create nor Update."""
    valid = F.coalesce(F.col(intent).isin("Create", "Update"), F.lit(False))
    return df.filter(valid), df.filter(~valid)


def select_paths(df: DataFrame, folder: str, path: str = "path") -> DataFrame:
    """Rows whose decoded path lies under the decoded folder."""
    return df.filter(text.decode_path(F.col(path)).contains(text.decode_path(F.lit(folder))))
