"""From changed paths to the loads they ask for."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from tabload import config
from tabload.functions import text
from tabload.operators import reshape, rules, submissions
from tabload.plans.load import run_load, run_refresh
from tabload.plans.tables import LoadJob, RunResult
from tabload.sinks.publish import BUCKET_COLUMN, SnapshotStore
from tabload.sources import bundles
from tabload.sources.delimited import rejected

SUBMISSION_MARK = "UnZipped_Files"
CODE_TABLE = "codes"


@dataclass(frozen=True)
class CodeList:
    """Terms of a delimited column that get an entry of a dictionary, kept in a store of their own.

    ``dictionary`` has one row per ``term``; ``path`` is where (key, term, found) rows are kept.
    """

    column: str
    key: str
    term: str
    found: str
    dictionary: DataFrame
    path: str


def requested_jobs(changed: DataFrame, path: str = "key") -> list[str]:
    """The jobs that changed paths ask for, in the order of their names; as many as there are routes at most."""
    asked = changed.select(F.explode(submissions.route_by_path(F.col(path))).alias("job")).distinct()
    names = {row.job for row in asked.collect()}
    landed = changed.filter(text.decode_path(F.col(path)).contains(SUBMISSION_MARK))
    return sorted(names | ({"submissions"} if not landed.isEmpty() else set()))


def bundle_of(
    name: str, files: DataFrame, folder: str | None, map_workbook: str, children: DataFrame | None, rejects: list[DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """The reference tables of a job, by file kind, from the files below its folder; empty if it has none among them.

    What cannot be loaded is added to ``rejects``. Panel results without the known sub-aliquots (``children``) are all rejected.
    """
    if folder is not None:
        files = submissions.select_paths(files, folder, "key")
    if name == "assay_data":
        return bundles.assay_bundle(files, rejects)
    if name == "biorepository_map":
        return bundles.biorepository_maps(files, map_workbook, rejects)
    if name == "panel_results" and children is None:
        if rejects is not None:
            lost = files.filter(F.col("key").endswith(".csv")).select("path")
            rejects.append(rejected(lost, "panel_results.csv", "the sub-aliquots that results refer to are not given"))
        return {}
    rows = {
        "study_design": lambda: bundles.study_design(files, rejects),
        "panel_results": lambda: bundles.panel_results(files, children, rejects),
        "reference_panel": lambda: bundles.confirmatory_results(files, rejects=rejects),
    }.get(name, lambda: None)()
    kind = "confirmatory_results.csv" if name == "reference_panel" else f"{name}.csv"
    return {} if rows is None else {kind: rows}


def run_changed(
    job: LoadJob, changed: DataFrame, files: DataFrame, run_id: str, map_workbook: str = "biorepository_id_map.xlsx",
    children: DataFrame | None = None, folders: dict[str, str] | None = None,
) -> dict[str, RunResult]:
    """Run every load that the changed paths ask for over the listed files; each is a run of its own, with a log also if it found nothing.

    A job reads the files below its own folder (``folders``, by default those of the configuration). Reference data comes before
    submissions. ``children`` are the known sub-aliquots panel results refer to.
    """
    results: dict[str, RunResult] = {}
    places = config.JOB_FOLDERS if folders is None else folders
    asked = requested_jobs(changed)
    for name in asked:
        if name == "submissions":
            continue
        rejects: list[DataFrame] = []
        found = bundle_of(name, files, places.get(name), map_workbook, children, rejects)
        results[name] = run_refresh(job, found, f"{run_id}-{name}", reshape.union_all(rejects) if rejects else None)
    if "submissions" in asked:
        results["submissions"] = run_load(job, files, f"{run_id}-submissions", changed)
    return results


def refresh_codes(rows: DataFrame, codes: CodeList, run_id: str | None = None) -> DataFrame:
    """Read the terms of a table, compare with the stored ones, publish what is missing; the added rows.

    The list is a table of a store of its own: readers see all rows of a run or none, and of two callers that read the same version
    one is refused. The added rows are a new version's folder; earlier folders stay as they are.
    """
    spark = rows.sparkSession
    store = SnapshotStore(spark, codes.path)
    schema = rows.select(F.col(codes.key), F.lit("").alias(codes.term), F.lit(True).alias(codes.found)).schema
    run_id = run_id or f"codes-{uuid.uuid4().hex}"
    heads = store.heads()
    # every run writes a bucket of its own, numbered by its version
    head = heads.get(CODE_TABLE)
    stored = store.open(list(head.paths.values()) if head else None, schema)
    normalised = rules.normalise_codes(rows, codes.dictionary, codes.key, codes.column, codes.term, codes.found)
    fresh = rules.missing_codes(normalised.select(codes.key, codes.term, codes.found), stored, codes.key, codes.term, codes.found)
    at = (head.version if head else 0) + 1
    folder = f"{run_id}/{uuid.uuid4().hex[:12]}"
    added = store.stage(fresh, folder, f"tables/{CODE_TABLE}/{BUCKET_COLUMN}={at}")
    count = added.count()
    if count:
        store.publish(run_id, {CODE_TABLE: {at: count}}, heads, folder)
    return added
