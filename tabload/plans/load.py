"""Submission load: landed files to published tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tabload.functions import text
from tabload.operators import clean, submissions
from tabload.operators.joins import fits_broadcast, join_on, lookup, semi
from tabload.plans.clean import clean_landed, few_pieces
from tabload.plans.tables import LoadJob, Run, RunResult, apply_kind_rules, load_tables, version_kind
from tabload.sources.delimited import MALFORMED_COLUMN, PATH_COLUMN, SHORT_COLUMN, read_headers, read_kinds, read_pairs
from tabload.sources.listing import comparable_path

DONE_COLUMNS = ("Submission_S3_Path", "Submission_Index")


def pending_submissions(run: Run, files: DataFrame) -> DataFrame:
    """New submissions with site, time, number, name and intent; staged, as all kinds use them."""
    job = run.job
    done = run.current("Submission").select(*DONE_COLUMNS).withColumnsRenamed({"Submission_S3_Path": "submission"})
    listed = submissions.describe_submissions(submissions.list_submissions(files, "key"), job.sites)
    numbered = submissions.number_submissions(submissions.pending(listed, done), done)
    folder = text.path_parent(F.col("key"))
    times = files.withColumn("submission", folder).groupBy("submission").agg(
        F.min_by("modified_at", "key").alias("validated_at")
    )
    headers = run.stage(
        read_headers(
            files.filter(F.col("key").endswith(".csv") & text.path_name(F.col("key")).contains("submission"))
            .withColumn("submission", folder)
            .select("path", "submission"),
            job.encoding,
        ),
        "headers",
    )
    run.reject(headers.filter(F.col("problem").isNotNull()).select("path", "problem"), "submission.csv", "header cannot be read")
    # One path per submission; the listing on the driver is larger.
    paths = [row.path for row in headers.select("path").collect()]
    if not paths:
        return run.stage(numbered.withColumns({
            "validated_at": F.lit(None).cast("timestamp"), "site_name": F.lit(None).cast("string"),
            "intent": F.lit(None).cast("string"),
        }), "submissions")
    intents = (
        read_pairs(job.spark, paths)
        .filter(F.col("key").rlike("(?i)intent"))
        .groupBy(comparable_path(F.col(PATH_COLUMN)).alias("_file"))
        .agg(F.min(text.strip(F.col("value"))).alias("intent"))
    )
    named = headers.select(
        "submission", comparable_path(F.col("path")).alias("_file"), F.get("header", F.lit(1)).alias("site_name")
    )
    about = named.join(intents, "_file", "left").groupBy("submission").agg(
        F.min("site_name").alias("site_name"), F.min("intent").alias("intent")
    )
    return run.stage(lookup(lookup(numbered, times, ["submission"]), about, ["submission"]), "submissions")


def submission_rows(run: Run, pending: DataFrame) -> DataFrame:
    """Rows of the Submission table, one per loaded submission."""
    rows = pending.select(
        "Submission_Index", F.col("submitted_at").cast("string").alias("Submission_Time"),
        F.col("site_name").alias("Submission_CBC_Name"), F.col("file_name").alias("Submission_File_Name"),
        F.col("submission").alias("Submission_S3_Path"),
        F.date_format("validated_at", "yyyy-MM-dd HH:mm:ss").alias("Date_Submission_Validated"),
        F.col("intent").alias("Submission_Intent"),
    )
    if "CBC" not in run.job.catalog.tables():
        return rows
    sites = run.current("CBC").select(
        F.col("CBC_Name").alias("Submission_CBC_Name"), F.col("CBC_ID").alias("Submission_CBC_ID")
    )
    return lookup(rows, sites, ["Submission_CBC_Name"])


def folder_of(path: Column) -> Column:
    return comparable_path(text.path_parent(path))


def landed_kinds(run: Run, files: DataFrame, pending: DataFrame) -> dict[str, DataFrame]:
    """Cleaned rows of every file kind, with submission number, site code and intent."""
    job = run.job
    name = text.path_name(F.col("key"))
    data_files = files.filter(F.col("key").endswith(".csv") & ~name.contains("study_design") & ~name.contains("submission"))
    listed = data_files.select("path", "key", text.path_parent(F.col("key")).alias("submission"), clean.kind_alias(name).alias("kind"))
    wanted = run.stage(semi(listed, pending, ["submission"]), "files")
    about = pending.select("submission", "Submission_Index", F.col("site_code").alias("Submission_CBC"), "intent")
    folders = wanted.select(folder_of(F.col("path")).alias("_folder"), "submission").distinct()
    tags = run.stage(join_on(folders, about, ["submission"]).drop("submission"), "folders")
    # One row per submission folder; a broadcast leaves the landed rows where they were read.
    tags = F.broadcast(tags) if fits_broadcast(tags) else tags
    pieces = few_pieces(job.excluded_ids)
    frames = {}
    for kind, rows in read_kinds(wanted, job.multi_line, job.encoding, run.rejected).items():
        # Parsed once; a line is either rejected or goes on, so both add up to the lines landed.
        placed = rows.withColumn("_folder", folder_of(F.col(PATH_COLUMN))).join(tags, "_folder", "left")
        tagged, found = run.stage_counted(placed, f"landed/{kind}", landed=F.count(F.lit(1)), short=F.count(SHORT_COLUMN))
        known, good = F.col("intent").isNotNull(), F.col(MALFORMED_COLUMN).isNull()
        run.reject(tagged.filter(~good), kind, "line has too many cells")
        run.reject(tagged.filter(good & ~known), kind, "line is of no listed submission")
        run.note(kind, "landed", found["landed"])
        if found["short"]:
            run.note(kind, "short line, missing cells read as NULL", found["short"])
        cleaned = clean_landed(
            tagged.filter(good & known).drop("_folder", PATH_COLUMN, MALFORMED_COLUMN, SHORT_COLUMN),
            job.clean_spec, job.excluded_ids, job.excluded_ages, pieces,
        )
        if "Age" in cleaned.columns:
            cleaned = cleaned.withColumn("Data_Release_Version", F.lit(job.data_release))
        frames[kind] = cleaned.drop("intent")
    return frames


def run_load(job: LoadJob, files: DataFrame, run_id: str, arrived: DataFrame | None = None) -> RunResult:
    """Load all new submissions among the listed files. A run that was published is not repeated.

    ``arrived`` (column ``key``): files that have landed just now; those of a submission that was
    loaded before are listed as rejects. An error in any step is logged, and the run is then not published.
    """
    return _once(job, run_id, lambda run: load_submissions(run, files, arrived))


def _once(job: LoadJob, run_id: str, work: Callable[[Run], None]) -> RunResult:
    """A run of this id, unless one was published; its error, if any, is logged and keeps it from being published."""
    if job.store.is_published(run_id):
        empty = job.spark.createDataFrame([], "source string, reason string, record string")
        return RunResult(run_id, True, job.spark.read.parquet(f"{job.store.root}/run_log").filter(F.col("run_id") == run_id), empty)
    run = Run(job, run_id)
    try:
        work(run)
    except Exception as error:  # noqa: BLE001 - recorded; the run is then not published
        run.note("run", "error", 0, f"{type(error).__name__}: {error}")
    return run.finish()


def load_submissions(run: Run, files: DataFrame, arrived: DataFrame | None) -> None:
    if arrived is not None:
        done = run.current("Submission").select(F.col("Submission_S3_Path").alias("submission")).distinct()
        late = semi(arrived.withColumn("submission", text.path_parent(F.col("key"))), done, ["submission"])
        run.reject(run.stage(late, "late"), "submission", "file landed after its submission was loaded")
    pending, other = submissions.split_by_intent(pending_submissions(run, files))
    run.reject(other, "submission.csv", "intent is neither Create nor Update")
    if pending.isEmpty():
        run.note("Submission", "absent", 0)
        return
    frames = {kind: run.stage(version_kind(run, kind, rows), f"kinds/{kind}") for kind, rows in landed_kinds(run, files, pending).items()}
    frames = apply_kind_rules(run, frames)
    frames["submission.csv"] = submission_rows(run, pending)
    load_tables(run, frames)


def run_refresh(job: LoadJob, bundle: dict[str, DataFrame], run_id: str, rejects: DataFrame | None = None) -> RunResult:
    """Load reference data (assays, design, maps, panels) that has no submission. A run that was published is not repeated.

    ``rejects`` (columns source, reason, record): what reading the bundle has turned away; it is listed with the run's own.
    An empty bundle is a run of its own in the log.
    """
    return _once(job, run_id, lambda run: load_bundle(run, bundle, rejects))


def load_bundle(run: Run, bundle: dict[str, DataFrame], rejects: DataFrame | None) -> None:
    if rejects is not None:
        turned_away = run.stage(rejects.select("source", "reason", "record"), "turned away")
        run.rejected.append(turned_away)
        for row in turned_away.groupBy("source").count().collect():  # at most one for each kind of file
            run.note(row.source, "rejected", row["count"])
    if not bundle:
        run.note("run", "absent", 0)
    frames = {}
    for kind, rows in bundle.items():
        renamed = rows.withColumnsRenamed({"Target_Organism": "Assay_Target_Organism"})
        frames[kind], found = run.stage_counted(renamed, f"kinds/{kind}", landed=F.count(F.lit(1)))
        run.note(kind, "landed", found["landed"])
    load_tables(run, frames)
