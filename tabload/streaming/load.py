"""Submission load on a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabload.functions import text
from tabload.plans.load import run_load
from tabload.plans.tables import LoadJob, RunResult
from tabload.sources.listing import list_files
from tabload.streaming.ingest import claimed, run_available, stream_files


def stream_load(job: LoadJob, root: str, checkpoint: str, prefix: str = "stream") -> list[RunResult]:
    """Load what has landed since the last call, in micro-batches.

    A batch is a published run of its own name, so a replayed batch changes nothing, and a
    submission that was loaded keeps its number. Before that a batch is claimed with a digest of its files: one that
    comes again with other files is refused.
    """
    results: list[RunResult] = []

    def handle(files: DataFrame, batch_id: int) -> None:
        # A batch may hold part of a submission only: the folders it touches are listed whole.
        touched = files.select(text.path_parent(F.col("path")).alias("folder")).distinct().collect()
        listed = list_files(job.spark, root, folders=[row.folder for row in touched])
        results.append(run_load(job, listed, f"{prefix}-{batch_id}", files))

    run_available(stream_files(job.spark, root), checkpoint, claimed(job.store, prefix, handle))
    return results
