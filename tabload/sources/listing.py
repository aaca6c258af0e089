"""File listings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabload.functions import text
from tabload.operators.dedup import latest_per_group


def list_files(spark: SparkSession, root: str, pattern: str = "*", folders: list[str] | None = None) -> DataFrame:
    """All files under a folder: full path, path below the folder, size and time of change.

    Only the listing is read; the content column is pruned. ``folders`` narrows the listing to
    some folders below ``root``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load([literal_path(folder) for folder in folders] if folders else literal_path(root))
        .select("path", F.col("modificationTime").alias("modified_at"), F.col("length").alias("size"))
    )
    return files.withColumn("key", relative_key(F.col("path"), root))


def literal_path(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def relative_key(path: Column, root: str) -> Column:
    """Path below the listing root."""
    folder = root.rstrip("/").removeprefix("file:")
    while folder.startswith("//"):
        folder = folder[1:]
    return F.substring_index(path, f"{folder}/", -1)


def metadata_path() -> Column:
    """Path of the file a row came from, spelled as in the listing."""
    # The hidden column is URI-encoded, where a plus sign stands for itself.
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def comparable_path(path: Column) -> Column:
    """Path without its scheme's varying number of slashes."""
    return F.regexp_replace(path, "^([a-zA-Z][a-zA-Z0-9+.-]*:)/+", "$1/")


def file_class(name: Column) -> Column:
    """Assay file class by file name; NULL for other files."""
    return (
        F.when(name.contains("Assay_Target_Organism_Conversion.xlsx"), "conversion")
        .when(name.contains("assay_qc"), "qc")
        .when(name.contains("assay_target"), "target")
        .when(name.contains("assay"), "assay")
    )


def latest_assay_files(files: DataFrame, skipped: str) -> DataFrame:
    """The newest file of each class in each folder; of the sheets of one workbook the last by name."""
    named = files.filter(~F.col("key").contains(skipped)).withColumns({
        "folder": text.path_parent(F.col("key")), "file_class": file_class(text.path_name(F.col("key"))),
    })
    classed = named.filter(F.col("file_class").isNotNull())
    return latest_per_group(classed, ["folder", "file_class"], [c for c in ("modified_at", "key", "path") if c in files.columns])
