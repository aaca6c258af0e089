"""Reference data that comes without a submission: assays, study design, panels, maps.

A workbook is landed as a folder of its name with one delimited file, or folder of part files, per sheet
(``map.xlsx/Parents.csv``). Sheets of maps and assays keep their texts as they are; panel,
confirmation and design files have their missing-value tokens normalised.

Lines that do not fit their header, files whose header cannot be read and rows without a partner are not loaded; where a list is
given as ``rejects``, they are added to it (columns source, reason, record).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from tabload import config
from tabload.functions import text
from tabload.operators import clean, joins, reshape, rules
from tabload.sources.delimited import PATH_COLUMN, read_delimited, rejected, split_lines
from tabload.sources.listing import comparable_path, latest_assay_files


def sheets(files: DataFrame, workbook: str, sheet: str) -> DataFrame:
    """Listing of one sheet of the workbooks whose path contains ``workbook``."""
    named = F.col("key").rlike(rf"\.xlsx/{re.escape(sheet)}\.csv(/[^/]+\.csv)?$")
    return files.filter(F.col("key").contains(workbook) & named)


Rejects = list[DataFrame] | None


def read_sheet(files: DataFrame, workbook: str, sheet: str, keep_texts: bool = False, rejects: Rejects = None) -> DataFrame | None:
    rows = read_delimited(sheets(files, workbook, sheet), source=sheet, rejects=rejects)
    if rows is None:
        return None
    rows = split_lines(rows, sheet, rejects)
    return rows.drop(PATH_COLUMN) if keep_texts else clean.normalise_nulls(rows.drop(PATH_COLUMN))


def workbook_files(files: DataFrame) -> DataFrame:
    """Sheet files with the workbook's own path as key, so that file rules see the workbook."""
    return files.withColumn("key", F.regexp_extract("key", r"^(.*\.xlsx)/[^/]+$", 1)).filter(F.col("key") != "")


def clean_assays(rows: DataFrame, pattern: str = config.ASSAY_ID_PATTERN) -> DataFrame:
    """Assay rows with a valid id; template lines and nameless columns dropped."""
    kept = clean.keep_matching_ids(rows, "Assay_ID", pattern)
    kept = clean.drop_constant_rows(clean.drop_blank_rows(kept))
    kept = clean.normalise_dashes(clean.drop_unnamed_columns(kept))
    return clean.rename_by_part(kept, {"Assay_Target_Antigen": "Assay_Target", "lavage": "Lavage"})


def assay_bundle(files: DataFrame, rejects: Rejects = None) -> dict[str, DataFrame]:
    """Newest assay, target, quality-control and conversion file of every folder, per kind."""
    newest = latest_assay_files(workbook_files(files), config.SKIPPED_ASSAY_MARK)
    kinds = {"assay": "assay_data.csv", "target": "assay_target.csv", "qc": "assay_qc.csv", "conversion": "assay_conversion.csv"}
    bundle = {}
    for name, kind in kinds.items():
        rows = read_delimited(newest.filter(F.col("file_class") == name), source=kind, rejects=rejects)
        if rows is None:
            continue
        rows = split_lines(rows, kind, rejects).drop(PATH_COLUMN)
        if name != "conversion":
            rows = clean_assays(rows)
        if name == "qc":
            rows = rules.fill_assay_quality(rows)
        if name == "assay" and "Calibration_Type" in rows.columns:
            rows = rules.fill_calibration(rows)
        bundle[kind] = rows.withColumnsRenamed({"Target_Organism": "Assay_Target_Organism"})
    return bundle


def validation_assays(files: DataFrame, rejects: Rejects = None) -> DataFrame | None:
    rows = read_delimited(files.filter(F.col("key").contains("validation_panel_assays.xlsx/")), source="validation_assays.csv", rejects=rejects)
    return None if rows is None else split_lines(rows, "validation_assays.csv", rejects).drop(PATH_COLUMN)


def study_design(files: DataFrame, rejects: Rejects = None) -> DataFrame | None:
    """Design files of all sites; the site name is the second part of the path."""
    chosen = files.filter(F.col("key").contains("Vaccine_Respone_Study_Design") & F.col("key").endswith(".csv"))
    rows = read_delimited(chosen, source="study_design.csv", rejects=rejects)
    if rows is None:
        return None
    rows = split_lines(rows, "study_design.csv", rejects)
    listing = chosen.select(F.col("path").alias("_file"), text.path_part(F.col("key"), 1).alias("CBC_Name"))
    same_file = comparable_path(F.col(PATH_COLUMN)) == comparable_path(F.col("_file"))
    named = rows.join(listing, same_file, "left")
    return clean.normalise_nulls(named.drop("_file", PATH_COLUMN))


def biorepository_maps(files: DataFrame, workbook: str, rejects: Rejects = None) -> dict[str, DataFrame]:
    """Parent and child sheet of a study's map."""
    found = {
        "bsi_parent.csv": read_sheet(files, workbook, "BSI_Parent_Aliquots", True, rejects),
        "bsi_child.csv": read_sheet(files, workbook, "BSI_Child_Aliquots", True, rejects),
    }
    return {kind: rows for kind, rows in found.items() if rows is not None}


def panel_results(files: DataFrame, child_aliquots: DataFrame, rejects: Rejects = None) -> DataFrame | None:
    """Panel result files, but for the example, joined to the repository ids.

    Ids with FD or FS are outside ids (CGR_Aliquot_ID); the others are repository sub-aliquots.
    """
    chosen = files.filter(~F.col("key").contains(config.PANEL_EXAMPLE_MARK) & F.col("key").endswith(".csv"))
    source = "panel_results.csv"
    rows = read_delimited(chosen, source=source, rejects=rejects)
    if rows is None:
        return None
    rows = clean.normalise_nulls(split_lines(rows, source, rejects).drop(PATH_COLUMN))
    children = child_aliquots.select("Biorepository_ID", "Subaliquot_ID", "CGR_Aliquot_ID")
    keyed = rows.withColumn("_id", F.col("Subaliquot_ID")).drop("Subaliquot_ID")
    outside = F.col("_id").rlike("FD|FS")
    known = [children.withColumn("_id", F.col(c)).filter(F.col("_id").isNotNull()) for c in ("CGR_Aliquot_ID", "Subaliquot_ID")]
    if rejects is not None:
        there = F.coalesce(outside, F.lit(False))
        for some, own in ((keyed.filter(there), known[0]), (keyed.filter(~there), known[1])):
            lost = joins.anti(some, own, ["_id"]).withColumnRenamed("_id", "Subaliquot_ID")
            rejects.append(rejected(lost, source, "no such aliquot in the repository"))
    return joins.split_route(keyed, outside, known[0], ["_id"], known[1], ["_id"]).drop("_id")


def confirmatory_results(
    files: DataFrame, antibodies: tuple[str, ...] = ("IgM", "IgG"), rejects: Rejects = None,
) -> DataFrame | None:
    """Latest result per patient and antibody over all workbooks, in the order of their names."""
    parts = {}
    for antibody in antibodies:
        chosen = files.filter(F.col("key").endswith(f".xlsx/{antibody}.csv"))
        rows = read_delimited(chosen, source="confirmatory_results.csv", rejects=rejects)
        if rows is not None:
            rows = clean.normalise_nulls(split_lines(rows, "confirmatory_results.csv", rejects), config.NULL_TOKENS)
            stamp = F.regexp_extract(PATH_COLUMN, r"(.{8})\.xlsx/[^/]+$", 1)
            parts[antibody] = rows.withColumn("file_date", stamp)
    if not parts:
        return None
    data_columns = sorted({c for rows in parts.values() for c in rows.columns} - {PATH_COLUMN, "Patient ID"})
    padded = {
        tag: rows.select("*", *[F.lit(None).cast("string").alias(c) for c in data_columns if c not in rows.columns])
        for tag, rows in parts.items()
    }
    tagged = reshape.tagged_union_latest(padded, "Measurand_Antibody", "Patient ID", " 9002", [PATH_COLUMN, *data_columns])
    return tagged.withColumn("BSI_Parent_ID", text.parent_id(F.col("Patient ID"))).drop(PATH_COLUMN)
