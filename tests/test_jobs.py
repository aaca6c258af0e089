"""From a mixed listing of changed paths to the loads it asks for."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from landing import land, write_csv
from tabload import config
from tabload.plans.jobs import CodeList, bundle_of, refresh_codes, requested_jobs, run_changed
from tabload.sinks.publish import SnapshotStore, StaleRun
from tabload.sources.listing import list_files
from test_load import SMALL, log_of, make_job, quick_planning, read  # noqa: F401


def test_mixed_listing(spark, tmp_path):
    root = tmp_path / "landing"
    land(root, "Site_99", "13-05-09-02-28-2021", "submission_001_a.zip", "Create", {
        "baseline.csv": [["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity"], ["99_000001", "45", "HIV", "24", ""]],
    })
    write_csv(
        root / "Study/Site_99/Vaccine_Respone_Study_Design/design.csv", ["Cohort_Name", "Index_Date"], ["A", "Dose 1"]
    )
    job = make_job(spark, tmp_path, SMALL)
    listed = list_files(spark, str(root))
    changed = listed.unionByName(listed.limit(1).selectExpr(*[f"'other/path.txt' as {c}" if c == "key" else c for c in listed.columns]))
    assert "submissions" in requested_jobs(changed)
    results = run_changed(job, changed, listed, "run")
    assert results["submissions"].published
    assert rows(read(job, "Participant"), "Research_Participant_ID") == [("99_000001",)]
    assert ("study_design.csv", "unmapped") in log_of(results["study_design"])
    assert ("study_design.csv", "landed") in log_of(results["study_design"])
    assert requested_jobs(listed.filter("key = 'nothing'")) == []


def test_code_list_refresh(spark, tmp_path):
    dictionary = spark.createDataFrame([("Flu", "J11"), ("HIV", "B20")], "Term string, Code string")
    codes = CodeList("Conditions", "Visit", "Term", "Known", dictionary, str(tmp_path / "codes"))
    first = spark.createDataFrame([("v1", "Flu| HIV"), ("v2", "Flu|Cold"), ("v3", None)], "Visit string, Conditions string")
    assert rows(refresh_codes(first, codes), "Visit", "Term", "Known") == [
        ("v1", "Flu", True), ("v1", "HIV", True), ("v2", "Cold", False), ("v2", "Flu", True), ("v3", "Not Reported", False),
    ]
    second = spark.createDataFrame([("v1", "Flu"), ("v4", "HIV")], "Visit string, Conditions string")
    assert rows(refresh_codes(second, codes), "Visit", "Term", "Known") == [("v4", "HIV", True)]
    assert refresh_codes(second, codes).count() == 0


def bundle_files(root):
    panel = root / "Serology_Data_Files/Reference_Panel_Files/Reference_Panel_Submissions"
    write_csv(panel / "one.csv", ["Subaliquot_ID", "Result"], ["FD1", "1"], ["S2", "2"], ["S9", "3"], ["S2", "2", "extra"], [None, "4"])
    (panel / "two.csv").write_bytes(b"Subaliquot_\xff\xfeID,Result\nS2,7\n")
    write_csv(panel / "blinded_validation_panel_results_example.csv", ["Subaliquot_ID", "Result"], ["S2", "5"])
    write_csv(root / "Study/Site_99/Vaccine_Respone_Study_Design/design.csv", ["Cohort_Name", "Index_Date"], ["A", "Dose 1"], ["B", "x", "Dose 2"])
    cdc = root / "Serology_Data_Files/CDC_Confirmation_Results"
    write_csv(cdc / "results_20210401.xlsx" / "IgG.csv", ["Patient ID", "Value"], ["99_0001 9002", "1"], ["99_0001 9002", "1", "2"])
    maps = root / "Serology_Data_Files/biorepository_id_map/biorepository_id_map.xlsx"
    write_csv(maps / "BSI_Parent_Aliquots.csv", ["Biorepository_ID", "N"], ["B1", "1"], ["B2", "2", "3"])
    return 5 + 1 + 2 + 2 + 2  # lines landed, the unreadable file counting as one


def test_nothing_of_a_bundle_is_lost_silently(spark, tmp_path):
    lines = bundle_files(tmp_path)
    listed = list_files(spark, str(tmp_path), "*.csv")
    children = spark.createDataFrame([("B1", "S1", "FD1"), ("B2", "S2", None)], "Biorepository_ID string, Subaliquot_ID string, CGR_Aliquot_ID string")
    accepted, turned_away = 0, []
    for name in ("panel_results", "study_design", "reference_panel", "biorepository_map"):
        rejects = []
        found = bundle_of(name, listed, config.JOB_FOLDERS[name], "biorepository_id_map.xlsx", children, rejects)
        accepted += sum(frame.count() for frame in found.values())
        turned_away += [(r.source, r.reason) for frame in rejects for r in frame.collect()]
        if name == "panel_results":
            (panel,) = found.values()
            assert "Cohort_Name" not in panel.columns and rows(panel, "Biorepository_ID", "Result") == [("B1", "1"), ("B2", "2")]
    assert accepted + len(turned_away) == lines
    assert sorted(turned_away) == sorted([
        ("panel_results.csv", "header cannot be read as UTF-8: UnicodeDecodeError"), ("panel_results.csv", "line has too many cells"),
        ("panel_results.csv", "no such aliquot in the repository"), ("panel_results.csv", "no such aliquot in the repository"),
        ("study_design.csv", "line has too many cells"), ("confirmatory_results.csv", "line has too many cells"),
        ("BSI_Parent_Aliquots", "line has too many cells"),
    ])
    rejects = []
    assert bundle_of("panel_results", listed, config.JOB_FOLDERS["panel_results"], "m", None, rejects) == {}
    assert rejects[0].count() == 3


def test_every_job_leaves_a_trace(spark, tmp_path):
    bundle_files(tmp_path / "landing")
    job = make_job(spark, tmp_path, {})
    listed = list_files(spark, str(tmp_path / "landing"), "*.csv")
    changed = listed.filter(F.col("key").contains("Reference_Panel_Submissions") | F.col("key").contains("Study_Design")).unionByName(
        listed.limit(1).withColumn("key", F.lit("CBC_Folders/Assay_Data/gone.csv")))
    results = run_changed(job, changed, listed, "run")
    assert sorted(results) == ["assay_data", "panel_results", "study_design"]
    assert ("run", "absent") in log_of(results["assay_data"])
    assert log_of(results["panel_results"])[("panel_results.csv", "rejected")] == 3
    assert log_of(results["study_design"])[("study_design.csv", "rejected")] == 1


def test_code_lists_are_published_whole(spark, tmp_path):
    dictionary = spark.createDataFrame([("Flu", "J11")], "Term string, Code string")
    codes = CodeList("Conditions", "Visit", "Term", "Known", dictionary, str(tmp_path / "codes"))
    seen = spark.createDataFrame([("v1", "Flu")], "Visit string, Conditions string")
    first = refresh_codes(seen, codes, "one")
    assert first.count() == 1 and rows(first) == rows(first)  # what was added can be read again
    store = SnapshotStore(spark, codes.path)
    store.claim("codes", 2, "another")
    with pytest.raises(StaleRun):
        refresh_codes(spark.createDataFrame([("v2", "Flu")], "Visit string, Conditions string"), codes, "two")
    assert store.read("codes", first.schema).count() == 1
