"""A small landing area with two studies' file kinds; all values are invented."""

from __future__ import annotations

import csv
from pathlib import Path

STUDY = "Vaccine Response Submissions"

CATALOG = """
Submission Submission_Index INTEGER pk
Submission Submission_Time DATETIME
Submission Submission_CBC_ID INTEGER
Submission Submission_CBC_Name VARCHAR(255)
Submission Submission_File_Name VARCHAR(255)
Submission Submission_S3_Path VARCHAR(255)
Submission Date_Submission_Validated DATETIME
Submission Submission_Intent VARCHAR(255)
CBC CBC_ID INTEGER pk
CBC CBC_Name VARCHAR(255)
Participant Research_Participant_ID VARCHAR(255) pk
Participant Age FLOAT
Participant Submission_CBC VARCHAR(255)
Participant_Visit_Info Visit_Info_ID VARCHAR(255) pk
Participant_Visit_Info Research_Participant_ID VARCHAR(255) fk=Participant.Research_Participant_ID
Participant_Visit_Info Visit_Number VARCHAR(255)
Participant_Visit_Info Type_Of_Visit VARCHAR(255)
Participant_Visit_Info CBC_Classification VARCHAR(255)
Participant_Visit_Info BMI FLOAT
Participant_Visit_Info Obesity VARCHAR(255)
Participant_Visit_Info Submission_Index INTEGER
Covid_History Visit_Info_ID VARCHAR(255) pk fk=Participant_Visit_Info.Visit_Info_ID
Covid_History COVID_Status VARCHAR(255) pk
Covid_History Breakthrough_COVID VARCHAR(255)
Covid_History SARS-CoV-2_Variant VARCHAR(255)
Covid_History Symptomatic_COVID VARCHAR(255)
Covid_History Disease_Severity VARCHAR(255)
Covid_History Symptoms VARCHAR(255)
Covid_History Average_Duration_Of_Test FLOAT
Covid_History Covid_History_Comments VARCHAR(255)
Tube Tube_ID INTEGER pk auto
Tube Tube_Used_For VARCHAR(255)
Tube Tube_Type VARCHAR(255)
Tube Tube_Type_Lot_Number VARCHAR(255)
Tube Tube_Type_Catalog_Number VARCHAR(255)
Tube Tube_Type_Expiration_Date DATE
Biospecimen Biospecimen_ID VARCHAR(255) pk
Biospecimen Visit_Info_ID VARCHAR(255) fk=Participant_Visit_Info.Visit_Info_ID
Biospecimen Biospecimen_Type VARCHAR(255)
Biospecimen Biospecimen_Tube_ID INTEGER fk=Tube.Tube_ID
Biospecimen Submission_CBC VARCHAR(255)
Aliquot Aliquot_ID VARCHAR(255) pk
Aliquot Biospecimen_ID VARCHAR(255) fk=Biospecimen.Biospecimen_ID
Aliquot Aliquot_Volume FLOAT
Aliquot Aliquot_Tube_ID INTEGER fk=Tube.Tube_ID
Equipment Equipment_Index INTEGER pk auto
Equipment Equipment_ID VARCHAR(255)
Equipment Equipment_Type VARCHAR(255)
Biospecimen_Equipment Biospecimen_ID VARCHAR(255) pk
Biospecimen_Equipment Equipment_Index INTEGER pk
Covid_Vaccination_Status Visit_Info_ID VARCHAR(255) pk fk=Participant_Visit_Info.Visit_Info_ID
Covid_Vaccination_Status Research_Participant_ID VARCHAR(255) pk
Covid_Vaccination_Status Vaccination_Status VARCHAR(255) pk
Covid_Vaccination_Status Covid_Vaccination_Status_Comments VARCHAR(255)
Assay_Metadata Assay_ID VARCHAR(255) pk
Assay_Metadata Calibration_Type VARCHAR(255)
Assay_Bio_Target Assay_ID VARCHAR(255) pk
Assay_Bio_Target Target_Biospecimen_Type VARCHAR(255) pk
Biospecimen_Type Biospecimen_Type VARCHAR(255) pk
"""

MAPPING = {
    "submission.csv": ["Submission"],
    "baseline.csv": ["Participant_Visit_Info", "Participant"],
    "follow_up.csv": ["Participant_Visit_Info"],
    "covid_history.csv": ["Covid_History"],
    "covid_vaccination_status.csv": ["Covid_Vaccination_Status"],
    "biospecimen.csv": ["Tube", "Biospecimen"],
    "aliquot.csv": ["Tube", "Aliquot"],
    "equipment.csv": ["Equipment", "Biospecimen_Equipment"],
    "assay_data.csv": ["Assay_Metadata", "Assay_Bio_Target"],
}


def catalog_entries():
    from tabload.sources.catalog import Entry

    entries = []
    for line in CATALOG.strip().splitlines():
        table, column, kind, *flags = line.split()
        target = next((f[3:].split(".") for f in flags if f.startswith("fk=")), (None, None))
        entries.append(Entry(table, column, kind, "pk" in flags, "auto" in flags, *target))
    return tuple(entries)


def write_csv(path: Path, header: list[str], *lines: list) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="", encoding="utf-8") as stream:
        csv.writer(stream).writerows([header, *lines])


def land(root: Path, site: str, stamp: str, name: str, intent: str, files: dict[str, list[list]]) -> Path:
    """One submission folder with its header file."""
    folder = root / STUDY / site / stamp / name / "UnZipped_Files"
    write_csv(
        folder / "submission.csv", ["Submitting Center", f"Center of {site}"], ["Number of Participants", 3],
        ["Number of Biospecimens", 3], ["Number of Aliquots", 3], ["Submission Intent", intent],
    )
    for file, (header, *lines) in files.items():
        write_csv(folder / file, header, *lines)
    return folder


def first_submission(root: Path) -> None:
    land(root, "Site_99", "13-05-09-02-28-2021", "submission_001_first.zip", "Create", {
        "baseline.csv": [
            ["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity", "Comments"],
            ["99_000001", "90+", "Healthy_Control", "24.95", "", "N/A"],
            ["99_000002", "45", "Cancer", "Not Reported", "", ""],
            ["99_000003", "33", "Cancer", "18.4", "", "Invalid data entry; do not include"],
            ["99_300777", "50", "Cancer", "30", "", ""],
            ["", "", "", "", "", ""],
        ],
        "followup.csv": [
            ["Visit_Number", "Research_Participant_ID", "Baseline_Visit", "Cohort"],
            ["2", "99_000001", "No", "Healthy_Control"],
            ["-1", "99_000002", "No", "HIV"],
        ],
        "covid_history.csv": [
            ["Research_Participant_ID", "Visit_Number", "COVID_Status", "Breakthrough_COVID", "SARS-CoV-2_Variant",
             "Symptomatic_COVID", "Disease_Severity", "Symptoms", "PCR_Test_Date_Duration_From_Index",
             "Rapid_Antigen_Test_Date_Duration_From_Index", "Antibody_Test_Date_Duration_From_Index", "Comments"],
            ["99_000001", "Baseline(1)", "Positive by PCR, Negative by Antigen", "Yes", "Unavailable", "No", "3", "Cough",
             "10", "N/A", "20", ""],
            ["99_000002", "Baseline(1)", "Negative by PCR", "No", "X", "No", "3", "Cough", "", "", "", ""],
            ["99_000002", "-1", "Positive by PCR", "No", "X", "Maybe", "3", "Cough", "", "", "", ""],
        ],
        "covid_vaccination_status.csv": [
            ["Research_Participant_ID", "Visit_Number", "Vaccination_Status", "Comments"],
            ["99_000001", "1", "Dose 1", ""],
            ["99_000001", "2", "Dose 1:Bivalent", ""],
            ["99_000002", "1", "Unvaccinated", ""],
        ],
        "biospecimen.csv": [
            ["Biospecimen_ID", "Research_Participant_ID", "Visit_Number", "Biospecimen_Type", "Collection_Tube_Type",
             "Collection_Tube_Type_Lot_Number", "Collection_Tube_Type_Catalog_Number", "Collection_Tube_Type_Expiration_Date"],
            ["99_000001_101", "99_000001", "1", "Lymphocytes", "EDTA", "L1", "C1", "2023-01-31"],
            ["99_000002_101", "99_000002", "1", "Serum", "EDTA", "L1", "C1", "1/31/2023"],
            ["99_000009_101", "99_000009", "1", "Serum", "EDTA", "L1", "C1", "2023-01-31"],
        ],
        "aliquot.csv": [
            ["Aliquot_ID", "Biospecimen_ID", "Aliquot_Volume", "Aliquot_Tube_Type", "Aliquot_Tube_Type_Lot_Number",
             "Aliquot_Tube_Type_Catalog_Number", "Aliquot_Tube_Type_Expiration_Date"],
            ["99_000001_101_1", "99_000001_101", "1.5", "Cryo", "L7", "C7", "2024-05-01"],
            ["99_000001_101_2 ml", "99_000001_101", "0.5", "Cryo", "L7", "C7", "2024-05-01"],
        ],
        "equipment.csv": [
            ["Biospecimen_ID", "Equipment_ID", "Equipment_Type", "Comments"],
            ["99_000001_101", "E1", "Centrifuge", ""],
            ["99_000002_101", "E1", "Centrifuge", "x"],
        ],
    })


def second_submission(root: Path) -> None:
    """Resubmits one participant with a new cohort and adds one; columns in another order."""
    land(root, "Site_99", "2021-03-01-10-00-00", "submission_002_second.zip", "Update", {
        "baseline.csv": [
            ["Cohort", "Research_Participant_ID", "BMI", "Age", "Obesity"],
            ["Transplant", "99_000002", "40", "46", ""],
            ["Cancer", "99_000004", "25", "70", ""],
        ],
    })
