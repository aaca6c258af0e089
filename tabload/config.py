"""Value tables and rule specifications. Everything a site can vary is data, not code."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Texts, bounds and formats that results depend on.
# ---------------------------------------------------------------------------

# Cell texts a CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Further stand-ins for a missing value: in any text column, in numeric columns, in date columns.
TEXT_SENTINELS = ("No Data", "NAN")
NUMBER_SENTINELS = (-1e9, -10000.0)
NUMBER_NULL_TEXTS = ("Not Reported",)
DATE_SENTINELS = ("2000-01-01", "0000-00-00")

EXCLUDED_COMMENTS = ("Invalid data entry; do not include",)

FILE_KIND_ALIASES = {"followup.csv": "follow_up.csv", "consumables.csv": "consumable.csv"}
SECONDARY_CONFIRMATION = "secondary_confirmation"
SECONDARY_CONFIRMATION_KIND = "secondary_confirmation_test_result.csv"

COHORT_RECODES = {"Organ_Transplant": "Transplant", "Healthy_Control": "Healthy Control"}
SPECIMEN_RECODES = {"PBMC|serum": "PBMC|Serum", "serum": "Serum"}
CELL_RECODES = {"Lymphocytes": "PBMC", "Gist": "GIST"}
BASELINE_VISIT_RECODES = {"Baseline(1)": "1"}

# Upper edge (exclusive) of each body-mass band; values are rounded to one decimal first.
BMI_BANDS = (
    (18.5, "Underweight"),
    (25.0, "Normal Weight"),
    (30.0, "Overweight"),
    (35.0, "Class 1 Obesity"),
    (40.0, "Class 2 Obesity"),
    (None, "Class 3 Obesity"),
)
BMI_NOT_REPORTED = "Not Reported"

# Columns rounded to one decimal before the cast.
ONE_DECIMAL_COLUMNS = (
    "Age", "Storage_Time_in_Mr_Frosty", "Biospecimen_Collection_to_Test_Duration", "BMI", "Derived_Result",
)

# Columns whose text keeps a trailing ".0".
KEEP_TRAILING_ZERO = ("Derived_Result", "Raw_Result", "BMI", "Sample_Dilution")

# Date and time layouts, each with the shape of a text that is tried in it.
DATE_FORMATS = (
    ("yyyy-M-d", r"^\d{4}-\d{1,2}-\d{1,2}$"),
    ("M/d/yyyy", r"^\d{1,2}/\d{1,2}/\d{4}$"),
    ("yyyy/M/d", r"^\d{4}/\d{1,2}/\d{1,2}$"),
    ("d-MMM-yyyy", r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"),
    ("MMM d, yyyy", r"^[A-Za-z]{3} \d{1,2}, \d{4}$"),
    ("yyyyMMdd", r"^\d{8}$"),
    ("M/d/yy", r"^\d{1,2}/\d{1,2}/\d{2}$"),
)
LAST_SHORT_YEAR = 2068  # two-digit years up to 68 are of this century, 69 and up of the last
TIMESTAMP_FORMATS = (
    ("yyyy-M-d H:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}$"),
    ("yyyy-M-d H:mm:ss.SSSSSS", r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}\.\d{6}$"),
    ("yyyy-M-d'T'H:mm:ss", r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}$"),
    ("M/d/yyyy H:mm", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}$"),
    ("M/d/yyyy H:mm:ss", r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}:\d{2}$"),
)
SUBMISSION_TIME_FORMATS = ("HH-mm-ss-MM-dd-yyyy", "yyyy-MM-dd-HH-mm-ss")

# Participants whose id starts with one of these keep the cohort of each record.
COHORT_EXEMPT_SITES = ("41",)

NO_COVID_STATUSES = ("No COVID event reported", "No COVID data collected")
UNVACCINATED_STATUSES = ("Unvaccinated", "No vaccination event reported")
VACCINE_SUFFIXES = (":Bivalent", ":Monovalent XBB.1.5")
VACCINE_ERROR_COMMENTS = (
    "Record previously submitted in error.", "Vaccine Status does not exist, input error",
)
VACCINE_DUPLICATE_COMMENT = "Record previously submitted: Duplicated."

DURATION_COLUMNS = (
    "PCR_Test_Date_Duration_From_Index",
    "Rapid_Antigen_Test_Date_Duration_From_Index",
    "Antibody_Test_Date_Duration_From_Index",
)

# Columns the target database fills itself.
SERVER_COLUMNS = ("Normalized_Cohort", "Visit_Info_Comments", "Samples_Not_Useable")
# Columns never compared nor overwritten.
UNCOMPARED_COLUMNS = ("Primary_Study_Cohort", "Data_Release_Version", "Sunday_Prior_To_First_Visit")

ASSAY_ID_PATTERN = "^[0-9]{2}_[0-9]{3}$"
SKIPPED_ASSAY_MARK = "20210402"
PANEL_EXAMPLE_MARK = "blinded_validation_panel_results_example"
NO_DATA_PROVIDED = "No Data Provided"

# Path parts that select a job.
ROUTES = (
    ("Serology_Data_Files/Reference_Panel_Files/Reference_Panel_Submissions/", "panel_results"),
    ("CBC_Folders/Assay_Data/", "assay_data"),
    ("Vaccine_Respone_Study_Design/", "study_design"),
    ("Serology_Data_Files/biorepository_id_map/", "biorepository_map"),
    ("Reference+Panel+Submissions", "reference_panel"),
)

# Folders that the reference data of a job lies in.
JOB_FOLDERS = {
    "panel_results": "Serology_Data_Files/Reference_Panel_Files/Reference_Panel_Submissions/",
    "assay_data": "CBC_Folders/Assay_Data/",
    "study_design": "Vaccine_Respone_Study_Design/",
    "biorepository_map": "Serology_Data_Files/biorepository_id_map/",
    "reference_panel": "Serology_Data_Files/CDC_Confirmation_Results/",
}

DATA_RELEASE = "2.0.0"

# ---------------------------------------------------------------------------
# Specifications
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CastSpec:
    """How to type the columns of a table: declared type per column plus formatting rules."""

    types: dict[str, str]
    one_decimal: tuple[str, ...] = ONE_DECIMAL_COLUMNS
    censored: tuple[str, ...] = ("Derived_Result",)
    dilution: tuple[str, ...] = ("Sample_Dilution",)
    dilution_requires: str = "Subaliquot_ID"
    reject_column: str = "_bad"


@dataclass(frozen=True)
class DeltaSpec:
    """Key, version and compare rules of one target table."""

    keys: tuple[str, ...]
    ignore: tuple[str, ...] = UNCOMPARED_COLUMNS
    version: str | None = None
    absent_columns: str = "keep"
    label: str = "op"
    null_keys: bool = True  # whether a key may be NULL; without such keys an earlier partitioning is kept


@dataclass(frozen=True)
class CleanSpec:
    """Inputs of the per-file cleaning chain."""

    null_tokens: tuple[str, ...] = NULL_TOKENS
    excluded_comments: tuple[str, ...] = EXCLUDED_COMMENTS
    required_ids: tuple[str, ...] = ("Research_Participant_ID", "Biospecimen_ID")
    excludable_ids: tuple[str, ...] = ("Research_Participant_ID", "Biospecimen_ID", "Aliquot_ID")
    recodes: dict[str, dict[str, str]] = field(default_factory=lambda: {"Cohort": COHORT_RECODES})
