"""The whole load, from landed files to published tables."""

import pytest

from conftest import rows
from landing import MAPPING, STUDY, catalog_entries, first_submission, land, second_submission
from tabload.plans.load import run_load, run_refresh
from tabload.plans.tables import LoadJob
from tabload.sinks.publish import SnapshotStore
from tabload.sources.catalog import Catalog
from tabload.sources.listing import list_files
from tabload.streaming.load import stream_load


@pytest.fixture(scope="module", autouse=True)
def quick_planning(spark):
    """Constraint inference takes most of the planning time of these tiny loads."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    yield
    spark.conf.unset("spark.sql.constraintPropagation.enabled")


SMALL = {"submission.csv": ["Submission"], "baseline.csv": ["Participant_Visit_Info", "Participant"]}


def make_job(spark, folder, mapping=MAPPING):
    store = SnapshotStore(spark, str(folder / "store"))
    sites = spark.createDataFrame([("Site_99", "99"), ("Site_98", "98")], "site_folder string, site_code string")
    excluded = spark.createDataFrame([("99_300777",)], "id string")
    return LoadJob(store, Catalog(catalog_entries()), mapping, sites, excluded_ids=excluded)


def read(job, table):
    return job.store.read(table, job.catalog.schema(table))


def load(job, landing, run_id):
    return run_load(job, list_files(job.spark, str(landing)), run_id)


def log_of(result):
    return {(r.table_name, r.op): r.n_rows for r in result.log.collect()}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("load")
    first_submission(folder / "landing")
    job = make_job(spark, folder)
    return job, folder, load(job, folder / "landing", "run-1")


def test_first_run_publishes(loaded):
    job, _, result = loaded
    assert [r.error for r in result.log.collect() if r.error] == []
    assert result.published
    assert log_of(result)[("Participant", "insert")] == 2


def test_participants(loaded):
    job, _, _ = loaded
    assert rows(read(job, "Participant")) == [("99_000001", 90.0, "99"), ("99_000002", 45.0, "99")]


def test_visits_bands_and_latest_cohort(loaded):
    job, _, _ = loaded
    visits = read(job, "Participant_Visit_Info")
    got = rows(visits, "Visit_Info_ID", "CBC_Classification", "Obesity", "BMI")
    assert got == sorted([
        ("99_000001 : B01", "Healthy Control", "Overweight", 25.0),
        ("99_000001 : F02", "Healthy Control", None, None),
        ("99_000002 : B01", "Cancer", "Not Reported", None),
        ("99_000002 : F-1", "HIV", None, None),
    ], key=repr)


def test_covid_history(loaded):
    job, _, result = loaded
    got = rows(
        read(job, "Covid_History"), "Visit_Info_ID", "SARS-CoV-2_Variant", "Disease_Severity", "Average_Duration_Of_Test"
    )
    assert got == [("99_000001 : B01", "Unknown", "1", 15.0), ("99_000002 : B01", "N/A", "0", None)]
    reasons = {(r.source, r.reason) for r in result.rejects.collect()}
    assert ("covid_history.csv", "status and symptoms fit no branch") in reasons


def test_vaccination_flags(loaded):
    job, _, _ = loaded
    got = rows(
        read(job, "Covid_Vaccination_Status"), "Research_Participant_ID", "Vaccination_Status",
        "Covid_Vaccination_Status_Comments",
    )
    assert got == [
        ("99_000001", "Dose 1", "Record previously submitted: Duplicated."),
        ("99_000001", "Dose 1:Bivalent", None),
        ("99_000002", "Unvaccinated", None),
    ]


def test_containers_specimens_and_links(loaded):
    job, _, result = loaded
    assert read(job, "Tube").count() == 2
    specimens = read(job, "Biospecimen")
    assert rows(specimens, "Biospecimen_ID", "Visit_Info_ID", "Biospecimen_Type") == [
        ("99_000001_101", "99_000001 : B01", "PBMC"), ("99_000002_101", "99_000002 : B01", "Serum"),
    ]
    assert specimens.filter("Biospecimen_Tube_ID is null").count() == 0
    assert ("biospecimen.csv > Biospecimen", "no such visit") in {(r.source, r.reason) for r in result.rejects.collect()}
    assert rows(read(job, "Aliquot"), "Aliquot_ID", "Aliquot_Volume") == [("99_000001_101_01", 1.5), ("99_000001_101_02", 0.5)]
    links = rows(read(job, "Biospecimen_Equipment"))
    assert links == [("99_000001_101", 1), ("99_000002_101", 1)]


def test_submission_row(loaded):
    job, _, _ = loaded
    row = read(job, "Submission").first()
    assert (row.Submission_Index, row.Submission_CBC_Name, row.Submission_File_Name, row.Submission_Intent) == (
        1, "Center of Site_99", "first.zip", "Create"
    )
    assert str(row.Submission_Time) == "2021-02-28 13:05:09"
    assert row.Submission_S3_Path.startswith(STUDY)


def test_second_run_updates_and_keeps(spark, loaded, tmp_path):
    job, folder, _ = loaded
    again = load(job, folder / "landing", "run-1b")
    assert log_of(again) == {("Submission", "absent"): 0}
    second_submission(folder / "landing")
    result = load(job, folder / "landing", "run-2")
    assert result.published
    assert log_of(result)[("Participant", "insert")] == 1
    assert log_of(result)[("Participant", "update")] == 1
    assert rows(read(job, "Participant"), "Research_Participant_ID", "Age") == [
        ("99_000001", 90.0), ("99_000002", 46.0), ("99_000004", 70.0),
    ]
    assert rows(read(job, "Submission"), "Submission_Index", "Submission_Intent") == [(1, "Create"), (2, "Update")]
    before = read(job, "Covid_History").count()
    assert before == 2
    repeated = run_load(job, list_files(spark, str(folder / "landing")), "run-2")
    assert repeated.published and log_of(repeated) == log_of(result)


def small_submission(root):
    land(root, "Site_99", "13-05-09-02-28-2021", "submission_001_first.zip", "Create", {
        "baseline.csv": [
            ["Research_Participant_ID", "Age", "Cohort", "BMI", "Obesity"],
            ["99_000001", "90+", "HIV", "24.95", ""], ["99_000002", "45", "Cancer", "x", ""],
        ],
    })


def test_failed_run_changes_nothing(spark, tmp_path):
    small_submission(tmp_path / "landing")
    job = make_job(spark, tmp_path, {"submission.csv": ["Submission"], "baseline.csv": ["Participant", "Aliquot"]})
    result = load(job, tmp_path / "landing", "bad")
    assert not result.published
    assert [r.table_name for r in result.log.collect() if r.error] == ["Aliquot"]
    assert job.store.locations() == {}


def test_invalid_intent_is_rejected(spark, tmp_path):
    land(tmp_path / "landing", "Site_98", "2021-03-01-10-00-00", "submission_003_x.zip", "Delete", {
        "baseline.csv": [["Research_Participant_ID", "Age"], ["98_000001", "5"]],
    })
    result = load(make_job(spark, tmp_path), tmp_path / "landing", "run")
    assert {r.reason for r in result.rejects.collect()} == {"intent is neither Create nor Update"}


def test_stream_equals_batch(spark, tmp_path):
    small_submission(tmp_path / "landing")
    second_submission(tmp_path / "landing")
    batch, stream = make_job(spark, tmp_path / "batch", SMALL), make_job(spark, tmp_path / "stream", SMALL)
    load(batch, tmp_path / "landing", "one")
    results = stream_load(stream, str(tmp_path / "landing"), str(tmp_path / "checkpoint"))
    assert all(r.published for r in results)
    assert stream_load(stream, str(tmp_path / "landing"), str(tmp_path / "checkpoint")) == []
    for table in ("Participant", "Participant_Visit_Info"):
        assert rows(read(stream, table)) == rows(read(batch, table))


def test_refresh_loads_assays(spark, tmp_path):
    job = make_job(spark, tmp_path)
    types = spark.createDataFrame([("Serum",), ("Plasma",), ("Lavage_Fluid",)], "Biospecimen_Type string")
    job.store.stage(types, "seed", "tables/Biospecimen_Type")
    job.store.publish("seed", {"Biospecimen_Type": 3})
    assays = spark.createDataFrame(
        [("99_001", "N/A", "Yes", "No", None), ("99_002", "Linear", "Yes", "Yes", "Yes")],
        "Assay_ID string, Calibration_Type string, Target_biospecimen_is_Serum string, "
        "Target_biospecimen_is_Plasma string, `Target_biospecimen_is_Lavage/Fluid` string",
    )
    result = run_refresh(job, {"assay_data.csv": assays}, "assays")
    assert [r.error for r in result.log.collect() if r.error] == []
    assert rows(read(job, "Assay_Bio_Target")) == [
        ("99_001", "Serum"), ("99_002", "Lavage_Fluid"), ("99_002", "Plasma"), ("99_002", "Serum"),
    ]
