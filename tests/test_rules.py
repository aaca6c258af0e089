"""Hand-computed values of the conversion and domain rules."""

import datetime

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import rows
from tabload import config
from tabload.config import CastSpec
from tabload.functions import dates, keys, nulls, numbers, text
from tabload.operators import cast, rules


def apply(spark, expression, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


def test_aliquot_ids(spark):
    said = ["99_000001_101_1", "99_000001_101_2 ml", "99_000001_101_1x", "99_000001_101_123", "99_000001_101_ab", "short"]
    assert apply(spark, text.pad_aliquot_id, *said) == [
        "99_000001_101_01", "99_000001_101_02", "99_000001_101_01", "99_000001_101_123", "99_000001_101_ab", "short",
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("019_aml ", min_size=0, max_size=20), min_size=20, max_size=60))
def test_aliquot_ids_stay_when_normalised_again(spark, ids):
    once = apply(spark, text.pad_aliquot_id, *ids)
    assert apply(spark, text.pad_aliquot_id, *once) == once


def test_visit_keys(spark):
    def key(cell):
        return keys.visit_key(F.lit("P"), F.lit("Baseline"), cell)

    said = ["1", "10", "20", "-1", "Unscheduled", "Baseline(1)", "1.0", "01"]
    assert apply(spark, key, *said) == [
        "P : B01", "P : B10", "P : B20", "P : B-1", "P : BUnscheduled", "P : B01", "P : B01", "P : B01",
    ]


def test_dilutions(spark):
    assert apply(spark, numbers.dilution, "1", "400", "0.00125", "none", None, "x", "99950", "938.5") == [
        "1.00E+0", "4.00E+2", "1.25E-3", "1.00E+0", None, None, "1.00E+5", "9.38E+2",
    ]


def test_rounding_and_top_codes(spark):
    assert apply(spark, numbers.round_measure, "90+", "23.44", "24.95", "x", None) == [90.0, 23.4, 25.0, None, None]
    assert apply(spark, numbers.is_top_coded, "90+", "90", "x+", None) == [True, False, False, False]


def test_censored_results(spark):
    said = ["<0.5", ">100", "Nonreactive", "Reactive", "7"]
    assert apply(spark, numbers.uncensor, *said) == ["0.5", "100", None, None, "7"]
    assert apply(spark, numbers.censor_flag, *said) == ["below", "above", "qualitative", "qualitative", None]


def test_lenient_numbers(spark):
    said = ["Baseline(1)", "3.0", "0.123456", "1e3", "x", "-1e9", "Not Reported", "N/A"]
    assert apply(spark, numbers.lenient_number, *said) == [1.0, 3.0, 0.12346, 1000.0, None, None, None, None]
    assert apply(spark, numbers.whole_number, "3.0", "2.5", "x") == [3, None, None]


def test_trailing_zero(spark):
    assert apply(spark, text.strip_trailing_zero, "10.0", "10.05", "x.0y") == ["10", "10.05", "x.0y"]


def test_null_tokens(spark):
    assert apply(spark, nulls.blank_tokens, "N/A", "nan", "", " NULL ", "Not Reported", " a") == [
        None, None, None, None, "Not Reported", " a",
    ]


def test_canonical_text(spark):
    assert apply(spark, text.canonical, "\t it's \n", "''", " ", None) == ["its", None, None, None]


def test_submission_times(spark):
    when = datetime.datetime(2021, 2, 28, 13, 5, 9)
    assert apply(spark, dates.submission_time, "13-05-09-02-28-2021", "2021-02-28-13-05-09", "x") == [when, when, None]


def test_dates_in_several_layouts(spark):
    day = datetime.date(2021, 3, 4)
    said = ["2021-03-04", "3/4/2021", "2021/03/04", "4-Mar-2021", "Mar 4, 2021", "20210304", "N/A", "0000-00-00", "soon"]
    assert apply(spark, dates.parse_date, *said) == [day] * 6 + [None] * 3


def test_path_decoding(spark):
    assert apply(spark, text.decode_path, "a+b/%28c%29", "100%") == ["a b/(c)", "100%"]


def test_obesity_bands(spark):
    said = ["18.4", "18.5", "24.9", "25.0", "30.0", "35.0", "40.0", "Not Reported", None, "0", "24.95"]
    df = spark.createDataFrame([(i, v, "told") for i, v in enumerate(said)], "i int, BMI string, Obesity string")
    assert [r.Obesity for r in rules.obesity_bands(df).orderBy("i").collect()] == [
        "Underweight", "Normal Weight", "Normal Weight", "Overweight", "Class 1 Obesity", "Class 2 Obesity",
        "Class 3 Obesity", "Not Reported", "told", "told", "Overweight",
    ]


def covid(spark, *cases):
    columns = ["COVID_Status", "Symptomatic_COVID", "SARS-CoV-2_Variant", "Breakthrough_COVID", "Disease_Severity", "Symptoms"]
    df = spark.createDataFrame([(*c, "Yes", "3", "cough") for c in cases], ", ".join(f"`{c}` string" for c in columns))
    return rules.apply_covid_tree(df)


def test_covid_tree(spark):
    kept, dropped = covid(
        spark, ("Positive by PCR, Negative by Antigen", "No", "Unavailable"), ("Negative by PCR", "No", "X"),
        ("Positive by PCR", "Maybe", "X"), ("No COVID Event Reported", None, None), ("Positive by PCR", "Unknown", "Delta"),
    )
    assert rows(kept, "COVID_Status", "SARS-CoV-2_Variant", "Disease_Severity", "Symptoms", "Breakthrough_COVID") == [
        ("Negative by PCR", "N/A", "0", "N/A", "N/A"),
        ("No COVID event reported", "N/A", "Not Reported", "N/A", "N/A"),
        ("Positive by PCR", "Delta", "3", "No symptoms reported", "Yes"),
        ("Positive by PCR, Negative by Antigen", "Unknown", "1", "N/A", "Yes"),
    ]
    assert rows(dropped, "COVID_Status", "Symptomatic_COVID") == [("Positive by PCR", "Maybe")]


def test_covid_branches_cover_all_rows_once(spark):
    statuses = ["No COVID event reported", "Negative by PCR", "Positive by PCR", "Positive, Negative", "Pending", None]
    cases = [(s, y, v) for s in statuses for y in ("Yes", "No", "Unknown", "Maybe", None) for v in ("X", None)]
    kept, dropped = covid(spark, *cases)
    assert kept.count() + dropped.count() == len(cases)


def test_repeated_vaccinations(spark):
    df = spark.createDataFrame(
        [("P", "Dose 1", None, 1), ("P", "Dose 1:Bivalent", None, 2), ("P", "Unvaccinated", None, 1),
         ("P", "Unvaccinated", None, 2), ("Q", "Dose 1", None, 1),
         ("R", "Dose 2", "Record previously submitted in error.", 9), ("R", "Dose 2", None, 1)],
        "Research_Participant_ID string, Vaccination_Status string, Covid_Vaccination_Status_Comments string, Submission_Index int",
    )
    flagged = rules.flag_repeated_vaccinations(df, ["Vaccination_Status", "Submission_Index"])
    marked = flagged.filter(F.col("Covid_Vaccination_Status_Comments") == config.VACCINE_DUPLICATE_COMMENT)
    assert rows(marked, "Research_Participant_ID", "Vaccination_Status") == [("P", "Dose 1")]
    assert flagged.count() == 7


def test_drug_types(spark):
    df = spark.createDataFrame(
        [("Not Reported", "x"), ("Current user", "Unknown"), ("Never user", "Unknown"), ("Current user", "x"), (None, None)],
        "Drug_Use string, Drug_Type string",
    )
    assert [r.Drug_Type for r in rules.recode_drugs(df).collect()] == [
        "Drug Type Not Reported", "Drug Type Not Reported", "Unknown", "x", "Drug Type Not Reported",
    ]


def test_cast_lists_what_it_rejects(spark):
    df = spark.createDataFrame(
        [("7", "90+", "<3.26", "none", "2021-01-02", "8:05"), ("x", "old", "Reactive", "zz", "soon", "late"),
         ("Not Reported", None, None, None, "N/A", None)],
        "n string, Age string, Derived_Result string, Sample_Dilution string, d string, t string",
    ).withColumn("Subaliquot_ID", F.lit("s"))
    spec = CastSpec({"n": "INTEGER", "Age": "FLOAT", "Derived_Result": "DOUBLE", "d": "DATE", "t": "TIME"})
    got = [tuple(r) for r in cast.schema_cast(df, spec).drop("Subaliquot_ID").collect()]
    assert got == [
        (7, 90.0, 3.3, "1.00E+0", datetime.date(2021, 1, 2), "08:05:00", []),
        (None, None, None, None, None, None, ["n", "Age", "Sample_Dilution", "d", "t"]),
        (None, None, None, None, None, None, []),
    ]


def test_cast_again_changes_nothing(spark):
    df = spark.createDataFrame([("7", "1.23456789", "3/4/2021", "2021-03-04 05:06:07", "a")], "n string, f string, d string, s string, c string")
    spec = CastSpec({"n": "INTEGER", "f": "DOUBLE", "d": "DATE", "s": "DATETIME"})
    once = cast.schema_cast(df, spec).drop("_bad")
    assert rows(cast.schema_cast(once, spec).drop("_bad")) == rows(once)


@pytest.mark.parametrize("names, values", [(["a", "b"], [("x", None), (None, "x")]), (["a", "b"], [("xy", "z"), ("x", "yz")])])
def test_hash_keys_tell_rows_apart(spark, names, values):
    df = spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))
    assert df.select(keys.hash_key(*[F.col(n) for n in names])).distinct().count() == 2
