"""Rule sets: branches, recodes that depend on other columns, code lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabload import config
from tabload.functions import numbers, text
from tabload.operators import dedup
from tabload.operators.joins import compare_stored, lookup


def covid_branch(status: Column, symptomatic: Column) -> Column:
    """Branch of a covid-history row; NULL where no branch applies."""
    return (
        F.when(status.isin(*config.NO_COVID_STATUSES), "none")
        .when(
            status.contains("Positive"),
            F.when(symptomatic == "Yes", "symptoms").when(symptomatic == "No", "no_symptoms")
            .when(symptomatic == "Unknown", "unknown_symptoms"),
        )
        .when(status.contains("Negative"), "negative")
    )


def apply_covid_tree(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Columns implied by the covid status, and the rows that fall in no branch."""
    said = F.col("COVID_Status")
    status = F.when(said == "No COVID Event Reported", config.NO_COVID_STATUSES[0]).otherwise(said)
    branched = df.withColumn("COVID_Status", status).withColumn(
        "_branch", covid_branch(F.col("COVID_Status"), F.col("Symptomatic_COVID"))
    )
    branch, none = F.col("_branch"), F.lit("N/A")
    no_event = branch.isin("none", "negative")
    variant = F.col("`SARS-CoV-2_Variant`")
    outcome = {
        "Breakthrough_COVID": F.when(no_event, none).otherwise(F.col("Breakthrough_COVID")),
        "SARS-CoV-2_Variant": F.when(no_event, none)
        .when(variant.isNull() | variant.isin("Unavailable", "N/A"), "Unknown")
        .otherwise(variant),
        "Symptomatic_COVID": F.when(no_event, none).otherwise(F.col("Symptomatic_COVID")),
        "Disease_Severity": F.when(branch == "none", "Not Reported")
        .when(branch == "negative", "0")
        .when(branch == "no_symptoms", "1")
        .otherwise(F.col("Disease_Severity").cast("string")),
        "Symptoms": F.when(no_event | (branch == "no_symptoms"), none)
        .when(branch == "unknown_symptoms", "No symptoms reported")
        .otherwise(F.col("Symptoms")),
    }
    kept = branched.filter(branch.isNotNull()).withColumns(outcome).drop("_branch")
    return kept, branched.filter(branch.isNull()).drop("_branch")


def flag_repeated_vaccinations(df: DataFrame, order: list[str]) -> DataFrame:
    """Comment all but the last record of a participant's repeated vaccination status.

    Rows must be distinct: the remaining columns complete the order.
    """
    comment = "Covid_Vaccination_Status_Comments"
    status = F.col("Vaccination_Status")
    exempt = status.isin(*config.UNVACCINATED_STATUSES) | F.coalesce(
        F.col(comment).isin(*config.VACCINE_ERROR_COMMENTS), F.lit(False)
    )
    normal = df.withColumn("_status", text.remove_literals(status, config.VACCINE_SUFFIXES))
    groups = ["Research_Participant_ID", "_status"]
    total = [*order, *[c for c in df.columns if c not in order and c not in groups]]
    flagged = dedup.flag_superseded(normal, groups, total, "_superseded", exempt)
    return flagged.withColumn(
        comment,
        F.when(F.col("_superseded") == 1, config.VACCINE_DUPLICATE_COMMENT).otherwise(F.col(comment)),
    ).drop("_superseded", "_status")


def recode_drugs(df: DataFrame) -> DataFrame:
    """Type of a drug whose use or type was not reported."""
    use, kind = F.col("Drug_Use"), F.col("Drug_Type")
    unreported = use == "Not Reported"
    untyped = ~F.coalesce(use.isin("Never user", "Current non-user"), F.lit(False)) & (
        kind.isNull() | kind.isin("Unknown", "N/A", "Drug Not Disclosed")
    )
    return df.withColumn(
        "Drug_Type", F.when(unreported | untyped, "Drug Type Not Reported").otherwise(kind)
    )


def obesity_bands(df: DataFrame) -> DataFrame:
    """Obesity class from the body-mass index, which then is a number or NULL."""
    said = F.col("BMI").cast("string")
    bmi = numbers.round_measure(said, 1)
    current = F.col("Obesity")
    band = (
        F.when(F.trim(said) == config.BMI_NOT_REPORTED, config.BMI_NOT_REPORTED)
        .when(bmi < 0, config.BMI_NOT_REPORTED)
        .otherwise(numbers.band(bmi, config.BMI_BANDS, current))
    )
    return df.withColumns({"Obesity": band, "BMI": F.when(bmi >= 0, bmi)})


def explode_codes(df: DataFrame, column: str, term: str, separator: str = r"\|") -> DataFrame:
    """One row per term of a delimited list; a missing list is ``Not Reported``."""
    listed = F.coalesce(F.col(column), F.lit("Not Reported"))
    return df.withColumn(term, F.explode(F.split(listed, separator))).withColumn(term, text.strip(F.col(term)))


def normalise_codes(
    df: DataFrame, dictionary: DataFrame, key: str, column: str, term: str, found: str, separator: str = r"\|"
) -> DataFrame:
    """Terms of a delimited list with their dictionary entry, once per key.

    Rows are made distinct before the dictionary join, so a frequent term is not joined twice.
    """
    terms = explode_codes(df.select(key, column), column, term, separator).select(key, term).distinct()
    return lookup(terms, dictionary, [term], found)


def missing_codes(normalised: DataFrame, stored: DataFrame, key: str, term: str, value: str) -> DataFrame:
    """Normalised terms that are not stored yet."""
    compared = compare_stored(normalised, stored, [key, term], value)
    return compared.filter(F.col("status") == "missing").drop("status", f"stored_{value}")


def fill_assay_quality(df: DataFrame) -> DataFrame:
    """Blank quality-control cells are labelled, blank comments stay blank."""
    named = [c for c in df.columns if c != "Comments"]
    label = F.lit(config.NO_DATA_PROVIDED)
    filled = df.withColumns({c: F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), label) for c in named})
    return filled.withColumn("Comments", F.coalesce(F.col("Comments"), F.lit(""))) if "Comments" in df.columns else filled


def fill_calibration(df: DataFrame) -> DataFrame:
    kind = F.col("Calibration_Type")
    blank = kind.isNull() | kind.isin("", "N/A")
    return df.withColumn("Calibration_Type", F.when(blank, config.NO_DATA_PROVIDED).otherwise(kind))
