"""Cohort filters."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.clean import reader_result
from cohortloom.operators.exams import match_studies

ACR_COLUMNS = ("L1_ACR_SG", "L1_ACR_SD", "L2_ACR_SG", "L2_ACR_SD")
HISTORY, MATCHED, POSITIVE = "has_history", "DICOM_Study", "L1L2_positif"

# Names of the ready-made filters and the test age.
ACR5_FILTER = "GET_ACR5"
POSITIVE_FILTER = "GET_POSITIVE_WITH_IMG_ONLY"
TEST_AGE = 69


def any_acr5() -> Column:
    hit = F.col(ACR_COLUMNS[0]) == "5"
    for c in ACR_COLUMNS[1:]:
        hit = hit | (F.col(c) == "5")
    return hit


def positive() -> Column:
    return F.col(POSITIVE)


def with_images() -> Column:
    return F.col(MATCHED).isNotNull()


def filter_condition(field: str | None = None, value: str | None = None) -> Column:
    """The person has an imaging history (`has_history`), plus one named, flag or equality condition.

    The named positive filter needs the matched study column.
    """
    if field == ACR5_FILTER:
        wanted = any_acr5()
    elif field == POSITIVE_FILTER:
        wanted = positive() & with_images()
    elif field is None:
        wanted = F.lit(True)
    elif value in ("True", "False"):
        wanted = F.col(field) == F.lit(value == "True")
    else:
        wanted = F.col(field) == F.lit(value)
    return wanted & F.col(HISTORY)


def apply_filter(df: DataFrame, field: str | None = None, value: str | None = None) -> DataFrame:
    return df.filter(filter_condition(field, value))


def label_matches(df: DataFrame, used: Mapping[str, tuple[str | None, str | None]]) -> DataFrame:
    """One row per exam and filter it passes, with the filter's label; one pass over the exams."""
    labels = F.filter(
        F.array(*[F.when(filter_condition(*args), F.lit(name)) for name, args in used.items()]),
        lambda label: label.isNotNull(),
    )
    return df.withColumn("used", F.explode(labels))


def test_cohort(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HISTORY) & any_acr5() & (F.col("Age_Mammo") == TEST_AGE))


def with_results(df: DataFrame) -> DataFrame:
    """Result of each reader."""
    return df.withColumns(
        {
            "L1_Result": reader_result("L1_ACR_SD", "L1_ACR_SG"),
            "L2_Result": reader_result("L2_ACR_SD", "L2_ACR_SG"),
        }
    )


def positive_with_images(exams: DataFrame, appts: DataFrame, person: str, date: str = "Date_Mammo") -> DataFrame:
    """Positive exams that have a study within one month, with the results of both readers.

    The flag is filtered before the match, which keeps negatives out of the join.
    """
    matched = match_studies(exams.filter(positive()), appts, person, date, MATCHED)
    return with_results(matched).filter(with_images())
