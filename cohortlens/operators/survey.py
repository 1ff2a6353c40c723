"""Cohort of one survey's respondents with attributes joined by entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import fixed_values as fixed
from cohortlens.functions import recode
from cohortlens.operators.assemble import left_join_by_entity, zero_fill
from cohortlens.operators.reshape import pivot_counts, pivot_presence


def label_respondents(
    answers: DataFrame, first: DataFrame, key: str, after: int, start: str = "condition_start",
    label: str = "depressive_disorder",
) -> DataFrame:
    """Respondents with a key; label 1 if their first event lies in a year after ``after``."""
    later = first.filter(F.year(start) > after).select(key, F.lit(1).alias(label))
    return (
        answers.filter(F.col(key).isNotNull())
        .join(later, key, "left")
        .withColumn(label, recode.present(label))
    )


def respondent_demographics(
    respondents: DataFrame, demographics: DataFrame, key: str,
    race: str = "race", race_code: str = "race_ethnicity_code",
    gender: str = "gender", language: str = "language",
    gender_words: Mapping[str, str] | None = None, plain_language: str = "English",
) -> DataFrame:
    """Race and gender from either source, language collapsed; rows missing one in both are dropped.

    Race prefers the survey, gender prefers the demographics file.
    """
    words = gender_words or {"Male": "M", "Female": "F"}
    recorded = demographics.select(
        key, F.col(race_code).alias("_race"), F.col(gender).alias("_gender"), F.col(language).alias("_language")
    )
    joined = respondents.join(recorded, key, "left")
    said = recode.first_match([(F.col(gender) == w, short) for w, short in words.items()], F.col(gender))
    known = (recode.missing_in_all(race, "_race") == 0) & (recode.missing_in_all(gender, "_gender") == 0)
    return joined.filter(known).withColumns(
        {
            race: recode.prefer(race, "_race"),
            gender: recode.prefer(F.col("_gender"), said),
            language: F.when(F.col("_language").isNull(), "not_recorded")
            .when(F.col("_language") == plain_language, plain_language)
            .otherwise("other"),
        }
    ).drop("_race", "_gender", "_language")


def status_in_year(
    status: DataFrame, key: str, in_year: Column, values: Sequence[str] = ("F", "R", "S"), column: str = "eligibility",
    other: str | None = None,
) -> DataFrame:
    """0/1 per status value an entity holds in the year."""
    return pivot_presence(status.filter(in_year), [key], column, values, other=other)


def absences_in_year(
    attendance: DataFrame, key: str, in_year: Column, status: str = "status", excuse: str = "excuse"
) -> DataFrame:
    """Excused and unexcused absence rows of the year."""
    rows = attendance.filter(
        in_year
        & F.col(status).isin(fixed.ATTENDANCE_STATUSES["absence"])
        & F.col(excuse).isin(fixed.EXCUSED + fixed.UNEXCUSED)
    ).withColumn("absence_type", F.when(F.col(excuse).isin(fixed.UNEXCUSED), "unexcused").otherwise("excused"))
    return pivot_counts(rows, [key], "absence_type", ["excused", "unexcused"], other=None)


def grade_summary(
    grades: DataFrame, key: str, in_scope: Column, score: str = "score",
    families: Mapping[str, Sequence[str]] | None = None,
    ungraded: Sequence[str] = tuple(fixed.SURVEY_UNGRADED),
    other: str | None = "other_grades",
) -> DataFrame:
    """Courses in scope per entity, and graded courses per family, those of no family in ``other``.

    The course total counts every row in scope; entities without a graded one are absent.
    """
    families = families or fixed.SURVEY_GRADE_FAMILIES
    listed = [v for family in families.values() for v in family]
    graded = F.col(score).isNotNull() & ~F.col(score).isin(list(ungraded))
    return (
        grades.filter(in_scope)
        .groupBy(key)
        .agg(
            F.count("*").alias("total_courses"),
            F.count_if(graded).alias("_graded"),
            *[F.count_if(graded & F.col(score).isin(list(v))).alias(n) for n, v in families.items()],
            *([F.count_if(graded & ~F.col(score).isin(listed)).alias(other)] if other else []),
        )
        .filter(F.col("_graded") > 0)
        .drop("_graded")
    )


def survey_cohort(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """All attributes by entity, numeric gaps filled with 0."""
    return zero_fill(left_join_by_entity(base, tables, key))
