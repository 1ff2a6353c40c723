"""The school data model end to end: raw tables (``sources.tables.SCHEMAS``) to model tables.

Each function takes raw DataFrames and the spine and returns one table keyed by
(student_id, pred_dt). Nothing runs until a result is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import dates, recode
from cohortlens.functions import fixed_values as fixed
from cohortlens.operators import asof, assemble, fallback, grades, labels, spells, survey, windows
from cohortlens.operators.grid import SEMESTERS, Grid
from cohortlens.sources.tables import suffix_clashes

KEY = ["student_id"]
# fixed values: units whose students are in the cohort, and the condition flags used as features
UNITS = ["12", "13", "14"]
COMORBIDITIES = [
    "psychiatric_disorder_non_depressive", "stress_or_depression_related", "general_inflammatory_disease",
    "autoimmune_disease", "substance_related", "self_harm",
]
POSITIVE = "depressive_disorder"
LABEL = "depression_dx_in_next_6m"
LAGS = ["_6_12m", "_12_18m", "_18_24m"]


def spine(enrollment: DataFrame, grid: Grid = SEMESTERS, units: Sequence[str] = UNITS, split_on_gap: bool = True) -> DataFrame:
    """One row per student, enrolment spell and prediction date."""
    dated = enrollment.filter(F.col("school_id").isin(list(units))).select(
        "student_id", "person_id", dates.mdy("start_date").alias("start_date"), dates.mdy("end_date").alias("end_date")
    )
    merged = spells.merge_spells(dated, ["student_id", "person_id"], split_on_gap=split_on_gap)
    return spells.prediction_spine(merged, grid)


def attendance(rows: DataFrame, raw: DataFrame, grid: Grid = SEMESTERS, buckets: bool = True) -> DataFrame:
    """Absence days of the last half year per category, as counts or as 0/1 count ranges."""
    default = "other" if buckets else "attend_other"
    categories = [*fixed.ATTENDANCE_CATEGORIES[:-1], default]
    events = raw.select(
        "student_id",
        dates.mdy("date").alias("event_dt"),
        recode.attendance_category("excuse_code", "status", "excuse", default).alias("category"),
    )
    counts = windows.window_distinct_days(rows.filter("student_id is not null"), events, grid, KEY, categories)
    return windows.bucketed_one_hot(counts, KEY, categories, default) if buckets else counts


def behavior(rows: DataFrame, raw: DataFrame, grid: Grid = SEMESTERS, counts: bool = False) -> DataFrame:
    """Incident flags of the last half year with three lags, or incident counts."""
    dated = raw.withColumn("event_dt", dates.mdy("incident_date"))
    if counts:
        categories = [*[name for name, _, _ in fixed.RESOLUTIONS], fixed.RESOLUTION_DEFAULT]
        events = dated.withColumn("category", recode.pattern_category("resolution_name"))
        return windows.window_category_counts(rows, events, grid, KEY, categories)
    flags = recode.pattern_flags("resolution_name", prefix="behav_", suffix="_0_6m")
    events = dated.select("student_id", "event_dt", *flags)
    names = events.columns[2:]
    seen = windows.window_flags(rows, events, grid, KEY, names)
    return windows.row_lags(seen, KEY, windows.lag_names(names, "_0_6m", LAGS))


def _classified(conditions: DataFrame, classes: DataFrame) -> DataFrame:
    dated = conditions.withColumn("event_dt", dates.mdy("condition_start_date"))
    return labels.class_of(dated, classes, "health_condition", "inner")


def comorbidities(rows: DataFrame, conditions: DataFrame, classes: DataFrame) -> DataFrame:
    """Other conditions ever recorded before the prediction date."""
    return asof.ever_before_flags(rows, _classified(conditions, classes), KEY, COMORBIDITIES)


def demographics(rows: DataFrame, enrollment: DataFrame, raw: DataFrame) -> DataFrame:
    """Race, gender, language, age and tenure; enrolment is found by either key."""
    dated = enrollment.withColumn("birth_date", dates.mdy("birth_date"))
    return fallback.age_and_tenure(fallback.static_one_hot(rows, dated, raw)).drop(
        "enrollment_end", "pred_yr"
    )


def lunch_status(rows: DataFrame, raw: DataFrame) -> DataFrame:
    flags = {"FR_status": F.col("eligibility").isin("F", "R"), "HSA_status": F.col("eligibility").isin("H", "S", "A")}
    return asof.school_year_flags(rows, raw, KEY, flags)


def homeless(rows: DataFrame, raw: DataFrame) -> DataFrame:
    status = raw.withColumnRenamed("Student Number", "student_id")
    return asof.current_and_ever(rows, status, KEY, F.col("Homeless") == "Y", "homeless_y_in_yr", "homeless_y_ever")


def _dated_grades(graded: DataFrame, terms: DataFrame, keep: str) -> DataFrame:
    final = F.col("rask").ilike("Semester %") | F.col("rask").ilike("Term%")
    keys = ["student_id", "year", "course_name", "term_name", "rask"]
    kept = grades.dedup_keep_max(graded, keys, final=final, keep=keep)
    dated = terms.select("name", dates.mdy_hm("startDate").alias("start_dt"), dates.mdy_hm("endDate").alias("end_dt"))
    return grades.term_dates(kept, dated)


def grade_shares(
    rows: DataFrame, raw: DataFrame, terms: DataFrame, grid: Grid = SEMESTERS, families: bool = False, keep: str = "max"
) -> DataFrame:
    """Share of the last half year's courses per grade bucket with three lags, or per grade family."""
    if families:
        bucket = recode.members("score", fixed.GRADE_FAMILIES, fixed.GRADE_FAMILY_DEFAULT)
        names = {n: n for n in [*fixed.GRADE_FAMILIES, fixed.GRADE_FAMILY_DEFAULT]}
    else:
        bucket = recode.grade_bucket(F.col("`grading.scoreListItemName`"), "score")
        names = {k: f"grade_bucket{k}_6mo" for k in range(1, 6)}
    dated = _dated_grades(raw.withColumn("score_bucket", bucket), terms, keep)
    shares = windows.window_shares(rows, dated, grid, KEY, names, distinct_on=["course_name", "rask"])
    if families:
        return shares
    lags = windows.lag_names(list(names.values()), "_6mo", ["_12mo", "_18mo", "_24mo"])
    return windows.row_lags(shares, KEY, lags, default=0.0)


def household(rows: DataFrame, raw: DataFrame, grid: Grid = SEMESTERS, gender: str = "ContactID") -> DataFrame:
    """Household members per relation from the last yearly snapshot before the prediction date.

    Rows without student_id are found by person_id; both key columns are kept.
    """
    names = ["student_id", "person_id"]
    members = raw.filter(F.col("Relationship") != "Self").select(
        F.col("student_studentNumber").alias("student_id"), F.col("personID").alias("person_id"), "year",
        recode.relation_name("Relationship", gender).alias("relation"),
    ).filter(F.col("student_id").isNotNull() | F.col("person_id").isNotNull())
    relations = [*fixed.RELATIONS, "other"]
    snapshots = asof.snapshot_counts(members, names, "relation", relations)

    def by(key: str, other: str) -> DataFrame:
        part = rows.filter(F.col("student_id").isNotNull() if key == "student_id" else F.col("student_id").isNull())
        # members under all ids of the other kind count together: one snapshot per key and date
        known = (
            snapshots.filter(F.col(key).isNotNull())
            .groupBy(key, "start_dt")
            .agg(*[F.sum(c).alias(c) for c in relations])
        )
        return asof.latest_snapshot(part.filter(F.col(key).isNotNull()), known, grid, [key]).withColumn(
            other, F.lit(None).cast("bigint")
        )

    columns = [*names, "pred_dt", "start_dt", *relations]
    return by("student_id", "person_id").select(columns).unionByName(by("person_id", "student_id").select(columns))


def outcome(
    rows: DataFrame, conditions: DataFrame, classes: DataFrame, horizon: int = 12, unresolved: bool = False, censor: bool = True
) -> DataFrame:
    """Forward label of the first positive condition, by either key."""
    first = labels.first_event(
        _classified(conditions, classes), ["student_id", "person_id"], test=F.col(POSITIVE) == 1
    )
    found = _first_by_either_key(rows, first)
    labelled = labels.forward_label(found, horizon=horizon, label=LABEL, prior="depression_dx_prior_to_pred_dt", unresolved=unresolved)
    if unresolved or not censor:
        return labelled
    # a student keeps one censoring date under all person ids; those without student id go by person
    known = labels.censor_after_last_positive(labelled.filter("student_id is not null"), ["student_id"], LABEL)
    others = labels.censor_after_last_positive(labelled.filter("student_id is null"), ["person_id"], LABEL)
    return known.unionByName(others)


def _first_by_either_key(rows: DataFrame, first: DataFrame) -> DataFrame:
    """Earliest first date under each key, so that a student with two person ids stays one row."""
    name = "condition_start"

    def part(key: str, mine: DataFrame) -> DataFrame:
        known = first.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(name).alias(name))
        return mine.join(known, key, "left").select(*rows.columns, name)

    return part("student_id", rows.filter("student_id is not null")).unionByName(
        part("person_id", rows.filter("student_id is null"))
    )


def _features(raw: Mapping[str, DataFrame], rows: DataFrame, grid: Grid, counts: bool) -> tuple[list, list]:
    keyed = rows.filter("student_id is not null")
    people = demographics(keyed, raw["enrollment"], raw["demographics"]).drop("person_id", "birth_date", "enrollment_start")
    absent = attendance(keyed, raw["attendance"], grid, buckets=not counts)
    incidents = behavior(keyed, raw["behavior"], grid, counts=counts)
    optional = [
        *suffix_clashes(absent, incidents, [*KEY, "pred_dt"]),  # both count detentions
        comorbidities(keyed, raw["conditions"], raw["condition_class"]),
        people,
        lunch_status(keyed, raw["free_reduced"]),
        homeless(keyed, raw["homeless"]),
        household(keyed, raw["household"], grid).drop("person_id", "start_dt"),
    ]
    return optional, [grade_shares(keyed, raw["grades"], raw["term_key"], grid, families=counts)]


def main_table(
    raw: Mapping[str, DataFrame], rows: DataFrame, grid: Grid = SEMESTERS, horizon: int = 12, unresolved: bool = False
) -> DataFrame:
    """Bucketed features and label per (student_id, pred_dt), grades required.

    Write ``rows`` once before calling (``session.materialise``): nine families read it.
    """
    optional, required = _features(raw, rows, grid, counts=False)
    label = outcome(rows.filter("student_id is not null"), raw["conditions"], raw["condition_class"], horizon, unresolved)
    optional.append(label.select(*KEY, "pred_dt", LABEL, "depression_dx_prior_to_pred_dt"))
    out = assemble.assemble(
        rows.select(*KEY, "pred_dt").distinct(), optional, required, KEY, nonzero=["age_at_pred", "yrs_enrolled"]
    )
    return out.drop("age_at_pred_natural")


def survival_table(raw: Mapping[str, DataFrame], rows: DataFrame, grid: Grid = SEMESTERS, horizon: int = 6) -> DataFrame:
    """Count features with ``(tstart, tstop]`` rows up to the last positive date."""
    optional, required = _features(raw, rows, grid, counts=True)
    label = outcome(rows.filter("student_id is not null"), raw["conditions"], raw["condition_class"], horizon)
    optional.append(label.select(*KEY, "pred_dt", LABEL))
    out = assemble.assemble(rows.select(*KEY, "pred_dt").distinct(), optional, required, KEY)
    return labels.survival_intervals(out, KEY, LABEL, nonzero=["age_at_pred", "yrs_enrolled"])


def survey_table(
    raw: Mapping[str, DataFrame], answer: str, after: int = 2019, status_year: int = 2020,
    attendance_year: str = "2019-20", grade_year: str = "2019-2020",
) -> DataFrame:
    """Respondents with label, demographics, lunch status, absences and grades, by student."""
    first = labels.first_event(
        _classified(raw["conditions"], raw["condition_class"]), KEY, test=F.col(POSITIVE) == 1
    )
    answers = raw["survey"].withColumnRenamed(answer, "workload_comp_conf")
    base = survey.respondent_demographics(
        survey.label_respondents(answers, first, "student_id", after), raw["demographics"], "student_id"
    ).select("student_id", "workload_comp_conf", POSITIVE, "race", "gender", "language", "grade")
    in_scope: Column = (F.col("year") == grade_year) & F.col("rask").rlike("^(Semester |Term)")
    return survey.survey_cohort(
        base,
        [
            survey.status_in_year(raw["free_reduced"], "student_id", F.col("end_year") == status_year),
            survey.absences_in_year(raw["attendance"], "student_id", F.col("year") == attendance_year),
            survey.grade_summary(raw["grades"], "student_id", in_scope),
        ],
        "student_id",
    )
