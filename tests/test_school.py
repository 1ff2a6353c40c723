"""Raw CSV files to model tables on a handful of students."""

import datetime as dt

import pytest
from conftest import day, rows
from pyspark.sql import functions as F

from cohortlens.operators.grid import Grid
from cohortlens.plans import school
from cohortlens.session import materialise
from cohortlens.sources.tables import SCHEMAS, read_csv

GRID = Grid(dt.date(2017, 7, 1), dt.date(2020, 7, 1))

FILES = {
    "enrollment": """student_id,person_id,school_id,start_date,end_date,birth_date,race_ethnicity_fed,home_primary_language
1,101,12,9/5/2017,6/8/2018,3/1/2004,6,11
1,101,12,9/4/2018,,3/1/2004,6,11
2,102,13,9/4/2018,6/7/2019,7/1/2005,4,
3,103,99,9/4/2018,6/7/2019,7/1/2005,4,11
,104,14,9/4/2018,6/7/2019,1/1/2005,1,45
""",
    "attendance": """student_id,date,year,period_name,status,excuse,excuse_code,excuse_description
1,10/2/2018,2018-19,1,A,E,,
1,10/2/2018,2018-19,2,A,E,,
1,10/3/2018,2018-19,1,A,E,,
1,10/4/2018,2018-19,1,A,U,ISS,
2,1/1/2019,2018-19,1,T,,,
""",
    "behavior": """student_id,person_id,incident_date,resolution_name
1,101,11/1/2017,OSS 1 day
1,101,11/1/2018,Police Referral
1,101,12/1/2018,Police Referral
""",
    "conditions": """student_id,person_id,health_condition,condition_start_date,condition_end_date,condition_status,treatment
1,101,Anxiety,2/1/2018,,,
1,101,Depression,3/1/2019,,,
,104,Depression,2/1/2019,,,
""",
    "condition_class": """health_condition,depressive_disorder,psychiatric_disorder_non_depressive,stress_or_depression_related,general_inflammatory_disease,autoimmune_disease,substance_related,self_harm
Anxiety,0,1,0,0,0,0,0
Depression,1,0,0,0,0,0,0
""",
    "demographics": """student_id,gender,language,race_ethnicity_code
1,F,English,6
2,M,Somali,4
""",
    "free_reduced": """student_id,eligibility,year,end_year
1,F,2018-2019,2019
2,H,2018-2019,2019
""",
    "homeless": """Student Number,Person ID,year,Homeless
1,101,2017-2018,Y
1,101,2018-2019,N
""",
    "household": """student_studentNumber,personID,Relationship,ContactID,year
1,101,Mother,F,2017-2018
1,101,Sibling,M,2017-2018
1,101,Sibling,M,2017-2018
1,101,Self,F,2017-2018
1,101,Step-Mother,F,2018-2019
,104,father,M,2017-2018
""",
    "grades": """student_id,year,course_name,term_name,rask,score,grading.scoreListItemName
1,2018-2019,Math,T1,Semester 1,A,A
1,2018-2019,Art,T1,Semester 1,F,F
1,2018-2019,Gym,T1,Midterm,A,A
1,2017-2018,Math,T1,Semester 1,A,A
2,2018-2019,Math,T1,Semester 1,B,
""",
    "term_key": """name,startDate,endDate
T1,9/4/2018 0:00,12/21/2018 0:00
T1,9/5/2017 0:00,12/22/2017 0:00
""",
}


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    out = {}
    for name, text in FILES.items():
        (folder / f"{name}.csv").write_text(text)
        out[name] = read_csv(spark, str(folder / f"{name}.csv"), name)
        assert out[name].columns == spark.createDataFrame([], SCHEMAS[name]).columns
    return out


@pytest.fixture(scope="module")
def spine(raw):
    return materialise(school.spine(raw["enrollment"], GRID), "spine")


def test_spine(spine):
    got = rows(spine, "person_id", "pred_dt", "enrollment_start")
    assert got == [
        (101, day("2018-01-01"), day("2017-09-05")), (101, day("2018-07-01"), day("2017-09-05")),
        (101, day("2019-01-01"), day("2017-09-05")), (101, day("2019-07-01"), day("2017-09-05")),
        (102, day("2019-01-01"), day("2018-09-04")), (104, day("2019-01-01"), day("2018-09-04")),
    ]


def at(df, student, date):
    return df.filter((F.col("student_id") == student) & (F.col("pred_dt") == F.lit(day(date)))).first()


def test_attendance(raw, spine):
    counts = school.attendance(spine, raw["attendance"], GRID, buckets=False)
    r = at(counts, 1, "2019-01-01")
    assert (r.exc_absence, r.suspension, r.attend_other) == (2, 1, 0)
    assert at(counts, 2, "2019-01-01").unkn_tardy == 1
    hot = school.attendance(spine, raw["attendance"], GRID)
    r = at(hot, 1, "2019-01-01")
    assert (r.exc_absence_1_5_6mo, r.exc_absence_6_10_6mo, r.other_0_6mo) == (1, 0, 0)
    assert at(hot, 1, "2018-01-01").other_0_6mo == 1


def test_behavior(raw, spine):
    r = at(school.behavior(spine, raw["behavior"], GRID), 1, "2019-01-01")
    # the row before is a year back: lags count rows
    assert (r.behav_police_0_6m, r.behav_oss_0_6m, r.behav_oss_6_12m, r.behav_oss_12_18m) == (1, 0, 1, 0)
    assert at(school.behavior(spine, raw["behavior"], GRID, counts=True), 1, "2019-01-01").police == 2


def test_conditions(raw, spine):
    got = school.comorbidities(spine, raw["conditions"], raw["condition_class"])
    assert at(got, 1, "2018-07-01").psychiatric_disorder_non_depressive == 1
    assert at(got, 1, "2018-01-01") is None
    label = school.outcome(spine, raw["conditions"], raw["condition_class"], 6)
    assert rows(label.filter(F.col(school.LABEL) == 1), "person_id", "pred_dt") == [
        (101, day("2019-01-01")), (104, day("2019-01-01"))
    ]
    assert label.filter("person_id = 101 and pred_dt > date'2019-01-01'").count() == 0  # censored
    loose = school.outcome(spine, raw["conditions"], raw["condition_class"], 12, unresolved=True)
    assert loose.filter(f"person_id = 101 and {school.LABEL} = 1").count() == 3


def test_people(raw, spine):
    got = school.demographics(spine, raw["enrollment"], raw["demographics"])
    one = at(got, 1, "2019-01-01")
    assert (one.white, one.genderf, one.lang_english, one.age_at_pred_natural) == (1, 1, 1, 14)
    assert at(got, 2, "2019-01-01").lang_somali == 1  # no home language: the demographic one counts
    other = got.filter("person_id = 104").first()
    assert (other.hispanic, other.lang_spanish, other.genderf) == (1, 1, 0)


def test_status(raw, spine):
    lunch = school.lunch_status(spine, raw["free_reduced"])
    assert (at(lunch, 1, "2019-01-01").FR_status, at(lunch, 2, "2019-01-01").HSA_status) == (1, 1)
    r = at(school.homeless(spine, raw["homeless"]), 1, "2019-01-01")
    assert (r.homeless_y_in_yr, r.homeless_y_ever) == (0, 1)


def test_household(raw, spine):
    got = school.household(spine, raw["household"], GRID)
    r = at(got, 1, "2018-01-01")
    assert (r.mother, r.brother, r.step_mother) == (1, 2, 0)
    assert at(got, 1, "2018-07-01").mother == 1  # the new year's snapshot is not known on its own date
    assert at(got, 1, "2019-01-01").step_mother == 1
    assert got.filter("person_id = 104").first().father == 1


def test_grades(raw, spine):
    got = school.grade_shares(spine, raw["grades"], raw["term_key"], GRID)
    r = at(got, 1, "2019-01-01")
    assert (r.grade_bucket1_6mo, r.grade_bucket4_6mo, r.grade_bucket1_12mo) == (0.5, 0.5, 1.0)
    families = school.grade_shares(spine, raw["grades"], raw["term_key"], GRID, families=True)
    assert at(families, 2, "2019-01-01").B_grades == 1.0


def test_main_and_survival(raw, spine):
    main = school.main_table(raw, spine, GRID, horizon=6).cache()
    assert rows(main, "student_id", "pred_dt", school.LABEL) == [
        (1, day("2018-01-01"), 0), (1, day("2019-01-01"), 1), (2, day("2019-01-01"), 0)
    ]
    assert main.count() == main.select("student_id", "pred_dt").distinct().count()
    assert at(main, 2, "2019-01-01").homeless_y_in_yr == 0
    timed = school.survival_table(raw, spine, GRID)
    assert rows(timed, "student_id", "pred_dt", "tstart", "tstop") == [
        (1, day("2018-01-01"), 0, 6), (1, day("2019-01-01"), 6, 12), (2, day("2019-01-01"), 0, 6)
    ]


def test_survey(spark, raw):
    answers = spark.createDataFrame([(1, "9", "Female", "white", 3.0), (2, "9", None, None, 4.0), (None, "9", "Male", "x", 1.0)],
                                    "student_id long, grade string, gender string, race string, q1 double")
    got = school.survey_table({**raw, "survey": answers}, "q1", after=2018, status_year=2019, attendance_year="2018-19",
                              grade_year="2018-2019")
    r = {x.student_id: x for x in got.collect()}
    assert (r[1].depressive_disorder, r[1].F, r[1].excused, r[1].unexcused, r[1].total_courses, r[1].A_grades) == (1, 1, 3, 1, 2, 1)
    assert (r[2].race, r[2].gender, r[2].language, r[2].B_grades) == ("4", "M", "other", 1)


def test_two_persons_of_one_student(spark, raw):
    """Censoring and household snapshots go by student, whatever person ids the student is known under."""
    spine = spark.createDataFrame(
        [(1, 101, day("2018-07-01")), (1, 101, day("2019-01-01")), (1, 102, day("2019-07-01")), (1, 102, day("2020-01-01"))],
        "student_id long, person_id long, pred_dt date",
    )
    kept = school.outcome(spine, raw["conditions"], raw["condition_class"])
    assert sorted(r.pred_dt for r in kept.collect()) == [day("2018-07-01"), day("2019-01-01")]
    more = raw["household"].unionByName(
        spark.createDataFrame([(1, 199, "Mother", "F", "2017-2018")], raw["household"].schema)
    )
    found = school.household(spine.select("student_id", "person_id", "pred_dt").distinct(), more, GRID)
    dates = [r.pred_dt for r in found.filter("student_id = 1").collect()]
    assert len(dates) == len(set(dates))


def test_csv_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("student_id,person_id,note\n1,101,x\n2,,y\n")
    (tmp_path / "b.csv").write_text("person_id,student_id\n202,3\nabc,4\n")
    ddl = "student_id long, person_id long, gone string"
    got = read_csv(spark, str(tmp_path), ddl, mixed=True, rejects=True)
    assert rows(got) == [(1, 101, None, 0), (2, None, None, 0), (3, 202, None, 0), (4, None, None, 1)]
    with pytest.raises(Exception, match="header"):
        read_csv(spark, str(tmp_path), ddl).collect()
