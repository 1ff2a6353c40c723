from conftest import day, rows
from pyspark.sql import functions as F

from cohortlens.functions import dates, recode
from cohortlens.functions import fixed_values as fixed


def test_attendance_arms(spark):
    data = [
        ("DS", "A", "E", "detention"), ("Rcp", "T", "U", "restitution"), ("ISS", "A", "U", "suspension"),
        (None, "A", "E", "exc_absence"), (None, "P", "X", "exc_absence"), (None, "P", "U", "unexc_absence"),
        (None, "A", "K", "unkn_absence"), (None, "A", None, "unkn_absence"), (None, "T", "E", "exc_tardy"),
        (None, "T", "U", "unexc_tardy"), ("zz", "T", None, "unkn_tardy"), (None, "E", "X", "exc_early_release"),
        (None, "E", "U", "unexc_early_release"), (None, "E", None, "unkn_early_release"), (None, None, None, "other"),
        (None, "A", "Q", "other"),
    ]
    df = spark.createDataFrame(data, "code string, status string, excuse string, want string")
    got = df.withColumn("got", recode.attendance_category("code", "status", "excuse"))
    assert got.filter("got <> want").count() == 0
    assert {r[3] for r in data} == set(fixed.ATTENDANCE_CATEGORIES)


def test_pattern_flags_and_category(spark):
    df = spark.createDataFrame(
        [("Police Referral",), ("1 day oss and iss",), ("Missing homework",), ("Detention",), (None,), ("After detention",)],
        "t string",
    )
    flags = recode.pattern_flags("t", prefix="behav_", suffix="_0_6m")
    got = {r.t: r for r in df.select("t", recode.pattern_category("t").alias("c"), *flags).collect()}
    both = got["1 day oss and iss"]
    assert (both.behav_oss_0_6m, both.behav_iss_0_6m, both.behav_minor_infraction_0_6m, both.c) == (1, 1, 0, "oss")
    # "iss" inside a word counts, as the case-blind pattern says
    assert got["Missing homework"].c == "iss"
    nothing = got[None]
    assert nothing.c == "minor_infraction"
    assert sum(v for k, v in nothing.asDict().items() if k.startswith("behav")) == 0
    assert got["After detention"].behav_detention_0_6m == 1


def test_count_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 5, 6, 10, 11, 15, 16, None)], "n int")
    got = [r[0] for r in df.select(recode.count_bucket("n")).collect()]
    assert got == ["_0", "_1_5", "_1_5", "_6_10", "_6_10", "_11_15", "_11_15", "_gt15", "_gt15"]


def test_relation_names(spark):
    data = [("Step-Mother", "F", "step_mother"), (" sibling ", "M", "brother"), ("Sibling", "F", "sister"),
            (" mother", "F", "other"), (None, "M", "other"), ("Foster Parent", None, "foster_parent"), ("sibling", None, "other")]
    df = spark.createDataFrame(data, "r string, g string, want string")
    assert df.filter(recode.relation_name("r", "g") != F.col("want")).count() == 0


def test_grade_bucket(spark):
    data = [("A", None, 1), (None, "A", 1), ("Pass", None, 2), ("C", None, 3), (None, "C", 5), ("F", "A", 4), (None, "D", 4),
            ("NC", None, 5), (None, None, 5)]
    df = spark.createDataFrame(data, "n string, s string, want int")
    assert df.filter(recode.grade_bucket("n", "s") != F.col("want")).count() == 0


def test_reverse_one_hot(spark):
    df = spark.createDataFrame([(1, 0, 11), (0, 1, 20), (1, 1, 21), (0, 0, 9)], "a int, b int, age int")
    got = df.select(
        recode.label_of_flags({"a": "A", "b": "B"}, "none"), recode.any_flag("a", "b"),
        recode.label_of_values("age", range(11, 21)),
    )
    assert [tuple(r) for r in got.collect()] == [("A", 1, "11"), ("B", 1, "20"), ("A", 1, "other"), ("none", 0, "other")]


def test_missing_and_prefer(spark):
    df = spark.createDataFrame([(None, None), (None, "b"), ("a", "b")], "x string, y string")
    got = df.select(recode.missing_in_all("x", "y"), recode.prefer("x", "y"), recode.present("x"))
    assert [tuple(r) for r in got.collect()] == [(1, None, 0), (0, "b", 0), (0, "a", 1)]


def test_dates(spark):
    df = spark.createDataFrame([("9/3/2018",), ("09-03-18",), ("31/31/2018",), ("x",), (None,)], "t string")
    assert [r[0] for r in df.select(dates.mdy("t")).collect()] == [day("2018-09-03"), day("2018-09-03"), None, None, None]
    stamp = spark.createDataFrame([("8/27/2019 0:00",), ("bad",)], "t string")
    assert [r[0] for r in stamp.select(dates.mdy_hm("t")).collect()] == [day("2019-08-27"), None]
    years = spark.createDataFrame([("2019-2020",), ("n/a",)], "y string")
    assert [r[0] for r in years.select(dates.start_year("y")).collect()] == [2019, None]
    assert tuple(years.select(*dates.year_pair("y")).first()) == (2019, 2020)
    school = spark.createDataFrame([(day("2019-07-31"),), (day("2019-08-01"),)], "d date")
    assert [r[0] for r in school.select(dates.school_year_of("d")).collect()] == [2018, 2019]


def test_years_between(spark):
    data = [("2002-01-01", "2018-01-01", 16.0), ("2002-01-02", "2018-01-01", 15 + 364 / 365), ("2004-02-29", "2005-02-28", 1.0),
            ("2004-02-29", "2020-01-01", None)]
    df = spark.createDataFrame([(day(a), day(b), w) for a, b, w in data], "a date, b date, want double")
    for r in df.withColumn("got", dates.years_between("a", "b")).collect():
        if r.want is not None:
            assert abs(r.got - r.want) < 1e-9
        else:
            assert 15 < r.got < 16


def test_season_dates(spark):
    df = spark.createDataFrame([("2019-2020",)], "y string")
    got = df.select(F.explode(dates.season_dates(dates.start_year("y"))).alias("d"))
    assert rows(got) == [(day("2019-07-01"),), (day("2020-01-01"),)]
