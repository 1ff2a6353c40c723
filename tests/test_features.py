import datetime as dt

from conftest import day, rows
from pyspark.sql import functions as F

from cohortlens.operators import asof, assemble, fallback, grades, reshape, survey, windows
from cohortlens.operators.grid import Grid

GRID = Grid(dt.date(2018, 7, 1), dt.date(2020, 7, 1))


def spine_of(spark, *pairs):
    return spark.createDataFrame([(e, day(d)) for e, d in pairs], "ent long, pred_dt date")


def events_of(spark, *data):
    return spark.createDataFrame([(e, day(d), c) for e, d, c in data], "ent long, event_dt date, category string")


def test_window_edges_and_distinct_days(spark):
    spine = spine_of(spark, (1, "2019-01-01"), (1, "2019-07-01"), (2, "2019-01-01"))
    events = events_of(
        spark, (1, "2018-06-30", "a"), (1, "2018-07-01", "a"), (1, "2019-01-01", "a"), (1, "2019-01-01", "a"),
        (1, "2019-01-02", "b"), (1, "2019-07-02", "b"), (1, None, "a"), (3, "2019-01-01", "a"),
    )
    got = rows(windows.window_distinct_days(spine, events, GRID, ["ent"], ["a", "b"]))
    # 1 January 2019 lies in both closed windows
    assert got == [(1, day("2019-01-01"), 2, 0), (1, day("2019-07-01"), 1, 1), (2, day("2019-01-01"), 0, 0)]


def test_bucketed_one_hot_default_row(spark):
    counts = spark.createDataFrame([(1, day("2019-01-01"), 6, 0), (2, day("2019-01-01"), 0, 0)],
                                   "ent long, pred_dt date, exc long, other long")
    got = {r.ent: r for r in windows.bucketed_one_hot(counts, ["ent"], ["exc", "other"]).collect()}
    assert got[1].exc_6_10_6mo == 1 and got[1].other_0_6mo == 0 and got[1].exc_0_6mo == 0
    assert got[2].other_0_6mo == 1 and got[2].exc_0_6mo == 0


def test_flags_and_lags(spark):
    spine = spine_of(spark, (1, "2019-01-01"), (1, "2019-07-01"), (1, "2020-07-01"), (2, "2019-01-01"))
    events = spark.createDataFrame(
        [(1, day("2018-12-01"), 1), (1, day("2019-03-01"), 0), (1, day("2020-06-01"), 0)], "ent long, event_dt date, x int"
    )
    flags = windows.window_flags(spine, events, GRID, ["ent"], ["x"])
    by_row = rows(windows.row_lags(flags, ["ent"], {"x": ["l1", "l2"]}))
    assert by_row == [
        (1, day("2019-01-01"), 1, 0, 0), (1, day("2019-07-01"), 0, 1, 0), (1, day("2020-07-01"), 0, 0, 1)
    ]
    # the skipped period shifts rows, not the calendar
    by_date = rows(windows.calendar_lags(flags, GRID, ["ent"], {"x": ["l1", "l2"]}))
    assert by_date[2] == (1, day("2020-07-01"), 0, 0, 0)
    assert windows.lag_names(["a_0_6m"], "_0_6m", ["_6_12m"]) == {"a_0_6m": ["a_6_12m"]}


def test_category_counts(spark):
    spine = spine_of(spark, (1, "2019-01-01"))
    events = events_of(spark, (1, "2018-12-01", "a"), (1, "2018-12-01", "a"), (1, "2018-12-02", "b"))
    assert rows(windows.window_category_counts(spine, events, GRID, ["ent"], ["a", "b"])) == [(1, day("2019-01-01"), 2, 1)]


def test_shares_sum_to_one(spark):
    spine = spine_of(spark, (1, "2019-01-01"), (1, "2019-07-01"))
    data = spark.createDataFrame(
        [(1, day("2018-12-20"), 1, "x"), (1, day("2018-12-20"), 1, "y"), (1, day("2018-12-20"), 4, "z"),
         (1, day("2018-09-20"), 1, "x")],
        "ent long, end_dt date, score_bucket int, course string",
    )
    names = {1: "b1", 4: "b4"}
    got = rows(windows.window_shares(spine, data, GRID, ["ent"], names, distinct_on=["course"]))
    assert [(r[0], r[1]) for r in got] == [(1, day("2019-01-01"))]
    assert abs(got[0][2] - 2 / 3) < 1e-12 and abs(got[0][2] + got[0][3] - 1) < 1e-12
    every = rows(windows.window_shares(spine, data, GRID, ["ent"], names))
    assert every[0][2] == 0.75


def test_ever_is_strict(spark):
    spine = spine_of(spark, (1, "2019-01-01"), (1, "2019-07-01"), (2, "2019-01-01"))
    events = spark.createDataFrame([(1, day("2018-01-01"), 0), (1, day("2019-01-01"), 1), (2, day("2019-01-01"), 1)],
                                   "ent long, event_dt date, x int")
    got = rows(asof.ever_before_flags(spine, events, ["ent"], ["x"]))
    assert got == [(1, day("2019-01-01"), 0), (1, day("2019-07-01"), 1)]


def test_current_and_ever(spark):
    spine = spine_of(spark, (1, "2018-07-01"), (1, "2019-01-01"), (1, "2019-07-01"), (1, "2020-01-01"), (9, "2019-01-01"))
    status = spark.createDataFrame(
        [(1, "2018-2019", "Y"), (1, "2018-2019", "N"), (1, "2019-2020", "N"), (None, "2019-2020", "Y")],
        "ent long, year string, h string",
    )
    got = rows(asof.current_and_ever(spine, status, ["ent"], F.col("h") == "Y", "cur", "ever"))
    assert got == [
        (1, day("2018-07-01"), 1, None), (1, day("2019-01-01"), 1, 1),
        (1, day("2019-07-01"), 0, 1), (1, day("2020-01-01"), 0, 1),
    ]


def test_latest_snapshot(spark):
    spine = spine_of(spark, (1, "2018-07-01"), (1, "2019-01-01"), (1, "2020-07-01"), (2, "2019-01-01"), (3, "2018-07-01"))
    snaps = spark.createDataFrame(
        [(1, day("2018-07-01"), 5), (1, day("2019-07-01"), 6), (1, day("2019-07-01"), 7), (2, day("2019-07-01"), 1),
         (3, day("2001-07-01"), 9)],
        "ent long, start_dt date, n int",
    )
    got = rows(asof.latest_snapshot(spine, snaps, GRID, ["ent"]), "ent", "pred_dt", "n")
    # on the date itself is not before it; ties stay; long before the grid counts
    assert got == [
        (1, day("2019-01-01"), 5), (1, day("2020-07-01"), 6), (1, day("2020-07-01"), 7), (3, day("2018-07-01"), 9)
    ]


def test_latest_snapshot_against_rank(spark):
    spine = spark.range(30).select(F.col("id").alias("ent")).crossJoin(GRID.dates(spark))
    snaps = spark.range(200).select(
        (F.col("id") * 7 % 30).alias("ent"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") * 37 % 900).cast("int")).alias("start_dt"),
        F.col("id").alias("n"),
    )
    ranked = spark.sql(
        "select ent, pred_dt, start_dt, n from (select s.ent, pred_dt, start_dt, n, rank() over (partition by s.ent, pred_dt "
        "order by start_dt desc) r from {s} s join {p} p on s.ent = p.ent and start_dt < pred_dt) where r = 1",
        s=spine, p=snaps,
    )
    got = asof.latest_snapshot(spine, snaps, GRID, ["ent"])
    assert rows(got, "ent", "pred_dt", "start_dt", "n") == rows(ranked)


def test_school_year_flags(spark):
    spine = spine_of(spark, (1, "2019-07-01"), (1, "2020-01-01"), (1, "2020-07-01"))
    status = spark.createDataFrame([(1, "2019-2020", "F"), (1, "2019-2020", "F"), (None, "2019-2020", "F")],
                                   "ent long, year string, e string")
    got = asof.school_year_flags(spine, status, ["ent"], {"fr": F.col("e").isin("F", "R"), "hsa": F.col("e") == "H"})
    assert rows(got) == [(1, day("2019-07-01"), 1, 0), (1, day("2020-01-01"), 1, 0)]


def test_two_key_fallback(spark):
    left = spark.createDataFrame([(1, 10), (None, 20), (None, None), (3, None)], "student_id long, person_id long")
    right = spark.createDataFrame([(1, 99, "a"), (None, 20, "b"), (7, 10, "c"), (None, None, "d")],
                                  "student_id long, person_id long, v string")
    got = fallback.two_key_join(left, right, "student_id", "person_id")
    assert {tuple(r) for r in got.collect()} == {(1, 10, "a"), (None, 20, "b"), (None, None, None), (3, None, None)}
    assert [c for c in got.columns] == ["student_id", "person_id", "v"]


def test_static_one_hot(spark):
    spine = spark.createDataFrame([(1, 10, day("2018-09-01"), day("2019-01-01")), (None, 20, day("2018-09-01"), day("2019-01-01"))],
                                  "student_id long, person_id long, enrollment_start date, pred_dt date")
    enrolled = spark.createDataFrame(
        [(1, 10, 2, 11, day("2004-01-01")), (1, 10, 6, None, day("2004-01-02")), (None, 20, 4, None, day("2003-01-01"))],
        "student_id long, person_id long, race_ethnicity_fed int, home_primary_language int, birth_date date",
    )
    demo = spark.createDataFrame([(1, "F", "Spanish"), (1, None, None)], "student_id long, gender string, language string")
    got = {r.person_id: r for r in fallback.static_one_hot(spine, enrolled, demo).collect()}
    one, two = got[10], got[20]
    assert (one.ai_alaskan_native, one.white, one.genderf, one.genderm) == (1, 1, 1, 0)
    assert (one.lang_english, one.lang_spanish) == (1, 1)  # a second row without home language lets Spanish in
    assert one.birth_date == day("2004-01-01")
    assert (two.aa_black, two.genderf, two.lang_english) == (1, 0, 0)
    apart = fallback.static_one_hot(spine, enrolled, demo, one_birth_date=False)
    assert apart.filter("person_id = 10").count() == 2


KEYS = ["ent", "course"]


def graded(spark):
    return spark.createDataFrame(
        [(1, "same", "Semester 1", 2), (1, "same", "Semester 1", 2), (1, "two", "Semester 1", 1), (1, "two", "Semester 1", 4),
         (1, "mid", "Quarter 1", 3), (1, "dupmid", "Quarter 1", 3), (1, "dupmid", "Quarter 1", 5),
         (None, "nul", "Semester 1", 1), (None, "nul", "Semester 1", 2), (1, "term", "Term 2", 1), (1, "term", "Term 2", 2)],
        "ent long, course string, rask string, score_bucket int",
    )


def test_dedup(spark):
    final = F.col("rask").ilike("Semester %") | F.col("rask").ilike("Term%")
    keys = [*KEYS, "rask"]
    base = {(None, "nul", "Semester 1", 1), (None, "nul", "Semester 1", 2), (1, "same", "Semester 1", 2)}
    got = grades.dedup_keep_max(graded(spark), keys, final=final)
    assert {tuple(r) for r in got.collect()} == base | {(1, "two", "Semester 1", 4), (1, "dupmid", "Quarter 1", 5), (1, "term", "Term 2", 2)}
    low = grades.dedup_keep_max(graded(spark), keys, final=final, keep="min")
    assert (1, "two", "Semester 1", 1) in {tuple(r) for r in low.collect()}
    loose = grades.dedup_keep_max(graded(spark), keys, final=final, literal=F.col("rask").ilike("Semester %"))
    two = sorted(r.score_bucket for r in loose.filter("course = 'two'").collect())
    assert two == [1, 4, 4]
    assert {r.course for r in grades.duplicate_buckets(graded(spark), keys).collect()} == {"two", "dupmid", "term"}


def test_term_dates(spark):
    terms = spark.createDataFrame([("T1", day("2018-08-27"), day("2018-12-20")), ("T2", day("2019-01-07"), day("2019-06-05"))],
                                  "name string, start_dt date, end_dt date")
    data = spark.createDataFrame([("2018-2019", "T1"), ("2018-2019", "T2"), ("2019-2020", "T1")], "year string, term_name string")
    got = rows(grades.term_dates(data, terms), "start_yr", "term_name", "end_dt")
    assert got == [(2018, "T1", day("2018-12-20")), (2018, "T2", day("2019-06-05")), (2019, "T1", None)]


def test_term_dates_by_the_number_of_the_year(spark):
    terms = spark.createDataFrame([(1, day("2018-08-27"), day("2018-12-20")), (2, day("2019-01-07"), day("2019-06-05"))],
                                  "name int, start_dt date, end_dt date")
    data = spark.createDataFrame([(2018, 1), (2018, 2), (2019, 1), (None, 1)], "year int, term int")
    got = rows(grades.term_dates(data, terms, term="term"), "start_yr", "end_yr", "term", "end_dt")
    assert got == [(2018, 2019, 1, day("2018-12-20")), (2018, 2019, 2, day("2019-06-05")), (2019, 2020, 1, None), (None, None, 1, None)]


def test_distinct_days_of_a_long_window_in_one_shuffle(spark):
    grid = Grid(dt.date(2019, 1, 1), dt.date(2019, 12, 31), 30, "day")
    events = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 5).alias("ent"),
        F.date_add(F.lit(dt.date(2018, 6, 1)), (F.col("id") * 11 % 640).cast("int")).alias("event_dt"),
        F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("id") % 3 + 1).cast("int")).alias("category"),
    )
    counts = windows.window_distinct_days(None, events, grid, ["ent"], ["a", "b"], length=200)
    brute = spark.sql(
        "select ent, pred_dt, count(distinct case when category = 'a' then event_dt end) a, count(distinct case when category = 'b' "
        "then event_dt end) b from {g} join {e} on event_dt between date_sub(pred_dt, 200) and pred_dt "
        "where category in ('a', 'b') group by 1, 2", g=grid.dates(spark), e=events,
    )
    assert rows(counts) == rows(brute)
    assert counts._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2  # no DISTINCT before


def test_shares_of_rows_dealt_to_tasks(spark):
    spine = spark.range(6).select(F.col("id").alias("ent")).crossJoin(GRID.dates(spark))
    data = spark.range(900).select(
        (F.col("id") % 7).alias("ent"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") * 17 % 800).cast("int")).alias("end_dt"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 4).cast("int").alias("score_bucket"),
        F.when(F.col("id") % 11 > 0, F.col("id") % 60).alias("line"),
    )
    plain, dealt = (
        windows.window_shares(spine, data, GRID, ["ent"], {1: "one", 2: "two"}, distinct_on=["line"], length=12, tasks=n) for n in (None, 9)
    )
    assert rows(dealt) == rows(plain) and plain.count() > 0
    tops = dealt._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in tops


def test_assemble_order_of_fill_and_filter(spark):
    spine = spine_of(spark, (1, "2019-01-01"), (2, "2019-01-01"), (3, "2019-01-01"), (None, "2019-01-01"))
    age = spark.createDataFrame([(1, day("2019-01-01"), 15.5), (2, day("2019-01-01"), None)], "ent long, pred_dt date, age double")
    need = spark.createDataFrame([(1, day("2019-01-01"), None), (2, day("2019-01-01"), 0.5)], "ent long, pred_dt date, share double")
    got = assemble.assemble(spine, [age], [need], keys=["ent"], nonzero=["age"])
    assert rows(got, "ent", "age", "share") == [(1, 15.5, 0.0)]


def test_assemble_shuffles_the_spine_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spine = spark.range(1000).select(F.col("id").alias("ent"), F.lit(dt.date(2019, 1, 1)).alias("pred_dt"))
        tables = [
            spine.groupBy("ent", "pred_dt").agg(F.count("*").alias(f"n{i}")) for i in range(4)
        ]
        plan = assemble.assemble(spine, tables, keys=["ent"])._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 5  # the spine and one per aggregated table
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_splits(spark):
    df = spark.range(2000).select(F.col("id").alias("ent"), F.date_add(F.lit(dt.date(2009, 6, 1)), (F.col("id") * 2).cast("int")).alias("pred_dt"))
    parts = assemble.split_by_year(df)
    assert parts["train"].agg(F.min(F.year("pred_dt")), F.max(F.year("pred_dt"))).first()[:] == (2010, 2017)
    train, test = assemble.hash_split(df, "ent")
    assert train.count() + test.count() == 2000 and 1400 < train.count() < 1600
    again, _ = assemble.hash_split(df.repartition(17), "ent")
    assert rows(again, "ent") == rows(train, "ent")
    assert assemble.rows_not_in(df, train).count() == test.count()


def test_backtests(spark):
    df = spine_of(spark, *[(1, d) for d in ("2018-07-01", "2019-01-01", "2019-07-01", "2020-01-01", "2020-07-01")])
    grid = Grid(dt.date(2019, 7, 1), dt.date(2020, 1, 1))
    train, test = assemble.backtest_rows(df, grid)
    assert rows(train.groupBy("test_dt").count()) == [(day("2019-07-01"), 2), (day("2020-01-01"), 3)]
    assert rows(test, "test_dt", "pred_dt") == [(day("2019-07-01"),) * 2, (day("2020-01-01"),) * 2]
    seen, _ = assemble.backtest_rows(df, grid, inclusive=True)
    assert rows(seen.groupBy("test_dt").count()) == [(day("2019-07-01"), 3), (day("2020-01-01"), 4)]
    split = assemble.backtest_splits(df, grid)
    assert [(d, a.count(), z.count()) for d, a, z in split] == [("2019-07-01", 2, 1), ("2020-01-01", 3, 1)]


def test_columns_by_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, a_12m int, y int")
    assert assemble.without_pattern(df, "12m|18m").columns == ["a", "y"]
    assert assemble.feature_columns(df, ["y"]) == ["a", "a_12m"]


def test_reshape(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "z")], "ent long, c string")
    assert rows(reshape.pivot_counts(df, ["ent"], "c", ["x", "y"])) == [(1, 2, 1, 0), (2, 0, 0, 1)]
    assert rows(reshape.pivot_presence(df, ["ent"], "c", ["x", "y"], other=None)) == [(1, 1, 1), (2, 0, 0)]
    stacked = reshape.stack([df, spark.createDataFrame([(3,)], "ent long")])
    assert stacked.filter("c is null").count() == 1


def test_survey(spark):
    answers = spark.createDataFrame([(1, "Male", "w", 3.0), (2, None, None, 2.0), (3, None, "b", 1.0), (None, "Male", "w", 1.0)],
                                    "ent long, gender string, race string, answer double")
    first = spark.createDataFrame([(1, day("2020-02-01")), (3, day("2018-02-01"))], "ent long, condition_start date")
    labelled = survey.label_respondents(answers, first, "ent", 2019)
    assert rows(labelled, "ent", "depressive_disorder") == [(1, 1), (2, 0), (3, 0)]
    demo = spark.createDataFrame([(2, "c", "F", "English"), (3, None, "M", "Hmong")],
                                 "ent long, race_ethnicity_code string, gender string, language string")
    got = survey.respondent_demographics(labelled, demo, "ent")
    assert rows(got, "ent", "race", "gender", "language") == [
        (1, "w", "M", "not_recorded"), (2, "c", "F", "English"), (3, "b", "M", "other")
    ]


def test_checks(spark):
    df = spark.createDataFrame([(1, 1, 1), (1, 0, 1), (2, None, 0)], "ent long, f int, m int")
    assert rows(fallback.duplicate_keys(df, ["ent"])) == [(1, 2)]
    assert fallback.exclusive_violations(df, ["f", "m"]).count() == 1
    assert rows(fallback.null_pattern(df, ["f", "m"])) == [(0, 0, 2), (1, 0, 1)]


def test_partitioning_changes_nothing(spark):
    spine = spark.range(40).select(F.col("id").alias("ent")).crossJoin(GRID.dates(spark))
    events = spark.range(3000).select(
        # one entity holds a third of the events
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 40).alias("ent"),
        F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") * 13 % 900).cast("int")).alias("event_dt"),
        F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("category"),
    )
    results = []
    for n in ("1", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(rows(windows.window_distinct_days(spine, events, GRID, ["ent"], ["a", "b"])))
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert results[0] == results[1]
    brute = spark.sql(
        "select s.ent, s.pred_dt, count(distinct case when category = 'a' then event_dt end) a, "
        "count(distinct case when category = 'b' then event_dt end) b from {s} s left join {e} e on s.ent = e.ent "
        "and event_dt between add_months(pred_dt, -6) and pred_dt group by 1, 2", s=spine, e=events,
    )
    assert rows(brute) == results[0]
